"""Exact Jaccard self-join on word n-grams with token-combination prefixes.

Two documents link when ``100 * |x & y| >= 80 * |x | y|`` of their sets of distinct shingles.  Then x lacks at most
``|x| // 5`` of its shingles in y, and the same holds for y.  Shingles have one order for all documents: those whose hash lies in
the low zone first, rare ones before frequent ones, then the others, each by hash.  A document indexes a prefix of that order:
rare shingles one by one, frequent ones (and those of the other zone, whose frequency is not counted) in sub-classes by hash,
two at a time.  A sub-class with k shingles in the prefix still yields a common pair after k - 2 of them are lost, so it
counts k - 1 losses; the prefix is extended until the losses it can bear exceed ``|x| // 5``.  Hence linked documents share
a single or a pair.  The number of sub-classes depends on the size; a document indexes its pairs for its own size range and
the one below, so linked documents meet in a common one.

Frequencies come from exact counts of the low zone's shingles over all documents.  What is sent to the tasks is of fixed
size: a bitmap of shingles seen twice (the others need no index entry) and one of frequent shingles.  Either has false
positives at most, which cost time and never a link.

Documents with equal sets become one node first, so copies never form pairs.  A node is a set, known by its size and two
hashes; rows that repeat a doc_id with another text are other nodes, joined by a link of their own.  Candidates are verified in two steps: each node
with the smallest node of one of its index entries; then, where an index entry still spans several components, the pairs
across components.  Links inside a component need no further proof, as only components are returned.

Of entries of more than ``CROWD`` nodes the second step makes no pairs.  A node whose shingles mostly stand in no other node
of such entries links with none of them and goes.  The others are described by their difference from the entry's smallest
node, the hub: the shingles that only one of the two has.  For nodes x and y with differences of d and e shingles, o of them
common, the two sets differ in ``d + e - 2 * o`` shingles, and they link when that is at most ``(|x| + |y|) / 9``.  Nodes that
link with the hub are in its component.  If x does not, then d exceeds ``(|x| + |hub|) / 9``, so o must exceed
``(9 * e + |hub| - |y|) / 18``, about half of y's difference.  Hence x and y meet when x indexes all of its difference and y a
prefix of its own, rare shingles first; differences seen once need no entry.  If y does not link with the hub either, the same
holds for x, and they meet within both prefixes.  All differences of a hub have one order, so a pair that links is found at the
first shingle that its differences share, where o is at most what either has from there on; at later ones fewer are left and the
bound rules most pairs out.  Most pairs of a large group of near copies, whose edits differ, never meet.

Defined results: null, empty and blank texts have no shingles and link with nothing; repeated rows are copies; rows of one
doc_id with different texts are one document, in one component (a row of it without shingles stays alone); rows with a null
doc_id get a null component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import joined_bytes, mix, stage, text_slices, unstage, word_hashes, word_spans
from tidemark.llm.components import components

WORDS = 5
PERCENT = 80
#: Share of hash values in the low zone: a prefix of rare shingles takes a fifth of a document's.
ZONE = np.uint64(int(0.23 * 2**64))
#: Bits of a bitmap, and the least frequencies of which the first is chosen that fills a sixteenth of it at most.
BITS = 1 << 25
FREQUENT = (16, 256, 4096)
#: Nodes of an index entry above which their differences from a hub are joined.
CROWD = 16
#: Nodes of one hub above which a shingle of their differences counts as frequent.
OFTEN = 16
#: Bits of the bitmap that picks out the documents in candidate pairs.
ID_BITS = 1 << 23

_PLACE = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(WORDS)]
_RANGES = np.array([-(-(5**k) // 4**k) for k in range(200) if 5**k // 4**k < 2**62], np.int64)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, offsets = joined_bytes(texts)
    starts, ends, first = word_spans(raw, offsets)
    words = word_hashes(raw, starts, ends)
    n = len(words) - WORDS + 1
    runs = np.zeros(max(0, n), np.uint64)
    for k in range(WORDS):
        if n > 0:
            runs += words[k : k + n] * _PLACE[k]
    runs = mix(runs)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            yield np.unique(runs[a : b - WORDS + 1])
        elif b > a:
            short = np.array([int(b - a) * 0x9E3779B97F4A7C15 % 2**64], np.uint64)
            for k in range(b - a):
                short = np.bitwise_xor(short, words[a + k : a + k + 1] * _PLACE[k])
            yield mix(short)
        else:
            yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    a = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def has_bit(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    at = at & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def entries(shingles: np.ndarray, twice: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The index entries of a set: single rare shingles and pairs of others, as hashes.

    A set of three or fewer links with equal sets alone and has no entry.
    """
    n = len(shingles)
    if n <= 3:
        return np.zeros(0, np.uint64)
    need = n // 5 + 1
    low = shingles[: np.searchsorted(shingles, ZONE)]
    common = has_bit(frequent, low)
    rare = low[~common][:need]
    found = [rare[has_bit(twice, rare)]]
    if len(rare) < need:
        kept = low[common]
        rest = np.concatenate([kept, shingles[len(low) :]])
        known = np.concatenate([has_bit(twice, kept), np.ones(n - len(low), bool)])
        scrambled = mix(rest ^ np.uint64(0x2545F4914F6CDD1D))
        own = int(np.searchsorted(_RANGES, n, "right")) - 1
        for world in (own, own - 1):
            classes = max(1, int(_RANGES[max(world, 0)]) // 10)
            kind = (scrambled % np.uint64(classes)).astype(np.int64)
            fresh = np.zeros(len(rest), bool)
            fresh[np.unique(kind, return_index=True)[1]] = True
            borne = len(rare) + np.cumsum(~fresh)
            end = int(np.searchsorted(borne, need)) + 1
            order = np.argsort(kind[:end], kind="stable")
            tokens, kinds, used = rest[:end][order], kind[:end][order], known[:end][order]
            for step in range(1, end):
                same = kinds[step:] == kinds[:-step]
                if not same.any():
                    break
                same &= used[step:] & used[:-step]
                pair = tokens[:-step][same] * _PLACE[0] + tokens[step:][same] * _PLACE[1] + np.uint64(world + 1)
                found.append(mix(pair))
    return np.concatenate(found)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            yield part, list(shingle_sets(part.column("text")))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, set size, set hashes, and the low zone's shingles unless the task has met the same set before."""
    met: set[tuple[int, int]] = set()
    for part, sets in _read(batches):
        names, keys, sizes = [], [], []
        for s in sets:
            name = signature(s)
            names.append(name)
            keys.append(s[: 0 if name in met or len(s) <= 3 else np.searchsorted(s, ZONE)])
            sizes.append(len(s))
            met.add(name)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array([a for a, _ in names], pa.int64()),
                pa.array([b for _, b in names], pa.int64()),
                _lists(keys),
            ],
            ["doc_id", "n", "s", "t", "keys"],
        )


def bitmaps(rows: DataFrame, at: str, bits: int, **wanted: str) -> dict[str, np.ndarray]:
    """Bitmaps of ``bits`` bits over the column ``at``: for each name the rows that meet its condition.

    Aggregated by Spark to words of 64 bits; the driver gets ``bits / 64`` rows at most, whatever the input.
    """
    place = F.col(at).bitwiseAND(F.lit(bits - 1))
    held = rows.select(F.shiftright(place, 6).cast("int").alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"), *[F.expr(c).alias(n) for n, c in wanted.items()])
    one = F.expr("shiftleft(1L, bit)")
    found = held.groupBy("word").agg(*[F.bit_or(F.when(F.col(n), one).otherwise(F.lit(0).cast("long"))).alias(n) for n in wanted]).toArrow()
    out = {}
    for name in wanted:
        out[name] = np.zeros(bits // 64, np.uint64)
        out[name][found.column("word").to_numpy()] = found.column(name).to_numpy().astype(np.uint64)
    return out


def filled(bitmap: np.ndarray) -> float:
    return float(np.bitwise_count(bitmap).sum()) / (64 * len(bitmap))


def _shared(spark, arrays: dict[str, np.ndarray]):
    return spark.sparkContext.broadcast({k: v.tobytes() for k, v in arrays.items()})


def index(docs: DataFrame, shared) -> DataFrame:
    """``entry, s`` of all index entries, s being a hash of the set; a task indexes equal sets once."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, frequent = (np.frombuffer(shared.value[k], np.uint64) for k in ("twice", "frequent"))
        met: set[tuple[int, int]] = set()
        for _, sets in _read(batches):
            names, found = [], []
            for s in sets:
                name = signature(s)
                if name not in met:
                    met.add(name)
                    names.append(name[0])
                    found.append(entries(s, twice, frequent))
            if sum(map(len, found)):
                owner = np.repeat(np.array(names, np.int64), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64)), pa.array(owner)], ["entry", "s"])

    return docs.mapInArrow(write, "entry long, s long")


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs that may have an id of ``ids``: by a bitmap of fixed size, so the others' texts are not moved."""
    bitmap = bitmaps(ids.select(F.xxhash64("id").alias("h")), "h", ID_BITS, held="true")["held"]
    shared = _shared(docs.sparkSession, {"ids": bitmap})

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value["ids"], np.uint64)
        for batch in batches:
            at = batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64).astype(np.uint64)
            yield batch.filter(pa.array(has_bit(held, at))).drop_columns(["h"])

    return docs.withColumn("h", F.xxhash64("doc_id")).mapInArrow(pick, "doc_id long, text string")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, sets in _read(batches):
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).astype(np.int64))], ["key"])


def _met(docs: DataFrame) -> DataFrame:
    """``s, t, met``: how many of a text's shingles stand in another of these texts, or more (bitmap)."""
    counts = docs.mapInArrow(_tokens, "key long").groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    shared = _shared(docs.sparkSession, bitmaps(counts, "key", BITS, twice="true"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value["twice"], np.uint64)
        for _, sets in _read(batches):
            names = [signature(s) for s in sets]
            met = [int(has_bit(twice, s).sum()) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array(met, pa.int64())], ["s", "t", "met"])

    return docs.mapInArrow(count, "s long, t long, met long").groupBy("s", "t").agg(F.max("met").alias("met"))


def _paired(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with the hashes of their sets and texts of their smallest doc_ids."""
    held = pairs
    for side in ("a", "b"):
        held = held.join(sets.select(F.col("node").alias(side), F.col("s").alias(f"s_{side}"), F.col("rep").alias(f"rep_{side}")), side)
        held = held.join(texts.select(F.col("doc_id").alias(f"rep_{side}"), F.col("text").alias(f"text_{side}")), f"rep_{side}")
    return held.select("a", "b", "s_a", "s_b", "text_a", "text_b")


def _pairs_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[np.ndarray, np.ndarray]]]]:
    """Rows of ``_paired`` with their sets.  Where a doc_id has several texts, only those with the nodes' hashes count."""
    for batch in batches:
        for part in text_slices(batch, "text_a", 1 << 19):
            for some in text_slices(part, "text_b", 1 << 19):
                both = list(zip(shingle_sets(some.column("text_a")), shingle_sets(some.column("text_b")), strict=True))
                wanted = zip(some.column("s_a").to_pylist(), some.column("s_b").to_pylist(), strict=True)
                mask = [(signature(x)[0], signature(y)[0]) == s for (x, y), s in zip(both, wanted, strict=True)]
                yield some.select(["a", "b"]).filter(pa.array(mask, pa.bool_())), [xy for xy, held in zip(both, mask, strict=True) if held]


def verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, both in _pairs_of_sets(batches):
            yield rows.filter(pa.array([linked(x, y) for x, y in both], pa.bool_()))

    return _paired(pairs, sets, texts).mapInArrow(check, "a long, b long").distinct()


def differences(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """``hub, node, n, m, away, gone, fresh``: the difference of a node from its hub, as hashes with the hub.

    ``n`` and ``m`` are the sizes of node and hub, ``away`` says that they do not link, ``gone`` are shingles of the hub alone
    and ``fresh`` those of the node alone.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, both in _pairs_of_sets(batches):
            salts = rows.column("a").to_numpy(zero_copy_only=False).astype(np.uint64) * _PLACE[1]
            lists = {"gone": [], "fresh": []}
            for (hub, node), salt in zip(both, salts, strict=True):
                lists["gone"].append(mix(np.setdiff1d(hub, node, assume_unique=True) * _PLACE[0] + salt))
                lists["fresh"].append(mix(np.setdiff1d(node, hub, assume_unique=True) * _PLACE[0] + salt))
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns,
                    pa.array([len(node) for _, node in both], pa.int64()),
                    pa.array([len(hub) for hub, _ in both], pa.int64()),
                    pa.array([not linked(*xy) for xy in both], pa.bool_()),
                    *[_lists(found) for found in lists.values()],
                ],
                ["hub", "node", "n", "m", "away", *lists],
            )

    made = _paired(pairs.select(F.col("hub").alias("a"), F.col("node").alias("b")), sets, texts)
    return made.mapInArrow(compare, "hub long, node long, n long, m long, away boolean, gone array<long>, fresh array<long>")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.zeros(0, np.uint64)]).astype(np.int64)))


def difference_entries(gone: np.ndarray, fresh: np.ndarray, n: int, m: int, away: bool, twice: np.ndarray, often: np.ndarray):
    """Entries of a difference and whether they belong to the prefix, and how many of ``gone`` and ``fresh`` were seen twice.

    A node that does not link with the hub has entries beyond the prefix too.
    """
    tokens, prefix, held, left = _difference_order(gone, fresh, n, m, away, twice, often)
    return tokens[held], prefix[held], tuple(int(side.max(initial=0)) for side in left)


def left_entries(gone: np.ndarray, fresh: np.ndarray, n: int, m: int, away: bool, twice: np.ndarray, often: np.ndarray):
    """The entries of ``difference_entries``, and for each how many of ``gone`` and of ``fresh`` seen twice stand there or after it."""
    tokens, prefix, held, left = _difference_order(gone, fresh, n, m, away, twice, often)
    return tokens[held], prefix[held], *[side[held] for side in left]


def _difference_order(gone: np.ndarray, fresh: np.ndarray, n: int, m: int, away: bool, twice: np.ndarray, often: np.ndarray):
    tokens = np.concatenate([fresh, gone])
    seen = has_bit(twice, tokens)
    least = (m + 9 * len(tokens) - n) // 18 + 1
    order = np.argsort(np.where(seen, 1 + has_bit(often, tokens), 0), kind="stable")
    left = []
    for side in (np.arange(len(tokens)) >= len(fresh), np.arange(len(tokens)) < len(fresh)):
        counts = np.zeros(len(tokens), np.int64)
        counts[order] = np.cumsum((seen & side)[order][::-1])[::-1]
        left.append(counts)
    prefix = np.zeros(len(tokens), bool)
    if seen.sum() >= least:
        prefix[order[: len(tokens) - least + 1]] = True
    return tokens, prefix, seen & (prefix | away), left


def _crowded_pairs(crowded: DataFrame, sets: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links between nodes of crowded entries and their hubs, and the other pairs of these nodes that may link.

    ``crowded`` holds ``entry, node, c``, c being the node's component.
    """
    spark = crowded.sparkSession
    hubs = crowded.groupBy("entry").agg(F.min("node").alias("hub"))
    pairs = crowded.join(hubs, "entry").filter("hub <> node").select("hub", "node").distinct()
    told = stage(differences(pairs, sets, texts), "ngram-differences")
    keys = told.select(F.explode(F.concat("gone", "fresh")).alias("key")).groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    shared = _shared(spark, bitmaps(keys, "key", BITS, twice="true", often=f"df >= {OFTEN}"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, often = (np.frombuffer(shared.value[k], np.uint64) for k in ("twice", "often"))
        values = lambda column, k: column[k].values.to_numpy(zero_copy_only=False).astype(np.int64).astype(np.uint64)
        for batch in batches:
            found, sizes = [], []
            held = {name: batch.column(name) for name in ("gone", "fresh")}
            plain = zip(*[batch.column(name).to_pylist() for name in ("n", "m", "away")], strict=True)
            for k, (n, m, away) in enumerate(plain):
                found.append(left_entries(values(held["gone"], k), values(held["fresh"], k), n, m, away, twice, often))
                sizes.append(len(held["gone"][k]) + len(held["fresh"][k]))
            if not sum(len(entry) for entry, *_ in found):
                continue
            at = np.repeat(np.arange(batch.num_rows), [len(entry) for entry, *_ in found])
            entry, marks, gone, fresh = (np.concatenate(c) for c in zip(*found, strict=True))
            rows = batch.select(["node", "n", "away"]).take(pa.array(at))
            columns = [pa.array(entry.astype(np.int64)), *rows.columns, pa.array(marks), pa.array(np.array(sizes, np.int64)[at]), pa.array(gone), pa.array(fresh)]
            yield pa.RecordBatch.from_arrays(columns, ["entry", "node", "n", "away", "prefix", "d", "gone", "fresh"])

    listed = told.mapInArrow(write, "entry long, node long, n long, away boolean, prefix boolean, d long, gone long, fresh long")
    listed = stage(listed.join(crowded.select("node", "c").distinct(), "node"), "ngram-difference-index")
    sides = ("node", "n", "away", "prefix", "d", "gone", "fresh", "c")
    one = listed.filter("away").select("entry", *[F.col(x).alias(f"{x}_a") for x in sides])
    two = listed.filter("prefix").select("entry", *[F.col(x).alias(f"{x}_b") for x in sides])
    common = F.least("gone_a", "gone_b") + F.least("fresh_a", "fresh_b")
    open_ = (F.col("c_a") != F.col("c_b")) & (9 * (F.col("d_a") + F.col("d_b")) - F.col("n_a") - F.col("n_b") <= 18 * common)
    once = ~F.col("away_b") | (F.col("prefix_a") & (F.col("node_a") < F.col("node_b")))
    met = one.join(two, "entry").filter(open_ & once)
    met = met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    return told.filter("NOT away").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), met


def _spanning(placed: DataFrame) -> DataFrame:
    """The rows of ``entry, node, n, c`` whose entry has nodes of several components, with its number of ``nodes``."""
    ranges = placed.groupBy("entry").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("nodes")).filter("low < high")
    return placed.join(ranges.select("entry", "nodes"), "entry")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = stage(docs.mapInArrow(_describe, "doc_id long, n long, s long, t long, keys array<long>"), "ngram-sets")
    counts = described.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    found = bitmaps(counts, "key", BITS, twice="true", **{f"f{f}": f"df >= {f}" for f in FREQUENT})
    frequent = next((found[f"f{f}"] for f in FREQUENT if filled(found[f"f{f}"]) <= 1 / 16), found[f"f{FREQUENT[-1]}"])
    shared = _shared(spark, {"twice": found["twice"], "frequent": frequent})

    sets = described.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s", "t").agg(F.min("doc_id").alias("rep"))
    # numbered in the order of their smallest doc_id, so that the first document of a group is the hub of its entries
    sets = stage(sets.orderBy("rep", "s", "t").withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")
    members = stage(described.drop("keys").join(sets, ["n", "s", "t"], "left").select("doc_id", "n", "node"), "ngram-members")
    unstage(described)
    # sets that should share this hash would share their entries too: more candidates, no link lost
    listed = index(docs, shared).join(sets.select("s", "node", "n"), "s")
    listed = stage(listed.select("entry", "node", "n").distinct(), "ngram-index")
    hubs = listed.groupBy("entry").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("size")).filter("size > 1")
    buckets = stage(listed.join(hubs.select("entry", "hub"), "entry"), "ngram-buckets")
    unstage(listed)

    fits = lambda n, m: (100 * F.least(n, m) >= PERCENT * F.greatest(n, m))
    star = buckets.filter((F.col("node") != F.col("hub.node")) & fits(F.col("n"), F.col("hub.n")))
    star = star.groupBy("node", F.col("hub.node").alias("a")).agg(F.count("*").alias("shared"))
    first = star.groupBy("node").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a")).select("a", F.col("node").alias("b"))
    first = stage(first, "ngram-first")
    ids = buckets.select("node").join(sets, "node").select(F.col("rep").alias("id"))
    texts = stage(_among(docs, ids).withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"]).drop("h"), "ngram-texts")
    links = stage(verified(first, sets, texts), "ngram-links")
    # the texts of one doc_id belong together
    low = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("top")).filter("a < top")
    links = links.unionByName(members.join(low, "doc_id").filter("a <> node").select("a", F.col("node").alias("b")))
    joined = components(links)

    placed = buckets.join(joined, "node", "left").select("entry", "node", "n", F.coalesce("component", "node").alias("c"))
    placed = stage(_spanning(placed), "ngram-open")
    unstage(buckets)
    few, crowded = placed.filter(F.col("nodes") <= CROWD), placed.filter(F.col("nodes") > CROWD)
    # ids of crowded entries; a false positive of the bitmap is one more text to count
    left = stage(_among(texts, crowded.select("node").join(sets, "node").select(F.col("rep").alias("id"))), "ngram-left")
    # an intersection is at most met, and a set of n links with none below 4 / 5 * n
    viable = sets.join(_met(left), ["s", "t"]).filter((100 * F.col("met") >= PERCENT * F.col("n"))).select("node")
    crowded = stage(_spanning(crowded.join(viable, "node", "left_semi").drop("nodes")).select("entry", "node", "c"), "ngram-crowded")
    unstage(left)
    starred, met = _crowded_pairs(crowded, sets, texts)

    one, two = few.toDF("entry", "a", "n", "ca", "nodes"), few.toDF("entry", "b", "m", "cb", "nodes").drop("nodes")
    across = one.join(two, "entry").filter((F.col("ca") < F.col("cb")) & fits(F.col("n"), F.col("m"))).select("a", "b")
    across = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(met).distinct().join(first, ["a", "b"], "left_anti")
    more = stage(verified(stage(across, "ngram-across"), sets, texts).union(starred), "ngram-links")
    unstage(placed, texts)
    joined = components(links.union(more))

    placed = members.join(joined, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("c"))
    least = placed.filter("c IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "c", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document stays, one of each component: its smallest doc_id.  Rows with a null doc_id stay."""
    found = near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct()
    known = docs.filter("doc_id IS NOT NULL").join(found, "doc_id", "left_semi")
    return known.unionByName(docs.filter("doc_id IS NULL"))
