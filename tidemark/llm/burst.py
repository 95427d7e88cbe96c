"""Prefix trie of conversations, built as a burst trie over shards.

A turn becomes a cell of 16 bytes: 12 of a SHA-256 digest of its role and text, and the text's length in code points.  A
conversation is the string of its cells, so slices, order and common prefixes of conversations are those of byte strings.
Conversations with equal cells become one row with their number and smallest id first, so copies take no part in what follows.

Containers hold the rest of conversations under a head, the cells that lead to them; the first is the root's.  In each round,
containers whose rests have more than ``CONTAINER`` cells burst: the head is prolonged by the prefix that all their rows
share, known from the smallest and the largest of them, and each row goes to the container of its next turn.  So every round
splits what it touches, other containers are left alone, and a long common history costs one round, not one per turn.
What remains is dealt to shards by container, sorted, and swept: rows in order need a stack of open nodes alone, and every
common prefix of neighbours is a node.  Nodes above containers come from the bursts, with the sums of the containers below.

Memory: a sweep holds the nodes of one container, which are at most ``CONTAINER`` or those of a single conversation; that one
conversation's cells (16 bytes a turn) fit into a row is assumed.  Ids of equal conversations are hashed in order from sorted
blocks of neighbouring ids, as a stream.

Defined results: rows with a null conv_id take no part; turns with equal number are ordered by role, then text; repeated rows
are turns each; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

CELL = 16
#: Cells of a container's rests above which it bursts.
CONTAINER = 8_192
#: Neighbouring ids that are written as one block.
ID_BITS = 12

NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_ROOT = "root"


def _cell(role: Column, text: Column) -> Column:
    """The 32 hex digits of a turn's cell."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(told, 256), 1, 2 * CELL - 8), F.lpad(F.lower(F.hex(F.length(text))), 8, "0"))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, cells``: the turns of each conversation in order, as one binary string."""
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    cells = turns.select("conv_id", F.row_number().over(order).alias("at"), _cell(F.col("role"), F.col("text")).alias("cell"))
    listed = cells.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "cell"))).alias("c"))
    return listed.select("conv_id", F.unhex(F.array_join("c.cell", "")).alias("cells"))


def rebuilt(own: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations as the contract of the query has them: some first turns come from the group's first conversation."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most * CELL).cast("int")
    keyed = own.select("conv_id", "cells", taken.alias("taken"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    heads = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.substring("cells", 1, (most - 1) * CELL).alias("head"))
    joined = keyed.join(heads, "base", "left")
    first = F.coalesce(F.substring(F.col("head"), F.lit(1), F.col("taken")), F.unhex(F.lit("")))
    rest = F.substring(F.col("cells"), F.col("taken") + 1, F.length("cells"))
    return joined.select("conv_id", F.concat(first, rest).alias("cells"))


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (seq, block, ids) in order; the digest of each seq's ids joined by commas."""
    seq, digest = None, None
    for batch in batches:
        names, digests = [], []
        for name, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if name != seq:
                if digest is not None:
                    names.append(seq)
                    digests.append(digest.hexdigest())
                seq, digest = name, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pydict({"seq": pa.array(names, pa.string()), "ends": pa.array(digests, pa.string())})
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"seq": [seq], "ends": [digest.hexdigest()]})


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """``cells, n, conv, ends``: every distinct sequence with its conversations' number, smallest id and digest of ids."""
    named = stage(convs.withColumn("seq", F.md5("cells")), "trie-convs")
    blocks = named.groupBy("seq", F.shiftright("conv_id", ID_BITS).alias("block")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv"), F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    blocks = stage(blocks, "trie-ids")
    sums = blocks.groupBy("seq").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"))
    ordered = blocks.select("seq", "block", "ids").repartition("seq").sortWithinPartitions("seq", "block")
    hashed = ordered.mapInArrow(_hash_ids, "seq string, ends string")
    first = named.select(F.col("conv_id").alias("conv"), "seq", "cells")
    return sums.join(hashed, "seq").join(first, ["seq", "conv"]).select("cells", "n", "conv", "ends")


def _shared_cells(lo: str, hi: str, start: Column) -> Column:
    """How many cells two strings share after the first ``start`` cells, both having at least these."""
    least = F.least(F.length(lo), F.length(hi)) / CELL
    at = lambda name, k: F.substring(F.col(name), k * CELL + 1, F.lit(CELL))
    places = F.when(least > start, F.sequence(start, (least - 1).cast("int")))
    differs = F.filter(places, lambda k: at(lo, k) != at(hi, k))
    return F.coalesce(F.get(differs, F.lit(0)), least.cast("int")) - start


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (head, cells): the nodes of each container from its top down."""
    head, depth, path, above = None, 0, None, None
    last, stack, nodes = b"", [], []  # a node: depth, parent, n, conv, children, leaves, saved, ends
    found: list[tuple] = []

    def close(left: int) -> None:
        while len(stack) > left:
            node = stack.pop()
            length = int.from_bytes(last[CELL * node[0] - 4 : CELL * node[0]]) if node[0] else 0
            node[5] = node[5] or 1
            node[6] += (node[2] - 1) * length
            if stack:
                up = stack[-1]
                up[2] += node[2]
                up[3] = min(up[3], node[3])
                up[4] += 1
                up[5] += node[5]
                up[6] += node[6]
                node[1] = up

    def flush() -> None:
        close(0)
        for k, (d, up, n, conv, children, leaves, saved, ends) in enumerate(nodes):
            found.append((conv, d, above if up is None else up[3], n, children, leaves, saved, ends, None if k else path))
        nodes.clear()

    schema = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "path"]
    types = [*[pa.int64()] * 7, pa.string(), pa.list_(pa.string())]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema)

    for batch in batches:
        for row in batch.to_pylist():
            cells = row["cells"]
            if row["head"] != head:
                flush()
                head, depth, path, above = row["head"], row["depth"], row["path"], row["above"]
                shared = depth - 1
            else:
                shared, most = depth, min(len(last), len(cells)) // CELL
                while shared < most and last[CELL * shared : CELL * shared + CELL] == cells[CELL * shared : CELL * shared + CELL]:
                    shared += 1
                close(shared - depth + 1)
            for d in range(shared + 1, len(cells) // CELL + 1):
                node = [d, None, 0, row["conv"], 0, 0, 0, NO_ENDS]
                stack.append(node)
                nodes.append(node)
            end = stack[-1]
            end[2] += row["n"]
            end[3] = min(end[3], row["conv"])
            end[7] = row["ends"]
            last = cells
        yield batch_of(found)
        found.clear()
    flush()
    yield batch_of(found)


def prefix_trie(convs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id unique, cells): the columns of the query's contract."""
    rows = distinct_sequences(convs).select(
        F.lit(_ROOT).alias("head"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("above"), F.array().cast("array<string>").alias("path"), "cells", "n", "conv", "ends"
    )
    rest, done, bursts, ended = stage(rows, "trie-rows"), [], [], []
    while True:
        size = F.length("cells") / CELL - F.col("depth") + 1
        info = [F.first(c).alias(c) for c in ("depth", "above", "path")]
        held = rest.groupBy("head").agg(
            *info, F.count("*").alias("rows"), F.sum(size).alias("size"), F.min("cells").alias("lo"), F.max("cells").alias("hi"), F.sum("n").alias("n"), F.min("conv").alias("conv")
        )
        big = held.filter((F.col("rows") > 1) & (F.col("size") > container))
        big = stage(big.withColumn("bottom", F.col("depth") + _shared_cells("lo", "hi", F.col("depth"))).drop("rows", "size", "hi"), "trie-bursts")
        done.append(rest.join(big.select("head"), "head", "left_anti"))
        if not big.limit(1).count():
            break
        split = rest.join(big.select("head", "bottom", F.col("conv").alias("least")), "head")
        ends_here = F.length("cells") == F.col("bottom") * CELL
        onward = split.filter(~ends_here)
        deeper = F.col("bottom") + 1
        moved = onward.select(
            F.md5(F.substring(F.col("cells"), F.lit(1), deeper * CELL)).alias("head"), deeper.alias("depth"), F.col("least").alias("above"), F.concat("path", F.array("head")).alias("path"), "cells", "n", "conv", "ends"
        )
        ended.append(split.filter(ends_here).select("head", "ends"))
        rest = stage(moved, "trie-rows")
        branches = rest.select(F.element_at("path", -1).alias("up"), "head").distinct().groupBy("up").agg(F.count("*").alias("children"))
        bursts.append(stage(big.join(branches, F.col("head") == F.col("up")).drop("up"), "trie-heads"))

    waiting = done[0]
    for more in done[1:]:
        waiting = waiting.unionByName(more)
    shards = waiting.repartition("head").sortWithinPartitions("head", "cells")
    nodes = stage(shards.mapInArrow(_sweep, f"{_NODE}, path array<string>"), "trie-nodes")
    below = nodes.drop("path")
    if not bursts:
        return below

    heads, last = bursts[0], ended[0]
    for more, ends in zip(bursts[1:], ended[1:], strict=True):
        heads, last = heads.unionByName(more), last.unionByName(ends)
    # the nodes of a burst container down to where its rows part, each with the length of its last text
    chain = heads.select("*", F.explode(F.sequence("depth", "bottom")).alias("d"))
    digits = F.hex(F.substring(F.col("lo"), F.col("d") * CELL - 3, F.lit(4)))
    length = F.when(F.col("d") > 0, F.conv(digits, 16, 10).cast("long")).otherwise(0)
    chain = stage(chain.withColumn("own", (F.col("n") - 1) * length).drop("lo"), "trie-chains")
    # sums over containers and chains below, by the heads that lead to them
    parts = nodes.filter("path IS NOT NULL").select(F.explode("path").alias("head"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    own = chain.groupBy("head").agg(F.first("path").alias("path"), F.sum("own").alias("saved"))
    parts = parts.unionByName(own.select(F.explode(F.concat("path", F.array("head"))).alias("head"), F.lit(0).cast("long").alias("leaves"), "saved"))
    totals = parts.groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    before = Window.partitionBy("head").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    chain = chain.withColumn("spent", F.coalesce(F.sum("own").over(before), F.lit(0).cast("long")))
    chain = chain.join(totals, "head").join(last, "head", "left")
    bottom = F.col("d") == F.col("bottom")
    top = chain.select(
        F.col("conv").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") == F.col("depth"), F.col("above")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - F.col("spent")).alias("saved_tokens"),
        F.when(bottom, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
    )
    return top.unionByName(below)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuilt(stage(sequences(conversations), "trie-sequences")))
