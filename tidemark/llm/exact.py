"""Exact deduplication with owners held in Patricia tries.

Each text is normalised (runs of ASCII white space become one space) in the JVM.  A first pass inserts the full byte
strings of a scan task into a compressed radix trie whose terminal nodes keep the smallest identifier and a count, so a
text with very many copies leaves a task once.  Then the strings are dealt out by (length, content hash) and merged in
tries again, in the order of those keys: a trie's subtrees below a finished (length, hash) are complete and leave.  If a
scan task's trie grows beyond ``TRIE_BYTES``, its heaviest subtree leaves early as partial owners; the second pass adds them
up.  Equality is that of the full strings; the hash only deals them out.

Every document then finds its owner by the SHA-256 of its text, a join whose frequent keys Spark's adaptive skew join splits
(owners have one row per text).

Defined results: null counts as empty text; rows that repeat a doc_id with the same text are all kept if theirs is the
smallest doc_id (``keep_rows`` returns one of them); an empty table gives no rows; rows with a null doc_id own a text only if
no other row has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of strings that a scan task's trie holds before its heaviest subtree leaves.
TRIE_BYTES = 32 << 20

_OWNERS = "n_bytes long, hash long, sha string, body binary, owner long, copies long"


class Node:
    __slots__ = ("edge", "kids", "owner", "copies", "extra")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.kids: dict[int, Node] = {}
        self.owner: int | None = None
        self.copies = 0
        self.extra: tuple = ()


def smaller(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def shared_length(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` equal those of ``b`` from ``at`` on, by bisection on whole slices."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[at : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed radix trie of byte strings; a terminal node has the smallest owner and the number of copies."""

    def __init__(self):
        self.root = Node(b"")
        self.sizes: dict[int | None, int] = {}  # bytes below each child of the root; None for the empty string

    def insert(self, key: bytes, owner: int | None, copies: int, extra: tuple = ()) -> None:
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                kid = Node(key[at:])
                node.kids[key[at]] = kid
                self.sizes[key[0]] = self.sizes.get(key[0], 0) + len(key) - at + 200
                node, at = kid, len(key)
                break
            if not key.startswith(kid.edge, at):
                cut = shared_length(kid.edge, key, at)
                fork = Node(kid.edge[:cut])
                kid.edge = kid.edge[cut:]
                fork.kids[kid.edge[0]] = kid
                node.kids[key[at]] = fork
                kid = fork
            node, at = kid, at + len(kid.edge)
        node.owner = smaller(node.owner, owner) if node.copies else owner
        node.copies += copies
        node.extra = node.extra or extra

    @property
    def bytes(self) -> int:
        return sum(self.sizes.values())

    def drain(self, first: int | None = None) -> Iterator[tuple[bytes, Node]]:
        """Remove and return the strings below the root's child ``first``, or all."""
        if first is None:
            todo = [(b"", self.root)]
            self.root, self.sizes = Node(b""), {}
        else:
            todo = [(b"", self.root.kids.pop(first))]
            self.sizes.pop(first)
        while todo:
            path, node = todo.pop()
            whole = path + node.edge
            if node.copies:
                yield whole, node
            todo.extend((whole, kid) for kid in node.kids.values())


def _rows(found: Iterator[tuple[bytes, Node]], with_body: bool = True) -> Iterator[pa.RecordBatch]:
    """Arrow batches of owners; ``extra`` is (n_bytes, hash, sha)."""
    held: list[tuple] = []
    size = 0
    for body, node in found:
        held.append((*node.extra, body if with_body else None, node.owner, node.copies))
        size += len(body)
        if size > 4 << 20 or len(held) >= 5_000:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
    names = ["n_bytes", "hash", "sha", "body", "owner", "copies"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, 500)
            yield from zip(*(part.column(n).to_pylist() for n in part.schema.names), strict=True)
            at += 500


def own_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners among the rows of one scan task, whole or in parts."""
    trie = Trie()
    for n_bytes, hashed, sha, body, owner, copies in _tuples(batches):
        trie.insert(body, owner, copies, (n_bytes, hashed, sha))
        while trie.bytes > TRIE_BYTES and trie.root.kids:
            heaviest = max((k for k in trie.sizes if k is not None), key=trie.sizes.get)
            yield from _rows(trie.drain(heaviest))
    yield from _rows(trie.drain())


def own_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners of a partition sorted by (length, hash): finished subtrees leave as soon as the next key comes."""

    def finished() -> Iterator[tuple[bytes, Node]]:
        trie, key = Trie(), None
        for n_bytes, hashed, sha, body, owner, copies in _tuples(batches):
            if key != (n_bytes, hashed):
                yield from trie.drain()
                key = (n_bytes, hashed)
            trie.insert(body, owner, copies, (n_bytes, hashed, sha))
        yield from trie.drain()

    yield from _rows(finished(), with_body=False)


def normalised(text) -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def owners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct normalised text: ``sha, keep_id, group_size``."""
    body = docs.select(F.col(doc_id).cast("long").alias("owner"), normalised(text).alias("body"))
    keyed = body.select(
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.xxhash64("body").alias("hash"),
        F.sha2("body", 256).alias("sha"),
        F.col("body").cast("binary").alias("body"),
        "owner",
        F.lit(1).cast("long").alias("copies"),
    )
    partial = keyed.mapInArrow(own_in_task, _OWNERS)
    dealt = partial.repartition("n_bytes", "hash").sortWithinPartitions("n_bytes", "hash")
    merged = dealt.mapInArrow(own_in_order, _OWNERS)
    return merged.select("sha", F.col("owner").alias("keep_id"), F.col("copies").alias("group_size"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normalised("text"), 256).alias("sha"))
    return hashed.join(owners(docs), "sha").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows with one doc_id and one text, one stays."""
    best = owners(docs).select(F.col("keep_id").alias("__id"), F.col("sha").alias("__sha"))
    marked = docs.withColumn("__sha", F.sha2(normalised("text"), 256))
    held = marked.join(best, marked["doc_id"].eqNullSafe(best["__id"]) & (marked["__sha"] == best["__sha"]), "left_semi")
    return held.dropDuplicates(["doc_id", "__sha"]).drop("__sha")
