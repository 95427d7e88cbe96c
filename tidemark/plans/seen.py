"""Exact deduplication against all history: every key counts once, however long ago it came first.

Layout under the root, ``N`` numbering the batches in the order of their commits:

==========================================  ==============================================================
``keys/attempt=U/bucket=B/``                the keys that an attempt ``U`` of a batch saw first, by hash bucket
``filters/attempt=U/bucket=B/``             a Bloom filter of the same keys, a row per block of 256 bits
``fresh/attempt=U/``                        the batch's rows that were let through
``batches/N``                               marker of the N-th batch: its name, its attempt
==========================================  ==============================================================

A batch meets the filters, of which it reads the blocks' rows only; the key log is read in the buckets of those batches where
a filter says that a key may stand (dynamic pruning), and not at all where none does.  The log decides, so a false positive of
a filter costs a read and never a row.  A marker publishes keys, filter and rows of an attempt together: a stopped batch leaves
nothing, a repeated one finds its name and gets the rows of its first run, and of two writers at once the later one starts again
from the state that the other one left.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import PARTITIONS
from tidemark.plans.markers import Markers
from tidemark.session import no_rows, written

#: Longs of a filter block, and bits that a key sets in it: one in each long.
WORDS = 4
_WORDS = [f"w{i}" for i in range(WORDS)]
#: Keys a block is meant for: 256 bits with four of them set by each; about one stranger in 400 passes a full block.
KEYS_PER_BLOCK = 16


def _marks(hash_: Column) -> list[Column]:
    """The bit of each long that a key sets: six bits of its hash for every long."""
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hash_, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORDS)]


class SeenKeys(Markers):
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = PARTITIONS):
        """``buckets`` is fixed for the life of a log."""
        super().__init__(spark, root)
        self.keys = list(keys)
        self.buckets = buckets

    def _keyed(self, df: DataFrame) -> DataFrame:
        """Add ``digest`` (128 bits of the key, nulls told apart), ``bucket`` and ``mix``, which no block shares its bits with."""
        told = F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(self.keys)]))
        digest = F.unhex(F.md5(told))
        return (
            df.withColumn("digest", digest)
            .withColumn("mix", F.xxhash64("digest"))
            .withColumn("bucket", F.pmod(F.hash("digest"), F.lit(self.buckets)).cast("int"))
        )

    def batches(self) -> dict[int, dict]:
        return self._markers("batches")

    def _read(self, kind: str, attempts: Sequence[str], schema: str) -> DataFrame:
        laid = T.StructType.fromDDL(f"{schema}, attempt string, bucket int")
        paths = [f"{self.root}/{kind}/attempt={a}" for a in attempts]
        if not paths:
            return no_rows(self.spark, laid)
        return self.spark.read.schema(laid).option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def log(self, attempts: Sequence[str]) -> DataFrame:
        return self._read("keys", attempts, "digest binary")

    def hits(self, keyed: DataFrame, attempts: Sequence[str], blocks: dict[str, int]) -> DataFrame:
        """``digest, attempt, bucket`` of the keys that may stand in an earlier batch.

        Batches with equally many blocks share a join; as block numbers are powers of two, there are few such joins.
        """
        found = no_rows(self.spark, "digest binary, attempt string, bucket int")
        words = ", ".join(f"{w} bigint" for w in _WORDS)
        for count in sorted({blocks[a] for a in attempts}):
            filters = self._read("filters", [a for a in attempts if blocks[a] == count], f"block bigint, {words}")
            probe = keyed.select("digest", "bucket", self._block(count).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_marks(F.col("mix")))])
            passed = F.lit(True)
            for i, w in enumerate(_WORDS):
                passed &= F.col(w).bitwiseAND(F.col(f"m{i}")) != 0
            found = found.unionAll(probe.join(filters, ["bucket", "block"]).filter(passed).select("digest", "attempt", "bucket"))
        return found

    @staticmethod
    def _block(count: int) -> Column:
        return F.shiftrightunsigned("mix", 6 * WORDS).bitwiseAND(F.lit(count - 1).cast("long"))

    def known(self, hits: DataFrame, attempts: Sequence[str]) -> DataFrame:
        """The digests of ``hits`` that the log confirms; only folders that hits name are read."""
        # a row per folder at most; as a comparison, since Spark prunes folders only by conditions that it takes for selective
        wanted = F.broadcast(hits.groupBy("attempt", "bucket").agg(F.count(F.lit(1)).alias("hits")).filter("hits > 0"))
        near = self.log(attempts).join(wanted, ["attempt", "bucket"], "left_semi")
        return hits.join(near, ["attempt", "bucket", "digest"], "left_semi").select("digest").distinct()

    def _result(self, attempt: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/fresh/attempt={attempt}")

    def admit(self, batch: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
        """The first row by ``order`` of every key of the batch that no batch before it had; null is a key like others."""
        first = F.min_by(F.struct(*batch.columns), F.struct(*order)).alias("row")
        firsts = written(self._keyed(batch).groupBy("digest", "mix", "bucket").agg(first), "seen-firsts")
        while True:
            before = self.batches()
            done = [b["attempt"] for b in before.values() if b["name"] == name]
            if done:
                return self._result(done[0], batch.schema)
            attempts = [b["attempt"] for b in before.values()]
            hits = written(self.hits(firsts, attempts, {b["attempt"]: b["blocks"] for b in before.values()}), "seen-hits")
            fresh = firsts if hits.isEmpty() else firsts.join(self.known(hits, attempts), "digest", "left_anti")
            content = self._write(name, written(fresh, "seen-fresh"))
            if self._mark(f"batches/{max(before, default=-1) + 1}", content):
                return self._result(content["attempt"], batch.schema)
            path, files = self._files()
            for kind in ("keys", "filters", "fresh"):
                files.delete(path(f"{self.root}/{kind}/attempt={content['attempt']}"), True)

    def _write(self, name: str, fresh: DataFrame) -> dict:
        attempt = uuid.uuid4().hex
        # blocks of one bucket, a power of two
        per_bucket = fresh.count() / self.buckets / KEYS_PER_BLOCK
        blocks = 1 << max(0, int(per_bucket)).bit_length()
        laid = fresh.select("digest", "bucket").hint("rebalance", "bucket")
        laid.write.partitionBy("bucket").parquet(f"{self.root}/keys/attempt={attempt}")
        bits = [F.bit_or(m).alias(w) for w, m in zip(_WORDS, _marks(F.col("mix")), strict=True)]
        filters = fresh.groupBy("bucket", self._block(blocks).alias("block")).agg(*bits).hint("rebalance", "bucket")
        filters.write.partitionBy("bucket").parquet(f"{self.root}/filters/attempt={attempt}")
        fresh.select("row.*").write.parquet(f"{self.root}/fresh/attempt={attempt}")
        return {"name": name, "attempt": attempt, "blocks": blocks}
