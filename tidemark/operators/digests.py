"""Reconciliation of any number of sides by digests of buckets.

A side is written once by buckets of its keys, with a digest table beside it: for every bucket and leaf (a bucket's
sub-bucket) the number of rows and two order-free sums of row hashes.  Sides are compared by these small tables first, buckets
before leaves; only rows of leaves that differ are read, by dynamic pruning of the bucket folders, and only their rows move.
On a day when all agree, no row is read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
LEAVES = 64
_SUMS = ["rows", "parity", "total"]


def _places(keys: Sequence[str], buckets: int, leaves: int) -> dict[str, Column]:
    h = F.xxhash64(*keys)
    return {"bucket": F.pmod(h, F.lit(buckets)).cast("int"), "leaf": F.pmod(F.shiftrightunsigned(h, 32), F.lit(leaves)).cast("int")}


def leaf_digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``bucket, leaf, rows, parity, total`` of placed rows: reduced before the shuffle, whatever the size of a leaf."""
    # a null and its neighbour's value must not change places unseen, so nulls are hashed as such
    told = [F.struct(F.col(c).isNull(), F.col(c)) for c in columns]
    hashed = rows.select("bucket", "leaf", F.xxhash64(*told).alias("h"))
    return hashed.groupBy("bucket", "leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("parity"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("total")
    )


def write_side(df: DataFrame, path: str, keys: Sequence[str], compare: Sequence[str], buckets: int = BUCKETS, leaves: int = LEAVES) -> None:
    """Write a side's rows by bucket, and its digests.  All sides need the same keys, columns, types and numbers."""
    rows = df.select(*keys, *compare).withColumns(_places(keys, buckets, leaves))
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    # an empty side has no row files to tell its schema
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/schema")
    held = _rows(df.sparkSession, path)
    leaf_digests(held, [*keys, *compare]).write.mode("overwrite").parquet(f"{path}/digests")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def _unequal(told: DataFrame, by: Sequence[str], sides: int) -> DataFrame:
    """Groups in which not all sides say the same; a side without rows says nothing."""
    unlike = (F.count(F.lit(1)) != sides).cast("int")
    for c in _SUMS:
        unlike += (F.min(c) != F.max(c)).cast("int")
    # as a comparison: Spark prunes folders only by conditions that it takes for selective
    return told.groupBy(*by).agg(unlike.alias("unlike")).filter("unlike > 0").select(*by)


def differing_leaves(digests: Mapping[str, DataFrame]) -> DataFrame:
    """``bucket, leaf`` of the leaves that are not equal in all sides: buckets are compared first, then leaves of unequal ones."""
    told = None
    for name, df in digests.items():
        one = df.select(F.lit(name).alias("side"), "bucket", "leaf", *_SUMS)
        told = one if told is None else told.unionByName(one)
    top = told.groupBy("side", "bucket").agg(F.sum("rows").alias("rows"), F.bit_xor("parity").alias("parity"), F.sum("total").alias("total"))
    within = told.join(_unequal(top, ["bucket"], len(digests)), "bucket", "left_semi")
    return _unequal(within, ["bucket", "leaf"], len(digests))


def reconcile_sides(spark: SparkSession, paths: Mapping[str, str], keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Mismatches of sides as of ``write_side``: keys, ``missing`` (sides without the key) and ``differing`` (columns), comma-joined.

    Columns differ if the sides that have the key do not all hold the same value; null equals null.  Keys are unique in a side.
    """
    differ = differing_leaves({name: spark.read.parquet(f"{path}/digests") for name, path in paths.items()})
    # at most buckets x leaves rows of two numbers
    differ = F.broadcast(differ)
    rows = None
    for name, path in paths.items():
        side = _rows(spark, path).join(differ, ["bucket", "leaf"], "left_semi")
        side = side.select(*keys, F.lit(name).alias("side"), *compare)
        rows = side if rows is None else rows.unionByName(side)
    # one variant of a value if all agree; a key has at most one row a side
    variants = [F.size(F.collect_set(F.struct(F.col(c)))).alias(f"_{k}") for k, c in enumerate(compare)]
    held = rows.groupBy(*keys).agg(F.collect_set("side").alias("_sides"), *variants)
    absent = F.array_except(F.array(*[F.lit(s) for s in paths]), "_sides")
    unlike = F.filter(F.array(*[F.when(F.col(f"_{k}") > 1, F.lit(c)) for k, c in enumerate(compare)]).cast("array<string>"), lambda c: c.isNotNull())
    found = held.select(*keys, F.array_join(absent, ",").alias("missing"), F.array_join(unlike, ",").alias("differing"))
    return found.filter("missing <> '' OR differing <> ''")
