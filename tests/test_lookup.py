"""Lookups of many keys read the buckets and row groups of those keys only."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import store

ROWS, BUCKETS = 60_000, 4


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("laid"))
    rows = spark.range(ROWS).select(
        F.concat(F.lit("T"), F.format_string("%07d", F.col("id") * 2)).alias("trade_id"),
        F.lit(1).alias("version"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.block.size", 64 * 1024)  # many row groups
    store.write_hash_layout(rows, path, BUCKETS)
    spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    return spark.read.parquet(path)


def scanned(df):
    """(rows found, rows that left the scan of the store), by the scan's own metric."""
    found = [tuple(r) for r in df.select("trade_id", "version").collect()]
    plan = df._jdf.queryExecution()
    df._jdf.collectToPython()
    plan = plan.executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    metric = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return found, sum(m.get().value() for m in metric if m.isDefined())


def test_ids_read_their_row_groups_only(laid):
    found, read = scanned(store.lookup_ids(laid, ["T0000200", "T0001000", "T0090000"], BUCKETS))
    assert sorted(found) == [("T0000200", 1), ("T0001000", 1), ("T0090000", 1)]
    assert 0 < read < ROWS // 10


def test_ids_of_no_trade_are_refused_by_the_filters(laid):
    """Odd numbers lie between the ids that exist, so the least and largest id of a row group do not tell."""
    found, read = scanned(store.lookup_ids(laid, ["T0000201", "T0001001", "T0090001"], BUCKETS))
    assert found == [] and read < ROWS // 100


def test_no_ids_and_repeated_ids(laid):
    assert store.lookup_ids(laid, [], BUCKETS).count() == 0
    assert store.lookup_ids(laid, ["T0000200"] * 3, BUCKETS).count() == 1


def test_a_frame_of_keys_reads_its_buckets_only(spark, laid):
    wanted = spark.createDataFrame([("T0000200", 1), ("T0000200", 1), ("T0000200", 9), ("none", 1), (None, 1)], "trade_id string, version int")
    found = store.lookup_all(laid, wanted, BUCKETS)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert [r["trade_id"] for r in found.collect()] == ["T0000200"]
    plain = store.lookup_all(laid.drop("bucket"), wanted, BUCKETS)
    assert [r["trade_id"] for r in plain.collect()] == ["T0000200"]
