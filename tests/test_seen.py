"""Deduplication against all history, with filters beside an exact key log."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans.seen import SeenKeys

SCHEMA = "a string, b int, at int, v string"


@pytest.fixture
def seen(spark, tmp_path):
    return SeenKeys(spark, f"{tmp_path}/seen", ["a", "b"], buckets=4)


def admit(seen, rows, name):
    return sorted(tuple(r) for r in seen.admit(seen.spark.createDataFrame(rows, SCHEMA), name, ["at"]).collect())


def test_equals_brute_force_over_days(seen):
    rng, known = random.Random(2), set()
    for day in range(5):
        keys = [(rng.choice(["x", "y", None, "", "null"]), rng.choice([None, *range(60)])) for _ in range(150)]
        rows = [(*k, i, f"{day}-{i}") for i, k in enumerate(keys)]
        want = {}
        for row in rows:
            if row[:2] not in known:
                want.setdefault(row[:2], row)
        known |= set(want)
        key = lambda r: tuple((v is not None, v) for v in r)
        df = seen.spark.createDataFrame(rows, SCHEMA)
        got = [tuple(r) for r in seen.admit(df, f"day{day}", ["at"]).collect()]
        assert sorted(got, key=key) == sorted(want.values(), key=key)


def test_a_repeated_batch_gets_its_first_result(seen):
    first = admit(seen, [("x", 1, 1, "p"), ("x", 1, 2, "q"), ("y", 1, 1, "r")], "d1")
    assert first == [("x", 1, 1, "p"), ("y", 1, 1, "r")]
    assert admit(seen, [("x", 1, 1, "p"), ("z", 9, 9, "s")], "d1") == first
    assert admit(seen, [("x", 1, 1, "p"), ("z", 9, 9, "s")], "d2") == [("z", 9, 9, "s")]


def test_two_writers_let_a_key_through_once(seen, monkeypatch):
    other, mark, got = SeenKeys(seen.spark, seen.root, seen.keys, seen.buckets), seen._mark, []

    def late(name, content):
        if not got:
            got.append(admit(other, [("x", 1, 5, "other"), ("y", 1, 5, "other")], "other"))
        return mark(name, content)

    monkeypatch.setattr(seen, "_mark", late)
    assert admit(seen, [("x", 1, 1, "mine"), ("z", 1, 1, "mine")], "mine") == [("z", 1, 1, "mine")]
    assert got == [[("x", 1, 5, "other"), ("y", 1, 5, "other")]]


def test_a_stopped_batch_leaves_nothing(seen, monkeypatch):
    def stop(name, content):
        raise RuntimeError("stopped")

    monkeypatch.setattr(seen, "_mark", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        admit(seen, [("x", 1, 1, "p")], "d1")
    monkeypatch.undo()
    assert admit(seen, [("x", 1, 1, "p")], "d1") == [("x", 1, 1, "p")]


def test_keys_that_no_filter_knows_never_read_the_log(seen, monkeypatch):
    admit(seen, [("x", i, i, "p") for i in range(64)], "d1")
    strangers = [("q", 1000 + i, i, "n") for i in range(3)]
    batch = seen._keyed(seen.spark.createDataFrame(strangers, SCHEMA))
    held = seen.batches()
    attempts = [b["attempt"] for b in held.values()]
    assert seen.hits(batch, attempts, {b["attempt"]: b["blocks"] for b in held.values()}).isEmpty()
    monkeypatch.setattr(seen, "log", lambda attempts: pytest.fail("the log was read"))
    assert admit(seen, strangers, "d2") == sorted(strangers)


def test_only_folders_with_hits_are_read(seen):
    for day in range(3):
        admit(seen, [("x", 100 * day + i, i, "p") for i in range(80)], f"d{day}")
    held = seen.batches()
    attempts = [b["attempt"] for b in held.values()]
    batch = seen._keyed(seen.spark.createDataFrame([("x", 107, 1, "p")], SCHEMA))
    hits = seen.hits(batch, attempts, {b["attempt"]: b["blocks"] for b in held.values()})
    known = seen.known(hits, attempts)
    assert "dynamicpruning" in known._jdf.queryExecution().executedPlan().toString()
    assert known.count() == 1 and held[1]["attempt"] in {r["attempt"] for r in hits.collect()}


def test_most_strangers_miss_the_filters(seen):
    admit(seen, [("x", i, i, "p") for i in range(4000)], "d1")
    held = seen.batches()
    blocks = {b["attempt"]: b["blocks"] for b in held.values()}
    strangers = seen._keyed(seen.spark.range(20_000).select(F.lit("y").alias("a"), F.col("id").cast("int").alias("b")))
    assert seen.hits(strangers, list(blocks), blocks).count() < 400
    own = seen._keyed(seen.spark.range(4000).select(F.lit("x").alias("a"), F.col("id").cast("int").alias("b")))
    assert seen.hits(own, list(blocks), blocks).select("digest").distinct().count() == 4000


def test_empty_batches(seen):
    empty = seen.spark.createDataFrame([], SCHEMA)
    assert seen.admit(empty, "d0", ["at"]).collect() == []
    assert admit(seen, [("x", 1, 1, "p")], "d1") == [("x", 1, 1, "p")]
    assert seen.admit(empty, "d2", ["at"]).collect() == []
