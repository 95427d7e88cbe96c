"""Reconciliation by digests, and the stream tier on Spark's state store."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests, version_rules
from tidemark.streaming import state

KEYS, COLUMNS = ["k", "n"], ["a", "b"]


def brute(sides):
    out = {}
    for key in set().union(*sides.values()):
        rows = {s: v[key] for s, v in sides.items() if key in v}
        missing = ",".join(s for s in sides if s not in rows)
        differing = ",".join(c for i, c in enumerate(COLUMNS) if len({r[i] for r in rows.values()}) > 1)
        if missing or differing:
            out[key] = (missing, differing)
    return out


def write(spark, tmp_path, sides, **sizes):
    paths = {}
    for name, rows in sides.items():
        paths[name] = f"{tmp_path}/{name}"
        df = spark.createDataFrame([(*key, *row) for key, row in rows.items()], "k string, n int, a string, b int")
        digests.write_side(df, paths[name], KEYS, COLUMNS, **sizes)
    return paths


@pytest.mark.parametrize("sizes", [{}, {"buckets": 4, "leaves": 2}])
def test_sides_equal_brute_force(spark, tmp_path, sizes):
    rng = random.Random(1)
    base = {(f"k{i % 97}", i): (rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for i in range(600)}
    sides = {name: dict(base) for name in ("stream", "store", "snapshot")}
    for side in sides.values():
        for key in rng.sample(sorted(base), 6):
            del side[key]
        for key in rng.sample(sorted(side), 6):
            side[key] = (rng.choice(["x", "z", None]), rng.choice([1, 7, None]))
    sides["store"][("new", 1)] = (None, None)
    swapped, keep = ("swap", 1), base[("k0", 0)]
    sides["stream"][swapped], sides["store"][swapped], sides["snapshot"][swapped] = ("1", None), (None, 1), keep
    found = digests.reconcile_sides(spark, write(spark, tmp_path, sides, **sizes), KEYS, COLUMNS)
    assert {(r["k"], r["n"]): (r["missing"], r["differing"]) for r in found.collect()} == brute(sides)


def test_only_differing_buckets_are_read(spark, tmp_path):
    base = {(f"k{i}", i): ("x", i) for i in range(3000)}
    sides = {name: dict(base) for name in ("stream", "store", "snapshot")}
    sides["store"][("k7", 7)] = ("other", 7)
    paths = write(spark, tmp_path, sides, buckets=32, leaves=8)
    told = {name: spark.read.parquet(f"{path}/digests") for name, path in paths.items()}
    assert digests.differing_leaves(told).count() == 1
    found = digests.reconcile_sides(spark, paths, KEYS, COLUMNS)
    assert [tuple(r) for r in found.collect()] == [("k7", 7, "", "a")]
    plan = found._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    read = []

    def walk(node):
        if node.getClass().getSimpleName() == "FileSourceScanExec" and node.toString().count("dynamicpruning"):
            read.append(node.metrics().apply("numOutputRows").value())
        for name in ("plan", "executedPlan", "inputPlan"):
            try:
                walk(getattr(node, name)())
            except Exception:  # noqa: BLE001 - a node without that child
                pass
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    # three sides of one bucket of 32, not 9,000 rows
    assert read and sum(read) < 9000 / 8


def test_equal_sides_and_empty_sides(spark, tmp_path):
    base = {(f"k{i}", i): ("x", None) for i in range(50)}
    same = write(spark, tmp_path / "same", {"one": base, "two": dict(base)})
    assert digests.reconcile_sides(spark, same, KEYS, COLUMNS).count() == 0
    empty = write(spark, tmp_path / "empty", {"one": base, "two": {}})
    assert {r["missing"] for r in digests.reconcile_sides(spark, empty, KEYS, COLUMNS).collect()} == {"two"}


TODAY = datetime.date(2025, 6, 1)


def test_keyed_state_equals_the_batch_rule_for_any_split_and_restart(spark, tmp_path):
    state.use_rocksdb(spark)
    rng = random.Random(2)
    rows = [(f"T{rng.randrange(12)}", rng.randrange(1, 6), TODAY + datetime.timedelta(days=rng.randrange(-3, 4)), n) for n in range(240)]
    schema = "trade_id string, version int, maturity_date date, arrival int"
    whole = version_rules.prefilter(spark.createDataFrame(rows, schema), ["arrival"], F.lit(TODAY))
    want = {r["arrival"]: (r["reason"], r["seen_version"]) for r in whole.collect()}
    for number, cuts in enumerate([[240], [30, 31, 200, 240]]):
        root, start = f"{tmp_path}/{number}", 0
        for k, end in enumerate(cuts):
            # rows of a batch come in no order; the query is stopped and started again for each piece
            piece = rows[start:end]
            rng.shuffle(piece)
            spark.createDataFrame(piece, schema).coalesce(1).write.parquet(f"{root}/landing/{k:04d}")
            stream = spark.readStream.schema(schema).parquet(f"{root}/landing/*")
            judged = state.stateful_prefilter(stream, ["arrival"], F.lit(TODAY))
            writer = judged.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
            writer.trigger(availableNow=True).start().awaitTermination()
            start = end
        got = {r["arrival"]: (r["reason"], r["seen_version"]) for r in spark.read.parquet(f"{root}/out").collect()}
        assert got == want
    assert {r for r, _ in want.values()} == {None, *(x for x in version_rules.PREFILTER_REASONS.values())}


def test_keyed_state_is_called_by_group_not_by_trade():
    """Many trades share a call and a state: one read and one write of state for all of a group's trades in a batch."""

    class Held:
        value, reads, writes = None, 0, 0

        def get(self):
            self.reads += 1
            return self.value

        def update(self, value):
            self.value, self.writes = value, self.writes + 1

    rows = pd.DataFrame({"trade_id": [f"T{n % 500}" for n in range(1_000)], "version": [n // 500 for n in range(1_000)], "arrival": range(1_000), "matured": True})
    mark = state.TideMark(["arrival"], ["trade_id", "version", "arrival"])
    mark.marks = Held()
    first, again = (pd.concat(mark.handleInputRows((0,), iter([rows.iloc[600:], rows.iloc[:600]]), None)) for _ in range(2))
    assert (mark.marks.reads, mark.marks.writes) == (2, 1)
    assert first["seen_version"].isna().sum() == 500 and first["reason"].isna().all()
    assert set(again["seen_version"]) == {1} and again["reason"].notna().all()
