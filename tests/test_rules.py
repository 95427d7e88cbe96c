"""The window form of the rules against fixed cases and against a record-by-record simulation."""

import datetime
import random

import pytest
import sequential as seq
from pyspark.sql import functions as F

from tidemark.functions.envelope import DB_GUARDRAIL, RULE_1, RULE_2
from tidemark.operators import marks, store, version_rules
from tidemark.schemas import LEVELS, STORE, TRADE

TODAY = datetime.date(2025, 6, 1)
DAY = datetime.timedelta(days=1)


def trades_df(spark, rows):
    """rows of (trade_id, version, maturity, arrival)."""
    data = [(t, v, "CP", "B", m, TODAY, "{}", n) for t, v, m, n in rows]
    return spark.createDataFrame(data, TRADE.simpleString()[7:-1] + ",arrival:bigint")


def state_df(spark, seen):
    return spark.createDataFrame([("T1", seen, None)] if seen is not None else [], LEVELS)


@pytest.mark.parametrize(
    "state, version, maturity, reason, after",
    [
        (None, 1, TODAY + 10 * DAY, None, 1),
        (5, 3, TODAY + 10 * DAY, RULE_1, 5),
        (2, 2, TODAY - DAY, RULE_2, 2),
        (2, 2, TODAY, None, 2),
        (None, 1, TODAY - DAY, None, 1),
        (2, 2, None, None, 2),
    ],
)
def test_prefilter_cases(spark, state, version, maturity, reason, after):
    df = trades_df(spark, [("T1", version, maturity, 1)])
    row = version_rules.prefilter(df, ["arrival"], F.lit(TODAY), state_df(spark, state)).first()
    assert row["reason"] == reason
    assert max(v for v in (row["seen_version"], row["version"] if reason is None else None) if v is not None) == after


def test_accepted_then_lower_and_matured(spark):
    rows = [("T1", 1, TODAY + DAY, 1), ("T1", 0, TODAY + DAY, 2), ("T1", 1, TODAY - DAY, 3)]
    judged = version_rules.two_tier(trades_df(spark, rows), None, ["arrival"], F.lit(TODAY)).orderBy("arrival").collect()
    assert [r["reason"] for r in judged] == [None, RULE_1, RULE_2]


def test_store_guardrail_reached(spark):
    levels = spark.createDataFrame([("T1", None, 5)], LEVELS)
    row = version_rules.two_tier(trades_df(spark, [("T1", 4, TODAY + DAY, 1)]), levels, ["arrival"], F.lit(TODAY)).first()
    assert row["reason"] == DB_GUARDRAIL
    assert row["db_error"] == (
        "REJECTED_BY_DB_GUARDRAIL: active higher version exists for trade_id=T1, incoming_version=4"
    )


def random_case(seed, keys=400, hot=0):
    rng = random.Random(seed)
    dates = [TODAY - DAY, TODAY, TODAY + DAY, None]
    stored, arriving, n = [], [], 0
    for k in range(keys):
        tid = f"K{k}"
        for v in rng.sample(range(5), rng.randint(0, 3)):
            stored.append((tid, v, rng.choice(dates[:3]), rng.random() < 0.4))
        for _ in range(rng.randint(1, 7)):
            arriving.append((tid, rng.randint(0, 5), rng.choice(dates)))
    arriving += [("HOT", rng.randint(0, 60), rng.choice(dates)) for _ in range(hot)]
    rng.shuffle(arriving)
    return stored, [(t, v, m, n) for n, (t, v, m) in enumerate(arriving)]


def simulate(rule, stored, arriving):
    states = {}
    for t, v, m, expired in stored:
        states.setdefault(t, seq.Trade()).rows[v] = seq.Row(v, m, expired, "stored")
    out = {n: rule(states.setdefault(t, seq.Trade()), v, m, TODAY, n) for t, v, m, n in arriving}
    final = {(t, v): (r.expired, r.tag) for t, s in states.items() for v, r in s.rows.items()}
    return out, final


def store_df(spark, stored):
    stamp = datetime.datetime(2025, 1, 1)
    data = [(t, v, "CP", "B", m, TODAY, '"stored"', e, stamp) for t, v, m, e in stored]
    return spark.createDataFrame(data, STORE)


@pytest.mark.parametrize("seed", [1, 2])
def test_two_tier_equals_simulation(spark, seed):
    stored, arriving = random_case(seed)
    want, final = simulate(seq.two_tier, stored, arriving)
    base = store_df(spark, stored)
    levels = store.latest_active_version(base).withColumn("seen_version", F.lit(None).cast("int"))
    judged = version_rules.two_tier(trades_df(spark, arriving), levels, ["arrival"], F.lit(TODAY))
    assert {r["arrival"]: r["reason"] for r in judged.collect()} == want

    accepted = judged.filter("reason IS NULL").withColumn("payload", F.col("arrival").cast("string"))
    merged = store.upsert(base, accepted, ["arrival"]).collect()
    got = {(r["trade_id"], r["version"]): (r["expired_flag"], r["payload"].strip('"')) for r in merged}
    assert got == {k: (e, str(tag)) for k, (e, tag) in final.items()}


@pytest.mark.parametrize("seed", [3, 4])
def test_upsert_status_equals_simulation(spark, seed):
    stored, arriving = random_case(seed)
    want, _ = simulate(seq.status_rule, stored, arriving)
    judged = version_rules.upsert_status(trades_df(spark, arriving), store_df(spark, stored), ["arrival"], F.lit(TODAY))
    assert {r["arrival"]: r["status"] for r in judged.collect()} == want


def test_guardrail_alone_equals_simulation(spark):
    stored, arriving = random_case(5)
    want, _ = simulate(seq.store_rule, stored, arriving)
    judged = version_rules.guardrail(trades_df(spark, arriving), store_df(spark, stored), ["arrival"], F.lit(TODAY))
    assert {r["arrival"]: r["reason"] for r in judged.collect()} == want


def test_maturity_regression_equals_simulation(spark):
    stored, arriving = random_case(6)
    latest = {}
    for t, v, m, _ in stored:
        if t not in latest or v > latest[t][0]:
            latest[t] = (v, m)
    floors = {t: m for t, (_, m) in latest.items()}
    want = {}
    for t, _, m, n in arriving:
        floor = floors.get(t)
        bad = m is not None and floor is not None and m < floor
        want[n] = bad
        if not bad and m is not None:
            floors[t] = m
    per_trade = store.latest_per_trade(store_df(spark, stored))
    judged = version_rules.maturity_regression(trades_df(spark, arriving), per_trade, ["arrival"])
    assert {r["arrival"]: r["reason"] is not None for r in judged.collect()} == want


def test_frequent_key_stays_exact(spark):
    """A third of all rows under one key, judged by the plan that every size gets."""
    stored, arriving = random_case(7, keys=1500, hot=3000)
    stored += [("HOT", 3, TODAY + DAY, False)]
    want, _ = simulate(seq.two_tier, stored, arriving)
    levels = store.latest_active_version(store_df(spark, stored)).withColumn("seen_version", F.lit(None).cast("int"))
    judged = version_rules.two_tier(trades_df(spark, arriving), levels, ["arrival"], F.lit(TODAY))
    assert {r["arrival"]: r["reason"] for r in judged.collect()} == want


@pytest.mark.parametrize("listed", [marks.LISTED, 5])
def test_earlier_max_over_many_values(spark, listed):
    """Values in several blocks, ties in place order by two columns, nulls and refused rows without a key.

    With few steps listed, the rows look into blocks.
    """
    import random

    random.seed(8)
    data = [(random.choice(["a", "b", None]), k // 7, k, random.choice([None, random.randrange(-9000, 30000)]), k % 5 == 0) for k in range(2000)]
    df = spark.createDataFrame(data, "k string, p int, n int, v int, bad boolean").repartition(7)
    start = spark.createDataFrame([("a", 5), ("c", 6)], "k string, s int")
    got = {r["n"]: (r["m"], r["s"]) for r in marks.earlier_max(df, "k", ["p", "n"], F.col("v"), "m", start, F.col("bad"), listed).collect()}
    top, want = {}, {}
    for k, _, n, v, bad in data:
        alive = not bad and k is not None
        want[n] = (top.get(k) if alive else None, 5 if alive and k == "a" else None)
        if alive and v is not None:
            top[k] = max(v, top.get(k, v))
    assert got == want


@pytest.mark.parametrize("listed", [marks.LISTED, 5])
def test_earlier_max_over_a_long_staircase(spark, listed):
    """A key whose values only grow: every value is a step, over several blocks; another whose values only fall: one step."""
    rows = [("up", n, 7 * n - 4000) for n in range(1500)] + [("down", n, 9000 - n) for n in range(1500)]
    df = spark.createDataFrame(rows, "k string, n int, v int").repartition(5)
    steps = {r["_key"]: r["n"] for r in marks.staircases(df, "k", ["n"], F.col("v"), listed).groupBy("_key").agg(F.sum(F.size("_steps")).alias("n")).collect()}
    assert steps["up"] == 1500 and steps["down"] == 1
    got = {(r["k"], r["n"]): r["m"] for r in marks.earlier_max(df, "k", ["n"], F.col("v"), "m", listed=listed).collect()}
    assert got == {(k, n): None if n == 0 else (7 * (n - 1) - 4000 if k == "up" else 9000) for k, n, _ in rows}


def test_refused_rows_keep_their_code(spark):
    _, arriving = random_case(8, keys=50, hot=800)
    df = trades_df(spark, arriving).withColumn("reject_code", F.when(F.col("arrival") % 5 == 0, F.lit("PARSE_ERROR")))
    df = df.withColumn("trade_id", F.when(F.col("reject_code").isNull(), F.col("trade_id")))
    judged = version_rules.two_tier(df, None, ["arrival"], F.lit(TODAY))
    sound = [r for r in arriving if r[3] % 5]
    want, _ = simulate(seq.two_tier, [], sound)
    got = {r["arrival"]: r["reason"] for r in judged.collect()}
    assert {n: r for n, r in got.items() if n % 5} == want
    assert {r for n, r in got.items() if n % 5 == 0} == {"PARSE_ERROR"}


def test_status_of_a_refused_record_is_its_code(spark):
    df = trades_df(spark, [("T1", 3, TODAY + DAY, 1), ("T1", 4, TODAY + DAY, 2)])
    df = df.withColumn("reject_code", F.when(F.col("arrival") == 1, F.lit("CONSTRAINT_NOT_NULL")))
    judged = version_rules.upsert_status(df, store_df(spark, []), ["arrival"], F.lit(TODAY))
    assert {r["arrival"]: r["status"] for r in judged.collect()} == {1: "CONSTRAINT_NOT_NULL", 2: "OK"}


def test_scope_active_ignores_the_stream_mark(spark):
    levels = spark.createDataFrame([("T1", 9, 2)], LEVELS)
    df = trades_df(spark, [("T1", 3, TODAY + DAY, 1)])
    coded = version_rules.two_tier(df, levels, ["arrival"], F.lit(TODAY)).first()
    spec = version_rules.two_tier(df, levels, ["arrival"], F.lit(TODAY), tiers=("active",)).first()
    assert coded["reason"] == RULE_1
    assert spec["reason"] is None


def test_building_a_judgement_runs_no_job(spark):
    df = trades_df(spark, [("T1", 3, TODAY + DAY, 1)])
    levels = spark.createDataFrame([("T1", 9, 2)], LEVELS)
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup()
    judged = version_rules.two_tier(df, levels, ["arrival"], F.lit(TODAY))
    assert tracker.getJobIdsForGroup() == before
    assert judged.first()["reason"] == RULE_1
