"""Store operations, reconciliation, deduplication, parts, files and generation."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import generate, metrics, parts, recon, store
from tidemark.schemas import KEY, STORE, TRADE
from tidemark.sinks import files as sinks
from tidemark.sources import files

D = datetime.date
STAMP = datetime.datetime(2025, 1, 1)


def rows(spark, *items):
    """(trade_id, version, book, maturity, expired)"""
    return spark.createDataFrame([(t, v, "CP", b, m, D(2024, 1, 1), "{}", e, STAMP) for t, v, b, m, e in items], STORE)


def arriving(spark, *items):
    data = [(t, v, "CP", b, m, D(2024, 1, 1), "{}", n) for n, (t, v, b, m) in enumerate(items)]
    return spark.createDataFrame(data, TRADE.simpleString()[7:-1] + ",n:int")


def books(df):
    return sorted((r["trade_id"], r["version"], r["book_id"], r["expired_flag"]) for r in df.collect())


M = D(2025, 7, 1)


def test_upsert_variants(spark):
    base = rows(spark, ("A", 1, "old", M, False), ("B", 1, "old", M, True), ("C", 1, "old", M, False))
    new = arriving(spark, ("A", 1, "x", M), ("A", 1, "y", M), ("B", 1, "y", M), ("D", 1, "y", M))
    assert books(store.upsert(base, new, ["n"])) == [
        ("A", 1, "y", False), ("B", 1, "y", False), ("C", 1, "old", False), ("D", 1, "y", False),
    ]
    assert books(store.upsert(base, new, ["n"], on_expired="keep"))[1] == ("B", 1, "old", True)
    with pytest.raises(ValueError):
        store.upsert(base, new, ["n"], on_expired="?")
    assert books(store.insert_if_absent(base, new, ["n"])) == [
        ("A", 1, "old", False), ("B", 1, "old", True), ("C", 1, "old", False), ("D", 1, "y", False),
    ]


def test_merge_last_wins(spark):
    target = rows(spark, ("A", 2, "t", M, False), ("B", 2, "t", M, False), ("C", 2, "t", M, False))
    later, earlier = D(2026, 1, 1), D(2025, 1, 1)
    source = rows(
        spark, ("A", 3, "s", later, False), ("B", 3, "s", earlier, False), ("C", 1, "s", later, False), ("D", 1, "s", M, False)
    )
    got = {r["trade_id"]: (r["version"], r["book_id"]) for r in store.merge_last_wins(target, source).collect()}
    assert got == {"A": (3, "s"), "B": (2, "t"), "C": (2, "t"), "D": (1, "s")}


def test_expire_is_strict_and_keeps_flags(spark):
    base = rows(spark, ("A", 1, "b", D(2025, 5, 31), False), ("B", 1, "b", D(2025, 6, 1), False), ("C", 1, "b", M, True))
    assert [r[3] for r in books(store.expire_matured(base, F.lit(D(2025, 6, 1))))] == [True, False, True]


def test_layouts_prune(spark, tmp_path):
    base = rows(spark, *[(f"T{k}", 1, "b", D(2025, 1 + k % 12, 5), False) for k in range(200)])
    store.write_hash_layout(base, f"{tmp_path}/hash", buckets=8)
    stored = spark.read.parquet(f"{tmp_path}/hash")
    found = store.lookup(stored, "T7", 1, buckets=8)
    assert found.count() == 1
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().executedPlan().toString()
    store.write_month_layout(base, f"{tmp_path}/month")
    months = spark.read.parquet(f"{tmp_path}/month")
    part = store.active_by_maturity(months, F.lit(D(2025, 3, 1)), F.lit(D(2025, 4, 30)))
    assert part.count() == base.filter("month(maturity_date) in (3, 4)").count()
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(maturity_month" in plan and "PushedFilters: [IsNotNull(expired_flag)" in plan


def test_active_counts_across_blocks(spark):
    base = rows(spark, *[("A", v, "b", M, v % 7 == 0) for v in range(0, 20000, 250)])
    probe = arriving(spark, *[("A", v, "b", M) for v in (0, 250, 5000, 5001, 19750, 30000)], ("B", 1, "b", M))
    active = [v for v in range(0, 20000, 250) if v % 7]
    got = {(r["trade_id"], r["version"]): (r["higher_active"], r["same_active"]) for r in store.active_counts(probe, base).collect()}
    want = {("A", v): (sum(a > v for a in active), active.count(v)) for v in (0, 250, 5000, 5001, 19750, 30000)}
    assert got == {**want, ("B", 1): (0, 0)}


def test_reconcile(spark):
    left = rows(spark, ("A", 1, "x", M, False), ("B", 1, "x", M, False), ("C", 1, None, M, False), ("D", 1, "x", M, False))
    right = rows(spark, ("A", 1, "x", M, False), ("B", 1, "y", M, True), ("C", 1, None, M, False), ("E", 1, "x", M, False))
    found = recon.reconcile(left, right, KEY, ["book_id", "maturity_date", "expired_flag"])
    assert sorted((r["trade_id"], r["status"], r["differing"]) for r in found.collect()) == [
        ("B", "differs", "book_id,expired_flag"), ("D", "missing_right", None), ("E", "missing_left", None),
    ]
    assert recon.reconcile_summary(found).count() == 3


def test_dedup_ttl_with_frequent_key(spark):
    start = datetime.datetime(2025, 1, 1)
    data = [(n, "hot" if n % 3 == 0 else f"k{n % 40}", start + datetime.timedelta(seconds=(n * 7919) % 50000)) for n in range(3000)]
    df = spark.createDataFrame(data, "n int, k string, ts timestamp")
    got = {r["n"] for r in recon.dedup_ttl(df, ["k"], "ts", ["n"], 40).collect()}
    last, want = {}, set()
    for n, k, ts in sorted(data, key=lambda r: (r[2], r[0])):
        if k not in last or ts - last[k] > datetime.timedelta(seconds=40):
            want.add(n)
        last[k] = ts
    assert got == want


def test_dedup_stream_forgets_after_the_watermark(spark, tmp_path):
    """Repeats inside the delay are dropped, a key returns once the watermark has passed, a late record is dropped."""
    start = datetime.datetime(2025, 1, 1)
    batches = [[(1, 0), (2, 0), (1, 1)], [(1, 2), (3, 100)], [(4, 200)], [(1, 300), (9, 0)]]
    for n, batch in enumerate(batches):
        rows = [(k, start + datetime.timedelta(hours=h)) for k, h in batch]
        spark.createDataFrame(rows, "k int, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema("k int, ts timestamp").parquet(f"{tmp_path}/in/*")
        writer = recon.dedup_stream(stream, ["k"], "ts", "6 hours").writeStream.format("parquet")
        writer = writer.option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    kept = sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert kept == [1, 1, 2, 3, 4]


def test_files_by_extension(spark, tmp_path):
    df = arriving(spark, *[(f"T{n}", n, "x", M) for n in range(25)])
    for name in ("a.json", "a.jsonl", "a.parquet", "a.csv"):
        sinks.write_by_extension(df, f"{tmp_path}/{name}", ["n"], rows_per_file=10)
        found = files.read_inferred(spark, f"{tmp_path}/{name}")
        assert sorted((r["trade_id"], r["n"]) for r in found.collect()) == sorted((f"T{n}", n) for n in range(25))
    arrays = [json.loads(p.read_text()) for p in (tmp_path / "a.json").glob("part-*")]
    assert sorted(map(len, arrays)) == [5, 10, 10]
    with pytest.raises(ValueError, match="no format"):
        sinks.write_by_extension(df, f"{tmp_path}/a.xml", ["n"])


def test_metrics_totals(spark):
    judged = spark.createDataFrame(
        [(None, 1, None), (None, 1, 1), ("DB_GUARDRAIL_REJECT", 1, 2), ("X", 1, 2)], "reason string, version int, seen_version int"
    )
    got = {r["outcome"]: (r["records"], r["replacements"], r["failed_upserts"]) for r in metrics.outcome_metrics(judged).collect()}
    assert got == {"accept": (2, 1, 0), "DB_GUARDRAIL_REJECT": (1, 0, 1), "X": (1, 0, 0), "ALL": (4, 1, 1)}


def test_metrics_lag(spark):
    at, late = datetime.datetime(2025, 6, 1, 12), datetime.datetime(2025, 6, 1, 11, 59, 20)
    judged = spark.createDataFrame(
        [(None, 1, None, at), ("X", 1, 2, late)], "reason string, version int, seen_version int, t timestamp"
    )
    counted = metrics.outcome_metrics(judged, arrived=F.col("t"), now=F.lit(at))
    assert {r["outcome"]: r["lag_seconds"] for r in counted.collect()} == {"accept": 0, "X": 40, "ALL": 40}


def test_index_is_dense_and_seeded(spark):
    df = spark.range(5000)
    a = parts.with_index(df, ["id"], seed=1)
    assert sorted(r["index"] for r in a.collect()) == list(range(5000))
    b = parts.with_index(df, ["id"], seed=1)
    assert a.exceptAll(b).isEmpty()
    assert not a.exceptAll(parts.with_index(df, ["id"], seed=2)).isEmpty()


@pytest.mark.parametrize("total, n, minsize", [(1000, 5, 100), (100, 4, 100), (7, 1, 3), (50, 30, 1)])
def test_sized_parts(spark, total, n, minsize):
    sizes = parts.part_sizes(total, n, minsize, seed=42)
    assert len(sizes) == n and sum(sizes) == total and (minsize in sizes or n == 1)
    placed = parts.assign_parts(spark.range(total), ["id"], sizes, seed=42)
    counted = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    assert counted == {k: s for k, s in enumerate(sizes) if s}
    with pytest.raises(ValueError):
        parts.part_sizes(10, 2, 11)


def test_array_chunks(spark):
    made = parts.array_chunks(spark.range(95), ["id"], ["id"], 20).orderBy("chunk").collect()
    assert [r["records"] for r in made] == [20, 20, 20, 20, 15]
    ids = [item["id"] for r in made for item in json.loads(r["value"])]
    assert sorted(ids) == list(range(95))


def test_file_scans(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(
        b'{"trade_id":"A","version":1}\n\n   \n{"trade_id":"B","version":"x"}\n{"trade\n{"trade_id":"\xff","version":2}\n'
    )
    scan = files.read_jsonl(spark, f"{tmp_path}/a.jsonl").cache()
    assert sorted((r["trade_id"], r["version"]) for r in scan.filter("_corrupt IS NULL").collect()) == [("A", 1), ("�", 2)]
    assert scan.filter("_corrupt IS NOT NULL").count() == 2
    assert files.read_lines(spark, f"{tmp_path}/a.jsonl").count() == 4
    (tmp_path / "b.csv").write_text("trade_id,version,counter_party_id,book_id,maturity_date,created_date,payload\nA,1,C,B,2025-01-01,2024-01-01,{}\nA,x,C,B,2025-01-01,2024-01-01,{}\n")
    table = files.read_csv(spark, f"{tmp_path}/b.csv", TRADE).cache()
    assert table.filter("_corrupt IS NULL").first()["maturity_date"] == D(2025, 1, 1)
    assert table.filter("_corrupt IS NOT NULL").count() == 1
    assert dict(files.read_inferred(spark, f"{tmp_path}/b.csv").dtypes)["maturity_date"] == "date"
    (tmp_path / "c.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert files.read_inferred(spark, f"{tmp_path}/c.json").count() == 2
    with pytest.raises(ValueError):
        files.read_inferred(spark, f"{tmp_path}/c.xyz")


def test_landing_and_size_routes(spark, tmp_path):
    for name, size in (("small.json", 10), ("large.json", 5000), ("other.tmp", 10)):
        (tmp_path / name).write_bytes(b"x" * size)
    found = files.route_by_size(files.landing_files(spark, str(tmp_path), "*.json"), threshold=1000)
    assert {r["path"].rsplit("/", 1)[-1]: r["route"] for r in found.collect()} == {"small.json": "small", "large.json": "large"}
    assert files.landing_files(spark, str(tmp_path), "*.json", min_age_seconds=3600).count() == 0
    assert files.route_by_size(spark.createDataFrame([(50_000_000,), (50_000_001,)], "length long")).collect()[1]["route"] == "large"


def test_write_parts_and_records(spark, tmp_path):
    sizes = sinks.write_parts(spark.range(300), f"{tmp_path}/parts", ["id"], 4, 20, seed=3)
    read = spark.read.json(f"{tmp_path}/parts").groupBy("part").count().collect()
    assert sorted(r["count"] for r in read) == sorted(s for s in sizes if s)
    sinks.write_records(spark.range(100).coalesce(1), f"{tmp_path}/chunks", "csv", rows_per_file=30)
    per_file = spark.read.option("header", True).csv(f"{tmp_path}/chunks").groupBy("_metadata.file_path").count()
    assert sorted(r["count"] for r in per_file.collect()) == [10, 30, 30, 30]
    sinks.write_arrays(spark.range(50), f"{tmp_path}/arrays", ["id"], ["id"], 20)
    assert spark.read.text(f"{tmp_path}/arrays").count() == 3


def test_checksum_ignores_order_and_counts_repeats(spark):
    def total(df):
        return df.agg(parts.order_free_checksum(["id"]).alias("c")).first()["c"]

    assert total(spark.range(100)) == total(spark.range(100).orderBy(F.desc("id")))
    assert total(spark.range(100)) != total(spark.range(100).unionAll(spark.range(1)).unionAll(spark.range(1)))


@pytest.mark.parametrize("total, v1, vn", [(1000, 20, 30), (500, 80, 50), (100, 0, 40), (60, 100, 0)])
def test_generated_profile(spark, total, v1, vn):
    today = D(2025, 6, 1)
    made = generate.generate_trades(spark, total, v1, vn, F.lit(today), seed=5).cache()
    counts = generate.shares(total, v1, vn)
    assert sum(counts) == total == made.count()
    by_kind = {r["kind"]: r["count"] for r in made.groupBy("kind").count().collect()}
    assert by_kind == {k: c for k, c in zip(("v1", "vn", "other"), counts) if c}
    got = made.collect()
    firsts = [r["Trade Id"] for r in got if r["kind"] == "v1"]
    others = [r["Trade Id"] for r in got if r["kind"] == "other"]
    assert len(set(firsts)) == len(firsts) and len(set(others)) == len(others)
    assert not set(others) & set(firsts) and not set(others) & {r["Trade Id"] for r in got if r["kind"] == "vn"}
    if counts[0]:
        assert {r["Trade Id"] for r in got if r["kind"] == "vn"} <= set(firsts)
    assert {r["Version"] for r in got if r["kind"] == "vn"} <= {2, 3, 4}
    for r in got:
        maturity = datetime.datetime.strptime(r["Maturity_Date"], "%d/%m/%Y").date()
        created = datetime.datetime.strptime(r["Created_Date"], "%d/%m/%Y").date()
        assert abs((maturity - today).days) <= 1825 and today - datetime.timedelta(days=3650) <= created <= today
        assert r["Expired"] == ("Y" if maturity < today else "N")
