"""The stored table: streaming, bulk, replays, failures, maintenance."""

import datetime
import json
import os
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import version_rules
from tidemark.plans import bulk, ingest, replay
from tidemark.plans.table import TradeTable
from tidemark.schemas import STORE, STORE_COLUMNS
from tidemark.sinks import files as sinks
from tidemark.sources import dlq, files, streams
from tidemark.streaming import jobs

TODAY = datetime.date(2025, 6, 1)
ORDER = ["file_path", "block_start", "row_id"]


def line(trade, version, maturity="2025-07-01", created="2025-01-01", **extra):
    return json.dumps({"trade_id": trade, "version": version, "maturity_date": maturity, "created_date": created, **extra})


LINES = [
    line("A", 1),
    line("A", 3),
    line("B", 1, maturity="2025-05-01"),
    "{broken",
    line("A", 2),
    line("C", 2, created=None),
    line("C", 2),
    "",
    line("A", 3, maturity="2025-05-01"),
    line("B", 1, maturity="2025-05-01"),
    line("A", 3, book_id="NEW"),
    line(None, 1),
    line("C", 3),
    line("C", 1),
]
OUTCOME = {
    ("A", 2): "RULE_1_LOWER_VERSION_THAN_ACTIVE",
    ("A", 3): "RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION",
    ("B", 1): "RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION",
    ("C", 2): "CONSTRAINT_NOT_NULL",
    ("C", 1): "RULE_1_LOWER_VERSION_THAN_ACTIVE",
}


def land(folder, pieces):
    for n, piece in enumerate(pieces):
        path = pathlib.Path(folder) / f"part-{n:03d}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(piece) + "\n")
        # Spark takes files in the order of their times
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def stream(spark, root, pieces, table=None, **kwargs):
    land(f"{root}/landing", pieces)
    table = table or TradeTable.create(spark, f"{root}/table", compact_every=2)
    lines = streams.line_stream(spark, f"{root}/landing", files_per_batch=1, pattern="*.txt")
    jobs.ingest_stream(lines, table, f"{root}/checkpoint", ORDER, as_of=TODAY, until_empty=True, **kwargs).awaitTermination()
    return table


def snapshot(table):
    return sorted(
        (r["trade_id"], r["version"], r["book_id"], str(r["maturity_date"]), r["expired_flag"]) for r in table.read().collect()
    )


def letters(table):
    rows = dlq.decode_dlq(table.dead_letters()).collect()
    found = [(r["trade"] and (r["trade"]["trade_id"], r["trade"]["version"]), r["reason"]) for r in rows]
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    table = stream(spark, tmp_path_factory.mktemp("whole"), [LINES])
    return snapshot(table), letters(table)


def test_stream_outcome(whole):
    store, refused = whole
    assert store == [
        ("A", 1, None, "2025-07-01", False),
        ("A", 3, "NEW", "2025-07-01", False),
        ("B", 1, None, "2025-05-01", False),
        ("C", 2, None, "2025-07-01", False),
        ("C", 3, None, "2025-07-01", False),
    ]
    reasons = {k: r for k, r in refused if k and k[0]}
    assert reasons == OUTCOME
    assert sorted(r for k, r in refused if not (k and k[0])) == ["CONSTRAINT_NOT_NULL", "PARSE_ERROR"]


@pytest.mark.parametrize("cuts", [[5], [2, 4, 9, 12]])
def test_any_split_gives_the_same_table(spark, tmp_path, whole, cuts):
    bounds = [0, *cuts, len(LINES)]
    pieces = [LINES[a:b] for a, b in zip(bounds, bounds[1:])]
    table = stream(spark, tmp_path, pieces)
    assert (snapshot(table), letters(table)) == whole
    if len(cuts) > 2:
        assert table.state().snapshot > 0  # compacted on the way


def test_failed_batch_is_completed_on_restart(spark, tmp_path, whole, monkeypatch):
    pieces = [LINES[:6], LINES[6:]]
    table = TradeTable.create(spark, f"{tmp_path}/table", compact_every=50)
    real, calls = TradeTable.commit, []

    def failing(self, batch):
        calls.append(batch.base)
        if len(calls) == 2:
            raise OSError("storage lost")
        return real(self, batch)

    monkeypatch.setattr(TradeTable, "commit", failing)
    with pytest.raises(Exception, match="storage lost"):
        stream(spark, tmp_path, pieces, table)
    assert len(snapshot(table)) == 3  # the failed batch is not visible
    assert not table.begin("other", 0).committed  # another source is not held up
    stream(spark, tmp_path, pieces, table)
    assert (snapshot(table), letters(table)) == whole
    assert calls == [-1, 0, 0]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/table", compact_every=1)
    batch = spark.createDataFrame([(n, t) for n, t in enumerate(LINES) if t], "n int, line string")
    first = ingest.ingest_batch(table, ingest.prepare_lines(batch), ["n"], "s", 0, TODAY)
    before = snapshot(table), letters(table)
    again = ingest.ingest_batch(table, ingest.prepare_lines(batch), ["n"], "s", 0, datetime.date(2030, 1, 1))
    assert again.committed and again.as_of == first.as_of == TODAY and again.at == first.at
    assert (snapshot(table), letters(table)) == before
    # also after a fold by another source's batch
    other = spark.createDataFrame([(1, line("Z", 1))], "n int, line string")
    ingest.ingest_batch(table, ingest.prepare_lines(other), ["n"], "t", 0, TODAY)
    assert table.state().snapshot == 1
    assert table.retire() and snapshot(table) == sorted([*before[0], ("Z", 1, None, "2025-07-01", False)])
    assert ingest.ingest_batch(table, ingest.prepare_lines(batch), ["n"], "s", 0, TODAY).committed


def test_stream_mark_survives_expiry(spark, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/table")
    first = spark.createDataFrame([(1, line("A", 3, maturity="2025-05-01"))], "n int, line string")
    ingest.ingest_batch(table, ingest.prepare_lines(first), ["n"], "s", 0, TODAY)
    table.expire(TODAY)
    assert [r["expired_flag"] for r in table.read().collect()] == [True]
    row = table.levels().first()
    assert (row["seen_version"], row["active_version"]) == (3, None)
    later = spark.createDataFrame([(1, line("A", 2)), (2, line("A", 3))], "n int, line string")
    ingest.ingest_batch(table, ingest.prepare_lines(later), ["n"], "s", 1, TODAY)
    assert [(r["version"], r["expired_flag"]) for r in table.read().collect()] == [(3, False)]  # reactivated
    assert len(letters(table)) == 1
    assert table.lookup("A", 3).first()["maturity_date"] == datetime.date(2025, 7, 1)
    assert table.lookup("A", 2).count() == 0
    assert spark.read.parquet(f"{tmp_path}/table/accepted").count() == 3  # expiry wrote the one row it changed
    table.delete(spark.createDataFrame([("A",)], "trade_id string"), "gone-1")
    assert table.read().count() == 0 and table.lookup("A", 3).count() == 0
    table.compact()
    assert table.read().count() == 0 and table.levels().first()["seen_version"] == 3


def test_stored_table_equals_one_plan(spark, tmp_path):
    rows = [(n, t) for n, t in enumerate(LINES) if t]
    prepared = ingest.prepare_lines(spark.createDataFrame(rows, "n int, line string"))
    table = TradeTable.create(spark, f"{tmp_path}/table")
    ingest.ingest_batch(table, prepared, ["n"], "s", 0, TODAY)
    rebuilt = ingest.rebuild_store(prepared, ["n"], F.lit(TODAY))
    columns = [c for c in STORE_COLUMNS if c != "ingest_ts"]
    assert sorted(map(tuple, rebuilt.select(*columns).collect()), key=str) == sorted(
        map(tuple, table.read().select(*columns).collect()), key=str
    )
    reasons = version_rules.two_tier(prepared, None, ["n"], F.lit(TODAY)).groupBy("reason").count().collect()
    logged = table.outcomes().groupBy("reason").count().collect()
    assert sorted(map(tuple, reasons), key=str) == sorted(map(tuple, logged), key=str)
    totals = {r["outcome"]: r["records"] for r in table.metrics().collect()}
    assert totals["ALL"] == len(rows) and totals["accept"] + len(letters(table)) == len(rows)


def bulk_rows(spark):
    data = [("A", 1, "CP", "B", "2025-07-01", "2025-01-01", '{"x":1}', n) for n in range(25)]
    data += [("B", 2, "CP", "B", "2025-07-01", None, "{}", 100)]
    return spark.createDataFrame(
        data,
        "trade_id string, version int, counter_party_id string, book_id string, maturity_date string,"
        " created_date string, payload string, n int",
    )


BULK_ORDER = {"n": "CAST(get_json_object(line, '$.n') AS INT)"}


def test_bulk_ingest_and_repeat(spark, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/table")
    path = bulk.stage_bulk(bulk_rows(spark), f"{tmp_path}/stage", "run-1", rows_per_chunk=4)
    for _ in range(2):
        done = bulk.bulk_ingest(spark, table, path, "run-1", BULK_ORDER, TODAY, f"{tmp_path}/audit")
        assert done == {"seq": 0}
    assert [(r["trade_id"], r["version"]) for r in table.read().collect()] == [("A", 1)]
    assert letters(table) == [(("B", 2), "CONSTRAINT_NOT_NULL")]
    audit = sinks.read_audit(spark, f"{tmp_path}/audit", "run-1")
    assert [r["status"] for r in audit.collect()] == ["SUCCESS", "SUCCESS"]
    with pytest.raises(ValueError, match="no manifest"):
        bulk.bulk_ingest(spark, table, path, "run-2", BULK_ORDER, TODAY, f"{tmp_path}/audit")
    failed = sinks.read_audit(spark, f"{tmp_path}/audit", "run-2").first()
    assert failed["status"] == "FAILED" and "no manifest" in failed["details"]
    assert sinks.recent_audit(sinks.read_audit(spark, f"{tmp_path}/audit"), 1).count() == 1


def test_bulk_refuses_bad_records_with_their_text(spark, tmp_path):
    """A good line, a version that is no number, a payload that is no JSON, the generator's field names, a cut line."""
    named = {"Trade Id": "G", "Version": 1, "Maturity_Date": "01/07/2025", "Created_Date": "01/01/2025"}
    lines = [
        line("A", 1), line("A", "abc"), line("P", 1, payload="not json"), json.dumps(named), line("C", 1)[:30],
    ]
    frame = spark.createDataFrame([(text,) for text in lines], "line string")
    table = TradeTable.create(spark, f"{tmp_path}/table")
    path = bulk.stage_bulk(frame, f"{tmp_path}/stage", "five")
    bulk.bulk_ingest(spark, table, path, "five", {"arrival": "line"}, TODAY)
    assert [(r[0], r[1]) for r in snapshot(table)] == [("A", 1), ("G", 1)]
    found = dlq.decode_dlq(table.dead_letters()).collect()
    assert sorted((r["reason"], r["raw"]) for r in found) == sorted(("PARSE_ERROR", lines[k]) for k in (1, 2, 4))
    assert replay.letter_lines(table).count() == 3


def test_sources_commit_beside_each_other(spark, tmp_path):
    """The stream judges a batch, two loads commit meanwhile, and the stream judges again on top of them."""
    table = TradeTable.create(spark, f"{tmp_path}/table")
    one = lambda text: ingest.prepare_lines(spark.createDataFrame([(1, text)], "n int, line string"))
    real, inner = TradeTable.commit, []

    def interleaved(self, batch):
        if batch.source == "stream" and not inner:
            inner.append(batch.base)
            ingest.ingest_batch(table, one(line("A", 5)), ["n"], "bulk", "load-a", TODAY)
            ingest.ingest_batch(table, one(line("B", 1)), ["n"], "bulk", "load-b", TODAY)
        return real(self, batch)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(TradeTable, "commit", interleaved)
        done = ingest.ingest_batch(table, one(line("A", 3)), ["n"], "stream", 0, TODAY)
    assert inner == [-1] and done.seq == 2
    assert [(r[0], r[1]) for r in snapshot(table)] == [("A", 5), ("B", 1)]
    assert letters(table) == [(("A", 3), "RULE_1_LOWER_VERSION_THAN_ACTIVE")]


def test_a_load_is_known_by_its_name(spark, tmp_path):
    """Two names whose checksums of 32 bits are equal are two loads; a load repeated after a compaction is one."""
    table = TradeTable.create(spark, f"{tmp_path}/table", compact_every=1)
    for name, trade in (("plumless", "A"), ("buckeroo", "B"), ("plumless", "A")):
        frame = spark.createDataFrame([(line(trade, 1),)], "line string")
        path = bulk.stage_bulk(frame, f"{tmp_path}/{name}", name)
        bulk.bulk_ingest(spark, table, path, name, {"arrival": "line"}, TODAY)
    assert [(r[0], r[1]) for r in snapshot(table)] == [("A", 1), ("B", 1)]
    assert table.metrics().filter("outcome = 'ALL'").agg(F.sum("records")).first()[0] == 2


def test_manifest_checks(spark, tmp_path):
    path = bulk.stage_bulk(bulk_rows(spark), f"{tmp_path}/stage", "run-1", rows_per_chunk=4)
    manifest = files.read_manifest(spark, path, "run-1")
    listed = manifest.collect()
    assert {r["total_rows"] for r in listed} == {26} and {r["chunk_count"] for r in listed} == {len(listed)} and len(listed) >= 7
    assert max(r["rows"] for r in listed) <= 4 and sum(r["rows"] for r in listed) == 26
    assert files.read_chunks(spark, manifest).count() == 26
    for broken, text in (
        (manifest.withColumn("total_rows", F.lit(27).cast("long")), "promises 27"),
        (manifest.withColumn("checksum", F.lit("WRONG")), "checksum"),
        (manifest.filter(F.col("chunk_path") != listed[0]["chunk_path"]), "promises"),
        (manifest.withColumn("chunk_path", F.concat("chunk_path", F.lit("x"))), "differ"),
    ):
        with pytest.raises(ValueError, match=text):
            files.read_chunks(spark, broken)
    with pytest.raises(ValueError, match="required"):
        files.read_manifest(spark, path, "")


def test_small_file_flow_archives(spark, tmp_path):
    # three runs of the same checkpoint: a file is archived after the batch that follows its own
    for n, piece in enumerate([LINES[:5], LINES[5:9], LINES[9:]]):
        path = tmp_path / "landing" / f"f{n}.txt"
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(piece) + "\n")
        stream_of = streams.line_stream(spark, f"{tmp_path}/landing", files_per_batch=1, archive_to=f"{tmp_path}/archive")
        jobs.small_file_flow(
            stream_of, f"{tmp_path}/out", f"{tmp_path}/checkpoint", 3, until_empty=True
        ).awaitTermination()
    sent = spark.read.json(f"{tmp_path}/out/messages")
    values = [json.loads(r["value"]) for r in sent.collect()]
    assert len(values) == 10
    assert all(v["correlation_id"].startswith("f") and v["manifest_path"].endswith(".txt") for v in values)
    refused = spark.read.json(f"{tmp_path}/out/dlq").collect()
    assert sorted(r["raw"][:7] for r in refused) == sorted(["{broken", '{"trade', '{"trade'])
    assert list((tmp_path / "archive").rglob("*.txt"))


def test_settled_files_are_taken_once(spark, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/table")
    folder, base = tmp_path / "landing", 1_700_000_000
    folder.mkdir()
    at = lambda s: datetime.datetime.fromtimestamp(base + s)

    def put(name, text, age):
        (folder / name).write_text(text + "\n")
        os.utime(folder / name, (base + age, base + age))

    take = lambda s: jobs.ingest_settled(table, str(folder), 60, as_of=TODAY, now=at(s))
    assert take(0) is None
    put("a", line("A", 1), 10)
    put("b", line("B", 1), 40)
    assert take(60) is None  # both may still grow
    assert take(80).seq == 0 and [r[0] for r in snapshot(table)] == ["A"]
    assert take(80) is None
    put("c", line("A", 2), 45)
    assert take(105).seq == 1 and [r[:2] for r in snapshot(table)] == [("A", 1), ("B", 1)]
    assert take(200).seq == 2 and [r[:2] for r in snapshot(table)] == [("A", 1), ("A", 2), ("B", 1)]


def test_interleaved_compactions_keep_every_batch(spark, tmp_path, monkeypatch):
    """A slow compaction that had read the table before a batch publishes after one that has folded it."""
    table = TradeTable.create(spark, f"{tmp_path}/table", compact_every=1000)
    many = lambda t: ingest.prepare_lines(spark.createDataFrame([(k, line(f"{t}{k}", 1)) for k in range(20)], "n int, line string"))
    ingest.ingest_batch(table, many("A"), ["n"], "s", 0, TODAY)
    stale = table.state()
    ingest.ingest_batch(table, many("B"), ["n"], "s", 1, TODAY)
    assert table.compact().folded == 1 and table.read().count() == 40
    real = TradeTable.state
    calls = []
    monkeypatch.setattr(TradeTable, "state", lambda self: calls.append(1) or (stale if len(calls) == 1 else real(self)))
    late = table.compact()
    assert (late.snapshot, late.folded) == (1, 1) and table.read().count() == 40
    assert len(list((tmp_path / "table").glob("snapshot-*"))) == 2  # the loser's folder is gone
    assert table.retire() and len(list((tmp_path / "table").glob("snapshot-*"))) == 1 and table.read().count() == 40


def test_a_late_attempt_of_a_committed_batch_changes_nothing(spark, tmp_path):
    """Two attempts of one batch: the one that commits first is what is read, whatever the other one writes later."""
    table = TradeTable.create(spark, f"{tmp_path}/table")
    one = lambda text: ingest.prepare_lines(spark.createDataFrame([(1, text)], "n int, line string"))
    late = table.begin("s", 0, TODAY)
    ingest.ingest_batch(table, one(line("A", 5)), ["n"], "s", 0, datetime.date(2030, 1, 1))
    rows = table.read().limit(0).withColumn("gone", F.lit(False))
    table.write_changes(late, rows)
    assert table.commit(late) is None and table.begin("s", 0).committed
    assert late.as_of == table.begin("s", 0).as_of == TODAY  # pinned once
    assert [(r[0], r[1]) for r in snapshot(table)] == [("A", 5)]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_settled_files_whatever_the_time_zone(spark, tmp_path, monkeypatch, zone):
    """The driver's zone differs from the session's (UTC): a file just written is too young, one two hours old is taken."""
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        table = TradeTable.create(spark, f"{tmp_path}/table")
        land(tmp_path / "landing", [[line("A", 1)]])
        path, now = tmp_path / "landing" / "part-000.txt", time.time()
        os.utime(path, (now, now))
        assert jobs.ingest_settled(table, str(tmp_path / "landing"), 3600, as_of=TODAY) is None
        os.utime(path, (now - 7200, now - 7200))
        assert jobs.ingest_settled(table, str(tmp_path / "landing"), 60, as_of=TODAY).committed
        assert jobs.ingest_settled(table, str(tmp_path / "landing"), 60, as_of=TODAY) is None
        assert table.read().count() == 1
    finally:
        monkeypatch.undo()
        time.tzset()


def test_start_at_latest_files(spark, tmp_path):
    land(tmp_path / "landing", [[line("OLD", 1)]])
    later = datetime.datetime.now() + datetime.timedelta(hours=1)
    lines = streams.line_stream(spark, f"{tmp_path}/landing", since=later)
    table = TradeTable.create(spark, f"{tmp_path}/table")
    jobs.ingest_stream(lines, table, f"{tmp_path}/checkpoint", as_of=TODAY, until_empty=True).awaitTermination()
    assert table.read().count() == 0


def test_small_batches_leave_the_snapshot_alone(spark, tmp_path):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORE.fields)
    stamp, far = datetime.datetime(2025, 1, 1), datetime.date(2030, 1, 1)
    held = [(f"B{k}", 1, None, "old", far, far, "{}", False, stamp) for k in range(200)]
    table = TradeTable.create(spark, f"{tmp_path}/table", spark.createDataFrame(held, columns))
    for k in range(4):
        texts = [line(f"B{k}", 1, book_id=f"new{k}"), line("B9", 1, book_id=f"new{k}"), line("B7", 0)]
        df = spark.createDataFrame(list(enumerate(texts)), "n int, line string")
        ingest.ingest_batch(table, ingest.prepare_lines(df), ["n"], "s", k, TODAY)
    state = table.state()
    assert (state.snapshot, state.last, len(state.since)) == (0, 3, 4)
    rows = {r["trade_id"]: r["book_id"] for r in table.read().collect()}
    assert len(rows) == 200 == table.read().count()
    assert {t: b for t, b in rows.items() if b != "old"} == {"B0": "new0", "B1": "new1", "B2": "new2", "B3": "new3", "B9": "new3"}
    assert len(letters(table)) == 4
    text = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in text
    assert table.compact().snapshot == 1 and table.state().since == {}
    assert {r["trade_id"]: r["book_id"] for r in table.read().collect()} == rows


def test_replay_of_dead_letters(spark, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/table")
    batch = spark.createDataFrame([(n, t) for n, t in enumerate(LINES) if t], "n int, line string")
    ingest.ingest_batch(table, ingest.prepare_lines(batch), ["n"], "s", 0, TODAY)
    before = snapshot(table)
    lines = replay.letter_lines(table, ["CONSTRAINT_NOT_NULL", "PARSE_ERROR"])
    assert lines.count() == 3
    repaired = lines.withColumn(
        "line",
        F.when(F.col("line").startswith("{broken"), F.lit(line("D", 1))).otherwise(F.col("line")),
    ).cache()
    for _ in range(2):
        done = replay.replay_letters(table, repaired, 1, TODAY)
    assert done.committed
    assert snapshot(table) == sorted([*before, ("D", 1, None, "2025-07-01", False)])


def test_landed_lines_have_times_in_event_order(spark, sf, tmp_path):
    """A stream takes files by time; the tasks of one write end in any order, so the landing sets the times."""
    from tidemark.checks.queries import land_lines

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land_lines(spark, sf, f"{tmp_path}/landing", 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    landed = sorted(pathlib.Path(f"{tmp_path}/landing").glob("*/part-*"))
    times = [os.stat(p).st_mtime_ns // 1_000_000 for p in landed]
    assert len(landed) > 8 and times == sorted(set(times))
