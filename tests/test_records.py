"""Decoding, validation, envelopes and payloads."""

import datetime
import json

from pyspark.sql import functions as F

from tidemark.functions import envelope
from tidemark.functions.dates import any_date, iso_date
from tidemark.functions.payload import payload_field
from tidemark.operators import canonical, validate, version_rules
from tidemark.schemas import TRADE, TRADE_COLUMNS
from tidemark.sources import dlq

D = datetime.date


def lines(spark, *texts):
    return spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, line string")


def test_dates(spark):
    texts = [
        "2025-01-31",
        "2025-01-31T10:00:00Z",
        "31/01/2025",
        "2025-02-30",
        "2025-1-31",
        "20250131",
        "",
        None,
        "31/13/2025",
    ]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, s string")
    got = [tuple(r) for r in df.orderBy("n").select(iso_date(F.col("s")), any_date(F.col("s"))).collect()]
    day = D(2025, 1, 31)
    assert got == [(day, day), (day, day), (None, day)] + [(None, None)] * 6


def test_decode_lines(spark):
    df = lines(
        spark,
        '{"trade_id":"T1","version":2,"maturity_date":"2025-01-31","payload":{"a":{"b":1}}}',
        '{"tradeId":"T1","version":"3","maturityDate":"2025-01-31T00:00:00","payload":"{\\"a\\":1}"}',
        '{"Trade Id":"T2","Version":4,"Counter-Party_Id":"CP-1","Book-Id":"B2","Maturity_Date":"31/01/2025"}',
        '{"trade_id":"T3"}',
        '{"trade_id":"T3","version":"","payload":null}',
        '{"trade_id":"T4","version":"x"}',
        '{"trade_id":"T5","version":1,"payload":"not json"}',
        '{"trade_id":"T6","ver',
        "[1]",
        "null",
    )
    rows = canonical.decode_lines(df).orderBy("n").collect()
    assert [r["version"] for r in rows[:5]] == [2, 3, 4, 0, 0]
    assert [r["reject_code"] for r in rows] == [None] * 5 + ["PARSE_ERROR"] * 5
    assert [r["maturity_date"] for r in rows[:4]] == [D(2025, 1, 31)] * 3 + [None]
    assert [json.loads(r["payload"]) for r in rows[:5]] == [{"a": {"b": 1}}, {"a": 1}, {}, {}, {}]
    assert (rows[2]["counter_party_id"], rows[2]["book_id"]) == ("CP-1", "B2")
    assert rows[5]["trade_id"] is None


def test_strict_decode(spark):
    df = lines(
        spark,
        '{"trade_id":"T1","version":1,"maturity_date":"2025-01-31"}',
        '{"trade_id":"T1","version":1,"maturity_date":"2025-01-31T00:00:00"}',
        '{"trade_id":"T1","maturity_date":"2025-01-31"}',
        '{"version":1,"maturity_date":"2025-01-31"}',
        "oops",
    )
    codes = [r["reject_code"] for r in canonical.strict_decode(df).orderBy("n").collect()]
    assert codes == [None] + ["parse_error"] * 4


def test_constraint_and_spec_rules(spark):
    rows = [
        ("T1", 1, "CP", "B", D(2025, 1, 1), D(2024, 1, 1), "{}"),
        (None, 1, "CP", "B", D(2025, 1, 1), D(2024, 1, 1), "{}"),
        ("T2", 1, "CP", "B", None, D(2024, 1, 1), "{}"),
        ("T3", 9, "CP", "B", D(2025, 1, 1), D(2026, 1, 1), "{}"),
    ]
    df = spark.createDataFrame(rows, TRADE)
    codes = [r["reject_code"] for r in validate.constraint_check(df).collect()]
    assert codes == [None, "CONSTRAINT_NOT_NULL", "CONSTRAINT_NOT_NULL", None]
    spec = '{"rules":[{"code":"BACKWARDS","reject_when":"maturity_date < created_date"},{"code":"HIGH","reject_when":"version > 5"}]}'
    checked = validate.validate(df, {**validate.not_null_rules(), **validate.rules_from_spec(spec)}).collect()
    assert [r["reasons"] for r in checked] == [
        [],
        ["CONSTRAINT_NOT_NULL:trade_id"],
        ["CONSTRAINT_NOT_NULL:maturity_date"],
        ["BACKWARDS", "HIGH"],
    ]
    assert [r["is_valid"] for r in checked] == [True, False, False, False]


def test_rules_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"rules": [\n {"code": "HIGH", "reject_when": "version > 5"}\n]}')
    df = spark.createDataFrame([(5,), (6,)], "version int")
    checked = validate.validate(df, validate.load_rules(spark, str(path))).collect()
    assert [r["reasons"] for r in checked] == [[], ["HIGH"]]


def test_envelopes(spark):
    today = D(2025, 6, 1)
    rows = [
        ("T1", 2, "CP", "B", D(2025, 7, 1), D(2024, 1, 1), '{"a":{"b":1}}', 1, "line 1", None),
        ("T1", 1, "CP", "B", D(2025, 7, 1), D(2024, 1, 1), "{}", 2, "line 2", None),
        ("T1", 2, "CP", "B", D(2025, 5, 1), D(2024, 1, 1), "{}", 3, "line 3", None),
        ("T2", 1, "CP", "B", D(2025, 7, 1), D(2024, 1, 1), "{}", 4, "line 4", None),
        (None, None, None, None, None, None, None, 5, "line 5", "PARSE_ERROR"),
    ]
    df = spark.createDataFrame(rows, TRADE.simpleString()[7:-1] + ",n:int,raw:string,reject_code:string")
    levels = spark.createDataFrame([("T2", None, 4)], "trade_id string, seen_version int, active_version int")
    judged = version_rules.two_tier(df, levels, ["n"], F.lit(today))
    at = F.lit(datetime.datetime(2025, 6, 1, 12))
    routed = envelope.route_tagged(judged, at, raw="raw").collect()
    accepted = [json.loads(r["value"]) for r in routed if r["route"] == "accept"]
    rejected = {
        m["reason"]: m for m in (json.loads(r["value"]) for r in routed if r["route"] == "dlq")
    }
    assert len(accepted) == 1 and accepted[0]["trade"]["payload"] == {"a": {"b": 1}} and accepted[0]["accepted_at"]
    rule_1 = rejected[envelope.RULE_1]
    assert rule_1["detected_latest_active_version"] == 2 and "detected_at" in rule_1 and "db_error" not in rule_1
    rule_2 = rejected[envelope.RULE_2]
    assert "detected_latest_active_version" not in rule_2 and rule_2["trade"]["maturity_date"] == "2025-05-01"
    by_store = rejected[envelope.DB_GUARDRAIL]
    assert by_store["db_error"].startswith("REJECTED_BY_DB_GUARDRAIL") and "rejected_at" in by_store
    assert rejected["PARSE_ERROR"]["raw"] == "line 5" and "trade" not in rejected["PARSE_ERROR"]

    messages = dlq.decode_dlq(
        spark.createDataFrame([(r["value"],) for r in routed if r["route"] == "dlq"] + [("not json",)], "value string")
    )
    assert messages.filter("raw = 'not json'").count() == 1
    assert dlq.find_messages(messages, "T1", version=1).first()["reason"] == envelope.RULE_1
    assert dlq.find_messages(messages, "T1", maturity_date="2025-05-01").count() == 1


def test_keyed_messages(spark):
    df = spark.createDataFrame([("T1", 1), (None, 2)], "`Trade Id` string, Version int")
    rows = envelope.keyed_messages(df).collect()
    assert json.loads(rows[0]["value"]) == {"Trade Id": "T1", "Version": 1}
    assert rows[0]["key"] == "T1" and 0 <= rows[0]["partition"] < 32
    assert rows[1]["key"] is None and rows[1]["partition"] is None
    assert envelope.keyed_messages(df, "absent").filter("key IS NOT NULL").count() == 0


def test_payload_field(spark):
    df = spark.createDataFrame([('{"a":{"b":"7"},"c":[1,2]}',), ("{}",), ("broken",)], "p string")
    got = [tuple(r) for r in df.select(payload_field(F.col("p"), "$.a.b", "int"), payload_field(F.col("p"), "$.c[1]", "int")).collect()]
    assert got == [(7, 2), (None, None), (None, None)]


def test_canonicalize_keeps_missing_columns_null(spark):
    df = spark.createDataFrame([("T1", 3, "01/02/2025")], "`Trade Id` string, Version long, Maturity_Date string")
    row = canonical.canonicalize(df).first()
    assert row.asDict() == {
        **dict.fromkeys(TRADE_COLUMNS),
        "trade_id": "T1",
        "version": 3,
        "maturity_date": D(2025, 2, 1),
        "payload": "{}",
    }
