"""Every registered query against its SQL counterpart, and the published reason counts."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry_points
from tidemark.checks.oracle import ORACLE
from tidemark.checks.queries import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_registries_agree():
    assert set(ORACLE) <= set(QUERIES)
    assert not set(QUERIES) - set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    verdict, _, rows, shown = compare(spark, con, sf, name, QUERIES[name], ORACLE.get(name))
    assert verdict == "ok", shown
    assert rows > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "reason" in df.columns and df.count() > 0


def test_known_counts(spark):
    """Reason counts worked out beforehand for the sf0.01 tables."""
    counts = {
        r["reason"]: r["count"]
        for r in QUERIES["two_tier_rules"](spark, "/root/testdata/sf0.01").groupBy("reason").count().collect()
    }
    assert counts == {
        None: 11192,
        "DB_GUARDRAIL_REJECT": 7258 + 1280,
        "RULE_1_LOWER_VERSION_THAN_ACTIVE": 8981,
        "RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION": 1353,
    }
    lines = {
        r["reason"]: r["count"]
        for r in QUERIES["line_rules"](spark, "/root/testdata/sf0.01").groupBy("reason").count().collect()
    }
    assert lines == {
        None: 996,
        "CONSTRAINT_NOT_NULL": 2017,
        "PARSE_ERROR": 2014,
        "RULE_1_LOWER_VERSION_THAN_ACTIVE": 4464,
        "RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION": 509,
    }
