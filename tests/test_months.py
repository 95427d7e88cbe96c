"""The store by month: rows that move, stopped and concurrent upserts, pruned folders."""

import datetime
import pathlib

import pytest

from tidemark.plans.months import UNDATED, MonthTable, by_month
from tidemark.schemas import STORE

D = datetime.date
MAY, JUNE, JULY = D(2025, 5, 3), D(2025, 6, 3), D(2025, 7, 1)


def rows(spark, *items):
    """(trade_id, book, maturity, expired)"""
    stamp = datetime.datetime(2025, 1, 1)
    return spark.createDataFrame([(t, 1, "CP", b, m, D(2024, 1, 1), "{}", e, stamp) for t, b, m, e in items], STORE)


def held(table):
    return sorted((r["trade_id"], r["book_id"], r["maturity_month"]) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    base = rows(spark, ("A", "x", MAY, False), ("B", "x", JUNE, False), ("C", "x", JULY, False), ("N", "x", None, True))
    return MonthTable.create(spark, f"{tmp_path}/months", base)


BASE = [("A", "x", "2025-05"), ("B", "x", "2025-06"), ("C", "x", "2025-07"), ("N", "x", UNDATED)]


def test_rows_move_and_other_months_stay(spark, table):
    before = table.head()[1]
    assert table.upsert(rows(spark, ("A", "y", JUNE, False), ("D", "y", JUNE, False))) == 1
    assert held(table) == [("A", "y", "2025-06"), ("B", "x", "2025-06"), ("C", "x", "2025-07"), ("D", "y", "2025-06"), ("N", "x", UNDATED)]
    after = table.head()[1]
    assert "2025-05" not in after  # its only row has moved
    assert sorted(m for m in after if after[m] == before.get(m)) == ["2025-07", UNDATED]
    table.upsert(rows(spark, ("N", "y", MAY, False)))
    assert UNDATED not in table.head()[1] and ("N", "y", "2025-05") in held(table)


def test_expired_rows_can_stay(spark, table):
    table.upsert(rows(spark, ("N", "y", MAY, False), ("A", "y", MAY, False)), on_expired="keep")
    assert held(table) == [("A", "y", "2025-05"), *BASE[1:]]


@pytest.mark.parametrize("step", ["_write", "_mark"])
def test_stopped_upsert_changes_nothing(spark, table, step, monkeypatch):
    new = rows(spark, ("A", "y", JUNE, False))

    def stop(*args):
        if step == "_write":
            MonthTable._write(table, *args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(table, step, stop)
    with pytest.raises(RuntimeError, match="stopped"):
        table.upsert(new)
    monkeypatch.undo()
    assert held(table) == BASE
    table.upsert(new)
    assert held(table) == [("A", "y", "2025-06"), *BASE[1:]]


def test_two_writers_keep_both_batches(spark, table, monkeypatch):
    other, mark, turns = MonthTable(spark, table.root), table._mark, []

    def late(name, content):
        if not turns:
            turns.append(other.upsert(rows(spark, ("A", "z", JULY, False), ("B", "z", JUNE, False))))
        return mark(name, content)

    monkeypatch.setattr(table, "_mark", late)
    assert table.upsert(rows(spark, ("A", "y", JUNE, False))) == 2 and turns == [1]
    assert held(table) == [("A", "y", "2025-06"), ("B", "z", "2025-06"), *BASE[2:]]
    names = {p.name for p in pathlib.Path(table.root, "rows").iterdir() if p.name.startswith("attempt")}
    assert len(names) == 3  # the first attempt of the late writer is gone


def test_only_touched_months_are_read(spark, table):
    number, months = table.head()
    batch = by_month(rows(spark, ("A", "y", JUNE, False)))
    touched = table.touched(months, batch)
    assert {r["maturity_month"] for r in touched.collect()} == {"2025-05", "2025-06"}
    found = table.held(months, touched)
    plan = found._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    assert {r["trade_id"] for r in found.collect()} == {"A", "B"}


def test_retire_keeps_the_newest_state(spark, table):
    table.upsert(rows(spark, ("A", "y", JUNE, False)))
    after = held(table)
    gone = table.retire()
    assert len(gone) == 3 and held(table) == after  # May and the old June, and the first marker
    assert table.retire() == []


def test_empty_tables(spark, tmp_path):
    table = MonthTable.create(spark, f"{tmp_path}/none", rows(spark, ("A", "x", MAY, False)).limit(0))
    assert held(table) == []
    table.upsert(rows(spark, ("A", "x", MAY, False)).limit(0))
    table.upsert(rows(spark, ("A", "x", MAY, False)))
    assert held(table) == BASE[:1]
    with pytest.raises(ValueError, match="already"):
        MonthTable.create(spark, f"{tmp_path}/none", rows(spark, ("A", "x", MAY, False)))
