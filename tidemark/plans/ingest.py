"""One batch of records into the trade table: the same code for micro-batches, bulk loads and replays."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import reject_envelope
from tidemark.operators.canonical import decode_lines
from tidemark.operators.metrics import outcome_metrics
from tidemark.operators.store import as_store_rows, latest_per_key
from tidemark.operators.validate import constraint_check
from tidemark.operators.version_rules import two_tier
from tidemark.plans.table import GONE, Batch, TradeTable
from tidemark.schemas import ATTRIBUTES, KEY, TRADE_COLUMNS

# Fixed value: dead letters are written to compressed files of at most this many, which a task reads whole.
LETTERS_PER_FILE = 200_000


def prepare_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Raw lines to canonical columns with ``reject_code`` and the line kept for dead letters."""
    return constraint_check(decode_lines(df, line))


def ingest_batch(
    table: TradeTable,
    records: DataFrame,
    order: Sequence[str],
    source: str,
    name: str | int,
    as_of: datetime.date | None = None,
    raw: str = "line",
    arrived: str | None = None,
) -> Batch:
    """Judge a batch of prepared records and commit its outcome.

    ``name`` tells the batch apart from others of its source; one that was committed before is left alone.  Dates and times
    are those pinned at the first attempt, so a repeat writes the same rows to the same paths.  ``raw`` is the column with the
    record's own text, which dead letters need; ``arrived`` one with its arrival time, for the lag.
    """
    columns = list(dict.fromkeys([*TRADE_COLUMNS, *order, "reject_code", raw, *([arrived] if arrived else [])]))
    if "reject_code" not in records.columns:
        records = constraint_check(records)
    batch = table.begin(source, name, as_of)
    if batch.committed:
        return batch
    # only records that could not be read go to the dead letters as text; the others' text would move and be written for nothing
    if raw not in (*TRADE_COLUMNS, *order, arrived):
        records = records.withColumn(raw, F.when(F.col("reject_code").isNotNull(), F.col(raw)))
    # read for the levels and for the judgement, and once more if another batch commits first
    prepared = table.path("prepared", batch.folder)
    records.select(*columns).write.mode("overwrite").parquet(prepared, compression="zstd")
    held = table.spark.read.parquet(prepared)

    def judge(batch: Batch) -> None:
        levels = table.levels(touched=held.filter("reject_code IS NULL"))
        judged = two_tier(held, levels, order, F.lit(batch.as_of))
        # the other outputs are read back from this table: one evaluation, and lost executors cost no rework
        judged.write.mode("overwrite").parquet(table.path("outcomes", batch.folder), compression="zstd")
        _write_outputs(table, batch, order, raw, arrived)

    return table.apply(source, name, judge, as_of)


def _write_outputs(table: TradeTable, batch: Batch, order: Sequence[str], raw: str, arrived: str | None) -> None:
    at = F.lit(batch.at)
    judged = table.spark.read.parquet(table.path("outcomes", batch.folder))
    accepted = judged.filter(F.col("reason").isNull())
    rejected = judged.filter(F.col("reason").isNotNull())

    latest = latest_per_key(accepted, KEY, order, [*KEY, *ATTRIBUTES])
    rows = as_store_rows(latest, at).withColumn(GONE, F.lit(False))
    valid = judged.filter(F.col("reject_code").isNull())
    # a judged row's seen_version already covers the earlier batches
    marks = valid.groupBy("trade_id").agg(F.max(F.greatest("version", "seen_version")).alias("seen_version"))
    letters = rejected.select(reject_envelope(at, raw).alias("value"))
    came = F.col(arrived) if arrived else F.lit(None).cast("timestamp")
    counts = outcome_metrics(judged, arrived=came, now=at).withColumns(
        {"source": F.lit(batch.source), "at": at, "as_of": F.lit(batch.as_of)}
    )
    # independent small jobs, so they are submitted together
    writes = [
        lambda: table.write_changes(batch, rows, marks),
        lambda: letters.write.mode("overwrite").option("maxRecordsPerFile", LETTERS_PER_FILE).text(table.path("dlq", batch.folder), compression="gzip"),
        lambda: counts.write.mode("overwrite").parquet(table.path("metrics", batch.folder)),
    ]
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(table.spark)(w)) for w in writes]:
            done.result()


def rebuild_store(
    history: DataFrame,
    order: Sequence[str],
    as_of: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """The store that replaying a whole history from nothing gives, in one plan."""
    accepted = two_tier(history, None, order, as_of).filter(F.col("reason").isNull())
    return as_store_rows(latest_per_key(accepted, KEY, order, [*KEY, *ATTRIBUTES]), F.current_timestamp() if now is None else now)
