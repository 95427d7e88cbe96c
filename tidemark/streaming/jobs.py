"""Streaming ingest and the small-file flow."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.envelope import keyed_messages
from tidemark.operators.canonical import decode_lines
from tidemark.operators.validate import not_null_rules, validate
from tidemark.plans.ingest import ingest_batch, prepare_lines
from tidemark.plans.table import Batch, TradeTable
from tidemark.schemas import TRADE_COLUMNS
from tidemark.sources.files import clean_lines
from tidemark.sources.streams import ARRIVAL, with_row_id

# Fixed value: interval between batches.
INTERVAL = "10 seconds"


def ingest_stream(
    lines: DataFrame,
    table: TradeTable,
    checkpoint: str,
    order: Sequence[str] = tuple(ARRIVAL),
    source: str = "stream",
    as_of: datetime.date | None = None,
    interval: str = INTERVAL,
    until_empty: bool = False,
) -> StreamingQuery:
    """Start the ingest: lines to canonical records, both rule tiers, upsert, dead letters, metrics.

    Each micro-batch commits under its own number, so a batch Spark repeats after a failure is either
    completed or recognised as done.  A storage failure fails the query.  ``until_empty`` stops after
    the data present at the start, still in batches of the source's limits.
    """

    def commit(batch: DataFrame, number: int) -> None:
        if "row_id" in order and "row_id" not in batch.columns:
            batch = with_row_id(batch)
        arrived = "file_time" if "file_time" in batch.columns else None
        ingest_batch(table, prepare_lines(batch), order, source, number, as_of, arrived=arrived)

    writer = lines.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_empty else writer.trigger(processingTime=interval)).start()


def ingest_settled(
    table: TradeTable,
    folder: str,
    min_age_seconds: int,
    source: str = "landing",
    pattern: str = "*",
    as_of: datetime.date | None = None,
    now: datetime.datetime | None = None,
) -> Batch | None:
    """One round of a landing folder whose files are still being written for a while: take what has settled since the last.

    A round takes the files last modified before ``now - min_age_seconds`` and not before the previous round's limit, so every
    file is taken once, and none that may still grow.  The limit becomes known with the round's commit; a round that fails is
    taken again.  Limits are whole seconds since 1970 and meet the files' times as such, so no time zone has a part in it.  A
    ``now`` without a zone is local time of the driver.  None if nothing has settled.
    """
    spark = table.spark
    until = int((now or datetime.datetime.now()).timestamp()) - min_age_seconds
    since = table.last_round(source)
    modified = F.unix_micros(F.col("_metadata.file_modification_time"))
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    scan = clean_lines(reader.text(folder)).filter((modified < F.lit(until * 1_000_000)) & (modified >= F.lit(since * 1_000_000)))
    lines = scan.select(
        "line",
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    if lines.isEmpty():
        return None
    table.begin_round(source, until)
    return ingest_batch(table, prepare_lines(with_row_id(lines)), ARRIVAL, source, f"until {until}", as_of, arrived="file_time")


def small_file_flow(
    lines: DataFrame,
    target: str,
    checkpoint: str,
    rows_per_file: int,
    until_empty: bool = False,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Landing files to validated, keyed messages with file lineage; invalid records go to ``dlq``.

    Writes ``messages/batch=N`` (key, value, partition, correlation_id, manifest_path) and ``dlq/batch=N``
    in chunks of at most ``rows_per_file`` rows.
    """
    decoded = decode_lines(lines).withColumns(
        {
            "correlation_id": F.concat_ws(
                "-", F.col("file_name"), F.unix_millis(F.col("file_time")).cast("string")
            ),
            "manifest_path": F.col("file_path"),
        }
    )
    rules = {"PARSE_ERROR": F.col("reject_code").isNotNull(), **not_null_rules()}
    judged = validate(decoded, rules)
    lineage = ["correlation_id", "manifest_path"]

    def publish(batch: DataFrame, number: int) -> None:
        kept = batch.select("line", "reasons", "is_valid", *TRADE_COLUMNS, *lineage)
        # two outputs of one batch: written once to the shared folder, then split
        held = f"{target}/judged/batch={number}"
        kept.write.mode("overwrite").parquet(held)
        kept = batch.sparkSession.read.schema(kept.schema).parquet(held)
        messages = keyed_messages(kept.filter("is_valid").select(*TRADE_COLUMNS, *lineage), "trade_id")
        letters = kept.filter("NOT is_valid").select("reasons", F.col("line").alias("raw"), *lineage)
        for name, df in (("messages", messages), ("dlq", letters)):
            df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).json(f"{target}/{name}/batch={number}")

    writer = judged.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_empty else writer.trigger(processingTime=interval)).start()
