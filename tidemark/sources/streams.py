"""Streaming scans."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import clean_lines

# Arrival order of a file stream: file time, then path, block and position in the block.
ARRIVAL = ["file_time", "file_path", "block_start", "row_id"]


def line_stream(
    spark: SparkSession,
    folder: str,
    files_per_batch: int | None = None,
    pattern: str | None = None,
    since: datetime.datetime | None = None,
    archive_to: str | None = None,
) -> DataFrame:
    """Text lines of a landing folder as a stream, with their arrival order and lineage.

    ``since`` starts at the latest files instead of the earliest.  ``archive_to`` moves files away once
    they are processed.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    scan = clean_lines(reader.load(folder))
    if since is not None:
        scan = scan.filter(F.col("_metadata.file_modification_time") >= F.lit(since))
    return scan.select(
        "line",
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def with_row_id(batch: DataFrame) -> DataFrame:
    """Add ``row_id`` to a micro-batch straight from the scan, before any shuffle.

    It grows along each block of a file, so (file, block_start, row_id) gives the order of the lines
    however the scan was split.
    """
    return batch.withColumn("row_id", F.monotonically_increasing_id())


def broker_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """The same frame from a Kafka-protocol broker, starting at the latest offsets.

    Needs the Kafka connector on the session's classpath.  Partition and offset are the arrival order
    of a key, since a key always goes to one partition.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("line"), "partition", "offset")
