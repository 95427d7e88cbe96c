"""Chunked, arrayed and converted files, manifests and audit rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.parts import array_chunks, assign_parts, order_free_checksum, part_sizes
from tidemark.schemas import AUDIT
from tidemark.session import one_row, shuffles_freed

# Rows per chunk file of the small-file and the bulk flow.
SMALL_CHUNK = 5_000
BULK_CHUNK = 50_000


def write_records(
    df: DataFrame, path: str, format: str = "json", rows_per_file: int | None = None, compression: str | None = None
) -> None:
    """Write records as json (lines), csv (with header), text or parquet, in chunks of at most ``rows_per_file`` rows.

    A compressed text file is read by one task, so name ``rows_per_file`` with a ``compression``.
    """
    writer = df.write.mode("overwrite").format(format)
    if compression:
        writer = writer.option("compression", compression)
    if format == "csv":
        writer = writer.option("header", True)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(path)


def write_arrays(df: DataFrame, path: str, id_cols: Sequence[str], columns: Sequence[str], rows_per_array: int = BULK_CHUNK) -> None:
    """Write JSON arrays, one per line, each of at most ``rows_per_array`` records."""
    array_chunks(df, id_cols, columns, rows_per_array).select("value").write.mode("overwrite").text(path)


def write_by_extension(
    df: DataFrame, path: str, id_cols: Sequence[str], rows_per_file: int = BULK_CHUNK, compression: str | None = None
) -> None:
    """Write a folder in the format that its name ends with: ``.jsonl``, ``.csv``, ``.parquet``, or ``.json`` for JSON arrays.

    A ``.json`` folder has one array document per file; ``id_cols`` identify a record and give the arrays a fixed content.
    """
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "json":
        with shuffles_freed(df.sparkSession):
            arrays = array_chunks(df, id_cols, df.columns, rows_per_file).select("value")
            arrays.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path, compression=compression)
    elif kind in ("jsonl", "ndjson", "csv", "parquet"):
        write_records(df, path, "json" if kind in ("jsonl", "ndjson") else kind, rows_per_file, compression)
    else:
        raise ValueError(f"no format for {path!r}")


def write_parts(df: DataFrame, path: str, id_cols: Sequence[str], parts: int, minsize: int, seed: int = 0) -> list[int]:
    """Write ``parts`` randomly filled folders ``part=k``, one of exactly ``minsize`` records; returns the sizes."""
    sizes = part_sizes(df.count(), parts, minsize, seed)
    placed = assign_parts(df, id_cols, sizes, seed)
    placed.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").json(path)
    return sizes


def build_manifest(spark: SparkSession, chunks: str, correlation_id: str, manifest_path: str) -> DataFrame:
    """Manifest of a folder of chunk files: a row per chunk with its path, rows and checksum, and the load's totals on each.

    The shape is the same for any number of chunks, and no list of them is made.
    """
    per_file = chunk_sums(spark.read.text(chunks))
    total = per_file.agg(F.count(F.lit(1)).alias("chunk_count"), F.sum("rows").alias("total_rows"))
    return per_file.join(F.broadcast(total)).select(  # total is one row
        F.lit(manifest_path).alias("manifest_path"),
        "chunk_path",
        "rows",
        "checksum",
        "chunk_count",
        "total_rows",
        F.lit(correlation_id).alias("correlation_id"),
    )


def chunk_sums(lines: DataFrame) -> DataFrame:
    """Of a text scan: ``chunk_path, rows, checksum`` per file.  The checksum ignores the order of lines."""
    return lines.groupBy(F.col("_metadata.file_path").alias("chunk_path")).agg(
        F.count(F.lit(1)).alias("rows"), order_free_checksum(["value"]).alias("checksum")
    )


def append_audit(
    spark: SparkSession,
    path: str,
    correlation_id: str,
    status: str,
    job_id: str | None = None,
    manifest_path: str | None = None,
    details: str | None = None,
    now: Column | None = None,
) -> bool:
    """Append one audit row.  A failure to write only warns: it must not undo a finished ingest."""
    row = one_row(
        spark,
        "correlation_id string, job_id string, manifest_path string, status string, details string",
        (correlation_id, job_id, manifest_path, status, details),
    ).withColumn("created_at", F.current_timestamp() if now is None else now)
    try:
        row.write.mode("append").parquet(path)
    except Exception as problem:  # noqa: BLE001 - any storage failure is only reported
        print(f"[warn] audit row for {correlation_id} not written: {problem}")
        return False
    return True


def read_audit(spark: SparkSession, path: str, correlation_id: str | None = None) -> DataFrame:
    rows = spark.read.schema(AUDIT).parquet(path)
    return rows if correlation_id is None else rows.filter(F.col("correlation_id") == correlation_id)


def recent_audit(audit: DataFrame, limit: int) -> DataFrame:
    """The newest audit rows; Spark runs this as a top-k, not as a full sort."""
    return audit.orderBy(F.col("created_at").desc(), F.col("correlation_id")).limit(limit)
