"""Bulk flow: manifest to store, with an audit row."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.ingest import ingest_batch, prepare_lines
from tidemark.plans.table import TradeTable
from tidemark.session import shuffles_freed
from tidemark.sinks.files import BULK_CHUNK, append_audit, build_manifest, write_records
from tidemark.sources.files import read_chunks, read_manifest


def stage_bulk(records: DataFrame, folder: str, correlation_id: str, rows_per_chunk: int = BULK_CHUNK) -> str:
    """Write records as chunk files with a manifest; returns the manifest's path.

    A frame with a single ``line`` column is written as it stands, any other as JSON lines.
    """
    path = f"{folder}/manifest"
    with shuffles_freed(records.sparkSession):
        # a chunk is read by one task, so it may as well be compressed
        write_records(records, f"{folder}/chunks", "text" if records.columns == ["line"] else "json", rows_per_chunk, "gzip")
        build_manifest(records.sparkSession, f"{folder}/chunks", correlation_id, path).write.mode("overwrite").json(path)
    return path


def bulk_ingest(
    spark: SparkSession,
    table: TradeTable,
    manifest_path: str,
    correlation_id: str,
    order: dict[str, str],
    as_of: datetime.date | None = None,
    audit_path: str | None = None,
) -> dict:
    """Read a manifest's chunks, judge them against the table, commit, and audit.

    Chunks are read as lines and take the stream's way: the same aliases, parse and payload checks, and dead letters with the
    record's text.  ``order`` names the columns that order the records, as SQL over ``line``.  The correlation id
    is the batch's name in the commit, so running it again changes nothing.
    """
    status, details = "FAILED", {}
    try:
        manifest = read_manifest(spark, manifest_path, correlation_id)
        lines = read_chunks(spark, manifest).withColumns({name: F.expr(text) for name, text in order.items()})
        with shuffles_freed(spark):
            done = ingest_batch(table, prepare_lines(lines), list(order), "bulk", correlation_id, as_of)
        status, details = "SUCCESS", {"seq": done.seq}
    except Exception as problem:
        details = {"error": str(problem)}
        raise
    finally:
        if audit_path:
            append_audit(
                spark,
                audit_path,
                correlation_id,
                status,
                job_id=f"bulk-{correlation_id}",
                manifest_path=manifest_path,
                details=json.dumps(details),
            )
    return details
