"""Batch file scans and landing-folder work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import MANIFEST, WIRE
from tidemark.session import scratch_path
from tidemark.sinks.files import chunk_sums
from tidemark.sources.arrays import array_records

CORRUPT = "_corrupt"
# Fixed value: files above this many bytes take the bulk route.
LARGE_FILE = 50_000_000
# Records of array documents are written to compressed files of this many before their schema is inferred; a task reads one whole.
RECORDS_PER_FILE = 200_000


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank text lines, trimmed, with bad UTF-8 replaced, as ``line``."""
    return clean_lines(spark.read.text(path)).select("line")


def clean_lines(text: DataFrame) -> DataFrame:
    """Add ``line`` to a text scan and drop blank lines."""
    return text.withColumn("line", F.trim(F.make_valid_utf8("value"))).filter(F.col("line") != "")


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType = WIRE) -> DataFrame:
    """JSON lines with a fixed schema.

    Blank lines are dropped and bad UTF-8 is replaced; a line that does not parse or does not fit the
    schema keeps its text in ``_corrupt``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("line", _with_corrupt(schema), options)
    return read_lines(spark, path).select(parsed.alias("record")).select("record.*")


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType = WIRE) -> DataFrame:
    """Records of JSON array documents with a fixed schema, a document read by many tasks; ``_corrupt`` as in ``read_jsonl``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("line", _with_corrupt(schema), options)
    return array_records(spark, path).select(parsed.alias("record")).select("record.*")


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header line and a named schema; rows that do not fit keep their text in ``_corrupt``."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_inferred(spark: SparkSession, path: str, kind: str | None = None, sampling: float = 1.0) -> DataFrame:
    """Schema-inferring scan; ``kind`` defaults to the path's extension.

    Inference is one extra pass over the text; ``sampling`` below 1.0 reads only a part of the rows for it.  The records of
    ``.json`` documents are written as lines first, so that both passes read a large document by many tasks.
    """
    suffix = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", sampling).csv(path)
    if suffix == "json":
        lines = scratch_path(spark, "records")
        # read back twice at once by this scan, never by others
        array_records(spark, path).write.option("maxRecordsPerFile", RECORDS_PER_FILE).text(lines, compression="gzip")
        return spark.read.option("samplingRatio", sampling).json(lines)
    if suffix in ("jsonl", "ndjson"):
        return spark.read.option("samplingRatio", sampling).json(path)
    if suffix == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"cannot infer a reader for {path!r}")


def landing_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "*",
    min_age_seconds: int = 0,
    now: Column | None = None,
) -> DataFrame:
    """Files of a landing folder that are old enough: (path, length, modified).

    Only the listing is read; the content column is pruned from the scan.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    ready = (F.current_timestamp() if now is None else now) - F.make_dt_interval(secs=F.lit(min_age_seconds))
    return listed.filter(F.col("modified") <= ready)


def route_by_size(files: DataFrame, threshold: int = LARGE_FILE) -> DataFrame:
    """Add ``route``: ``large`` above the threshold, else ``small``."""
    return files.withColumn("route", F.when(F.col("length") > threshold, F.lit("large")).otherwise(F.lit("small")))


def with_lineage(scan: DataFrame, now: Column | None = None) -> DataFrame:
    """File-level lineage on every record of a file scan, taken from the scan's ``_metadata``.

    ``correlation_id`` is file name and modification time in milliseconds, ``manifest_path`` the file's path.
    """
    stamp = F.unix_millis(F.col("_metadata.file_modification_time"))
    return scan.withColumns(
        {
            "correlation_id": F.concat_ws("-", F.col("_metadata.file_name"), stamp.cast("string")),
            "manifest_path": F.col("_metadata.file_path"),
            "ingest_ts": F.current_timestamp() if now is None else now,
        }
    )


def read_manifest(spark: SparkSession, path: str, correlation_id: str) -> DataFrame:
    """Manifest rows of one correlation id.  Both arguments are required, as is at least one matching row."""
    if not path or not correlation_id:
        raise ValueError("manifest_path and correlation_id are required")
    rows = spark.read.schema(MANIFEST).json(path).filter(F.col("correlation_id") == correlation_id)
    if rows.isEmpty():
        raise ValueError(f"no manifest for correlation_id {correlation_id!r} at {path}")
    return rows


def read_chunks(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The lines of a manifest's chunks, after comparing rows and checksum of every file with the manifest.

    The chunks' folders are scanned and joined to the manifest by path, so the driver holds no list of files.
    Raises if a chunk is missing, holds other lines, or the chunks do not add up to the manifest's totals.
    """
    folders = [r["f"] for r in manifest.select(F.regexp_replace("chunk_path", "/[^/]*$", "").alias("f")).distinct().collect()]
    scan = spark.read.text(folders)
    found = chunk_sums(scan).withColumnsRenamed({"rows": "found_rows", "checksum": "found_checksum"})
    same = F.col("rows").eqNullSafe(F.col("found_rows")) & F.col("checksum").eqNullSafe(F.col("found_checksum"))
    check = manifest.join(found, "chunk_path", "left").agg(
        F.count_if(~same).alias("wrong"),
        F.min_by("chunk_path", F.when(~same, F.col("chunk_path"))).alias("first"),
        F.count(F.lit(1)).alias("chunks"),
        F.sum("rows").alias("rows"),
        F.max("chunk_count").alias("chunk_count"),
        F.max("total_rows").alias("total_rows"),
    ).first()
    if check["wrong"]:
        raise ValueError(f"{check['wrong']} chunks differ from the manifest in rows or checksum, such as {check['first']}")
    if (check["chunks"], check["rows"]) != (check["chunk_count"], check["total_rows"]):
        promised = f"{check['total_rows']} rows in {check['chunk_count']} chunks"
        raise ValueError(f"manifest promises {promised}, it lists {check['rows']} in {check['chunks']}")
    # one row per file, as many as the scan's own listing on the driver; a join by path would move every line
    listed = F.broadcast(manifest.select("chunk_path"))
    lines = clean_lines(scan).select("line", F.col("_metadata.file_path").alias("chunk_path"))
    return lines.join(listed, "chunk_path", "left_semi").select("line", "chunk_path")
