"""Dead-letter scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = (
    "trade struct<trade_id string, version int, counter_party_id string, book_id string,"
    " maturity_date string, created_date string, payload string>,"
    " reason string, detected_latest_active_version int, detected_at string,"
    " db_error string, rejected_at string, raw string, _corrupt string"
)


def read_dlq(spark: SparkSession, path: str) -> DataFrame:
    """Dead-letter text files as ``value``."""
    return spark.read.text(path)


def decode_dlq(df: DataFrame, value: str = "value") -> DataFrame:
    """Message fields; text that is not JSON comes back whole in ``raw``."""
    parsed = F.from_json(F.col(value), MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return (
        df.withColumn("_m", parsed)
        .select("*", "_m.*")
        .withColumn("raw", F.coalesce("raw", "_corrupt"))
        .drop("_m", "_corrupt")
    )


def find_messages(
    messages: DataFrame,
    trade_id: str,
    version: int | None = None,
    maturity_date: str | None = None,
) -> DataFrame:
    """Messages about a trade, optionally of one version or one maturity date."""
    hit: Column = F.col("trade.trade_id") == trade_id
    if version is not None:
        hit = hit & (F.col("trade.version") == version)
    if maturity_date is not None:
        hit = hit & (F.col("trade.maturity_date") == maturity_date)
    return messages.filter(hit)
