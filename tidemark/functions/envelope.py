"""JSON envelopes around accepted and rejected trades, and keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import PARTITIONS, bucket_of
from tidemark.schemas import TRADE_COLUMNS

# Reason codes of the dead-letter messages.
RULE_1 = "RULE_1_LOWER_VERSION_THAN_ACTIVE"
RULE_2 = "RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION"
DB_GUARDRAIL = "DB_GUARDRAIL_REJECT"
PARSE_ERROR = "PARSE_ERROR"
NOT_NULL = "CONSTRAINT_NOT_NULL"


def trade_struct(columns: list[str] | None = None, payload_as_object: bool = True) -> Column:
    """The trade as a struct; the payload is embedded as an object, not as quoted text."""
    fields = []
    for name in columns or TRADE_COLUMNS:
        if name == "payload" and payload_as_object:
            fields.append(F.try_parse_json(F.col(name)).alias(name))
        else:
            fields.append(F.col(name))
    return F.struct(*fields)


def reject_envelope(at: Column, raw: str) -> Column:
    """DLQ message text for a row carrying ``reason``, ``seen_version`` and ``db_error``.

    ``raw`` is the column with the record's own text.  A record that could not be read has it instead of the trade, so nothing
    is lost and a repaired record can be replayed.  Fields that do not apply are null and ``to_json`` leaves them out.
    """
    reason = F.col("reason")
    by_sink = reason.isin(DB_GUARDRAIL, PARSE_ERROR, NOT_NULL)
    unreadable = reason == PARSE_ERROR
    fields = [
        F.when(~unreadable, trade_struct()).alias("trade"),
        reason.alias("reason"),
        F.when(reason == RULE_1, F.col("seen_version")).alias("detected_latest_active_version"),
        F.when(~by_sink, at).alias("detected_at"),
        F.when(reason == DB_GUARDRAIL, F.col("db_error")).alias("db_error"),
        F.when(by_sink, at).alias("rejected_at"),
        F.when(unreadable, F.col(raw)).alias("raw"),
    ]
    return F.to_json(F.struct(*fields))


def accept_envelope(at: Column) -> Column:
    return F.to_json(F.struct(trade_struct().alias("trade"), at.alias("accepted_at")))


def route_tagged(judged: DataFrame, at: Column, raw: str) -> DataFrame:
    """(route, value): ``dlq`` with the reject envelope, ``accept`` with the accept envelope."""
    refused = F.col("reason").isNotNull()
    return judged.select(
        F.when(refused, F.lit("dlq")).otherwise(F.lit("accept")).alias("route"),
        F.when(refused, reject_envelope(at, raw)).otherwise(accept_envelope(at)).alias("value"),
    )


def keyed_messages(df: DataFrame, key_field: str = "Trade Id", partitions: int = PARTITIONS) -> DataFrame:
    """Broker-ready (key, value, partition); a frame without the key field gets null keys."""
    key = F.col(f"`{key_field}`").cast("string") if key_field in df.columns else F.lit(None).cast("string")
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select(
        key.alias("key"),
        value.alias("value"),
        F.when(key.isNotNull(), bucket_of(key, partitions)).alias("partition"),
    )
