"""Column sets and schemas shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["trade_id", "version"]

# Attributes an upsert replaces, besides expired_flag and ingest_ts.
ATTRIBUTES = ["counter_party_id", "book_id", "maturity_date", "created_date", "payload"]

TRADE_COLUMNS = [*KEY, *ATTRIBUTES]
STORE_COLUMNS = [*TRADE_COLUMNS, "expired_flag", "ingest_ts"]

# Wire format of a stream message: dates travel as text, payload as JSON text.
WIRE = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("counter_party_id", T.StringType()),
        T.StructField("book_id", T.StringType()),
        T.StructField("maturity_date", T.StringType()),
        T.StructField("created_date", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

TRADE = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("counter_party_id", T.StringType()),
        T.StructField("book_id", T.StringType()),
        T.StructField("maturity_date", T.DateType()),
        T.StructField("created_date", T.DateType()),
        T.StructField("payload", T.StringType()),
    ]
)

STORE = T.StructType(
    [
        *TRADE.fields,
        T.StructField("expired_flag", T.BooleanType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)

# What the rules need to know about a trade before a batch starts.
LEVELS = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("seen_version", T.IntegerType()),
        T.StructField("active_version", T.IntegerType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("manifest_path", T.StringType()),
        T.StructField("chunk_path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("chunk_count", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("correlation_id", T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("correlation_id", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("manifest_path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# Field names accepted for each canonical column, first match wins.
FIELD_NAMES = {
    "trade_id": ["trade_id", "tradeId", "Trade Id"],
    "version": ["version", "Version"],
    "counter_party_id": ["counter_party_id", "counterPartyId", "Counter-Party_Id"],
    "book_id": ["book_id", "bookId", "Book-Id"],
    "maturity_date": ["maturity_date", "maturityDate", "Maturity_Date"],
    "created_date": ["created_date", "createdDate", "Created_Date"],
    "payload": ["payload"],
}
