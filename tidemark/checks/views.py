"""Trades, a store and raw lines derived from the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.store import latest_per_key
from tidemark.schemas import KEY, STORE_COLUMNS, TRADE_COLUMNS
from tidemark.session import whole_rows, written

AS_OF = datetime.date(1998, 9, 1)
LINES_AS_OF = datetime.date(2024, 1, 15)
STORE_EXPIRY = datetime.date(1996, 6, 1)
STORE_TIME = datetime.datetime(1998, 9, 1)
ORDER = ["arrival"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem joined to orders as trades; repeated (order, line) pairs give repeated versions.

    They are joined by trade_id, so the rows lie by it already where a rule, a count or an upsert by trade follows: they move once.
    """
    text = lambda name: F.col(name).cast("string")
    trade_id = lambda name: F.concat(F.lit("T"), text(name)).alias("trade_id")
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus", "l_shipdate", trade_id("l_orderkey")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderdate", trade_id("o_orderkey"))
    return line.join(orders, "trade_id").select(
        "trade_id",
        F.col("l_linenumber").alias("version"),
        F.concat(F.lit("CP-"), text("l_suppkey")).alias("counter_party_id"),
        F.concat(F.lit("B"), (F.col("l_partkey") % 50).cast("string")).alias("book_id"),
        F.to_date("l_shipdate").alias("maturity_date"),
        F.to_date("o_orderdate").alias("created_date"),
        F.concat(
            F.lit('{"notional":"'),
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
            F.lit('","status":"'),
            F.col("l_linestatus"),
            F.lit('"}'),
        ).alias("payload"),
        F.col("l_linestatus").alias("st"),
        F.md5(
            F.concat_ws(
                "|",
                text("l_orderkey"),
                text("l_linenumber"),
                text("l_partkey"),
                text("l_suppkey"),
                text("l_extendedprice"),
            )
        ).alias("arrival"),
    )


def all_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades(spark, sf_dir).select(*TRADE_COLUMNS, *ORDER)


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades that meet a store of the other ones, where a query needs both."""
    return trades(spark, sf_dir).filter("st = 'O'").select(*TRADE_COLUMNS, *ORDER)


def filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades(spark, sf_dir).filter("st = 'F'").select(*TRADE_COLUMNS, *ORDER)


def store_of(rows: DataFrame) -> DataFrame:
    held = latest_per_key(rows, KEY, ORDER, TRADE_COLUMNS)
    return held.withColumns(
        {"expired_flag": F.col("maturity_date") < F.lit(STORE_EXPIRY), "ingest_ts": F.lit(STORE_TIME)}
    ).select(*STORE_COLUMNS)


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    # most queries need the store twice, for its levels and for its rows
    return store_of(whole_rows(filed(spark, sf_dir)))


def trade_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keys, expiry and sides of trades are found from, written once: both sides of a query then come from one join."""
    return written(trades(spark, sf_dir).select(*KEY, "maturity_date", "st", *ORDER), "trade-keys")


def store_keys(rows: DataFrame) -> DataFrame:
    """Keys of the store and whether they have expired, from rows that carry nothing else."""
    held = latest_per_key(rows.filter("st = 'F'"), KEY, ORDER, [*KEY, "maturity_date"])
    return held.select(*KEY, (F.col("maturity_date") < F.lit(STORE_EXPIRY)).alias("expired_flag"))


def whole_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_of(all_trades(spark, sf_dir))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines: three date styles, missing maturities and truncated lines."""
    day = F.to_date("ts").cast("string")
    kind = F.col("event_type")
    maturity = (
        F.when(kind == "signup", F.lit(""))
        .when(kind == "view", F.concat(F.lit(',"maturity_date":"'), day, F.lit('T00:00:00"')))
        .when(
            kind == "purchase",
            F.concat(
                F.lit(',"maturity_date":"'),
                F.substring(day, 9, 2),
                F.lit("/"),
                F.substring(day, 6, 2),
                F.lit("/"),
                F.substring(day, 1, 4),
                F.lit('"'),
            ),
        )
        .otherwise(F.concat(F.lit(',"maturity_date":"'), day, F.lit('"')))
    )
    version = F.regexp_extract("props", "[0-9]+", 0).cast("int") % 5
    line = F.concat(
        F.lit('{"trade_id":"U'),
        F.col("user_id").cast("string"),
        F.lit('","version":'),
        version.cast("string"),
        maturity,
        F.lit(',"created_date":"'),
        day,
        F.lit('","payload":'),
        F.col("props"),
        F.lit("}"),
    )
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return events.select(
        "event_id", "ts", "event_type", F.when(kind == "error", F.substring(line, 1, 25)).otherwise(line).alias("line")
    )
