"""Trade store operations.  The store is a frame keyed by (trade_id, version); each operation returns a new one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import month_of
from tidemark.functions.keys import PARTITIONS, bucket_of
from tidemark.schemas import ATTRIBUTES, KEY, STORE_COLUMNS
from tidemark.session import written


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None, first: bool = False
) -> DataFrame:
    """One row per key, the last (or first) by ``order``.

    ``max_by`` aggregates before the shuffle, so a key with very many rows sends one row per task.
    """
    rest = [c for c in (columns or df.columns) if c not in keys]
    pick = F.min_by if first else F.max_by
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def as_store_rows(accepted: DataFrame, now: Column) -> DataFrame:
    """Accepted records as active store rows, one per primary key at most after ``latest_per_key``."""
    return accepted.withColumns({"expired_flag": F.lit(False), "ingest_ts": now}).select(*STORE_COLUMNS)


def upsert(
    store: DataFrame,
    accepted: DataFrame,
    order: Sequence[str],
    now: Column | None = None,
    on_expired: str = "reactivate",
) -> DataFrame:
    """Replace or insert accepted records by (trade_id, version).

    ``on_expired="reactivate"`` lets a record overwrite an expired row and makes it active again;
    ``"keep"`` leaves expired rows as they are.
    """
    if on_expired not in ("reactivate", "keep"):
        raise ValueError(f"on_expired must be 'reactivate' or 'keep', not {on_expired!r}")
    latest = latest_per_key(accepted, KEY, order, [*KEY, *ATTRIBUTES])
    incoming = as_store_rows(latest, F.current_timestamp() if now is None else now)
    return apply_rows(store, incoming, on_expired)


def apply_rows(store: DataFrame, rows: DataFrame, on_expired: str = "reactivate") -> DataFrame:
    """Overlay unique store rows on a store.

    The store is only an anti-joined side: Spark can broadcast the keys of a small batch, and then no store row moves.
    """
    kept = rows.select(*STORE_COLUMNS)
    if on_expired == "keep":
        expired = store.filter("expired_flag").select(*KEY)
        kept = kept.join(expired, KEY, "left_anti")
    return store.select(*STORE_COLUMNS).join(kept.select(*KEY), KEY, "left_anti").select(*STORE_COLUMNS).unionByName(kept)


def insert_if_absent(store: DataFrame, rows: DataFrame, order: Sequence[str], now: Column | None = None) -> DataFrame:
    """Insert records whose primary key is free; of several, the first by ``order`` is inserted."""
    fresh = latest_per_key(rows, KEY, order, [*KEY, *ATTRIBUTES], first=True).join(store.select(*KEY), KEY, "left_anti")
    added = as_store_rows(fresh, F.current_timestamp() if now is None else now)
    return store.select(*STORE_COLUMNS).unionByName(added)


def delete_trades(store: DataFrame, trade_ids: DataFrame) -> DataFrame:
    """Remove all versions of the listed trades."""
    return store.join(trade_ids.select("trade_id").distinct(), "trade_id", "left_anti")


def merge_last_wins(target: DataFrame, source: DataFrame) -> DataFrame:
    """Conditional merge of one-row-per-trade frames.

    A source row replaces its target row if neither version nor maturity goes backwards, is inserted
    if the trade is missing, and is ignored otherwise.  Source rows that lose are found first, by a join that keeps the
    source; the target is then only anti-joined by what wins.
    """
    held = target.select("trade_id", F.col("version").alias("_version"), F.col("maturity_date").alias("_maturity"))
    held = held.join(source.select("trade_id"), "trade_id", "left_semi")
    forward = (F.col("version") >= F.col("_version")) & (F.col("maturity_date") >= F.col("_maturity"))
    wins = source.join(held.withColumn("_there", F.lit(True)), "trade_id", "left")
    wins = wins.filter(F.col("_there").isNull() | forward).select(*target.columns)
    return target.join(wins.select("trade_id"), "trade_id", "left_anti").select(*target.columns).unionByName(wins)


def expire_matured(store: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Overnight expiry: flag rows whose maturity has passed."""
    today = F.current_date() if as_of is None else as_of
    gone = F.coalesce(F.col("maturity_date") < today, F.lit(False))
    return store.withColumn("expired_flag", F.col("expired_flag") | gone)


def latest_per_trade(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Compacted view: the highest version of each trade, the last by ``order`` among equals."""
    return latest_per_key(df, ["trade_id"], ["version", *order])


def latest_active_version(store: DataFrame) -> DataFrame:
    """(trade_id, active_version): highest active version of each trade that has one."""
    return store.filter(~F.col("expired_flag")).groupBy("trade_id").agg(F.max("version").alias("active_version"))


def active_counts(probe: DataFrame, store: DataFrame) -> DataFrame:
    """For each distinct (trade_id, version) probed: active rows with a higher and with the same version.

    The store is reduced to one row per primary key, so both counts come from one running count per trade
    over distinct versions.  Those are written first: the running count reads them twice, and a task would else hold the rows of
    both sides' joins twice.
    """
    held = store.filter(~F.col("expired_flag")).select(*KEY, F.lit(1).alias("_held"), F.lit(0).alias("_asked"))
    asked = probe.select(*KEY, F.lit(0).alias("_held"), F.lit(1).alias("_asked"))
    merged = held.unionByName(asked).groupBy(*KEY).agg(F.sum("_held").alias("_held"), F.max("_asked").alias("_asked"))
    return count_higher(written(merged, "active-counts")).filter("_asked = 1").select(
        *KEY, F.col("_higher").alias("higher_active"), F.col("_held").alias("same_active")
    )


def count_higher(merged: DataFrame, block_bits: int = 12) -> DataFrame:
    """Add ``_higher``: the sum of ``_held`` over the higher versions of the trade.

    Versions are grouped in blocks of ``2**block_bits`` consecutive numbers, so a window group never holds
    more rows than a block has numbers, and the second level never more than there are blocks.
    """
    blocked = merged.withColumn("_block", F.shiftright("version", block_bits))
    inside = (
        Window.partitionBy("trade_id", "_block").orderBy(F.desc("version")).rowsBetween(Window.unboundedPreceding, -1)
    )
    above = Window.partitionBy("trade_id").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy("trade_id", "_block")
        .agg(F.sum("_held").alias("_block_held"))
        .withColumn("_above", F.coalesce(F.sum("_block_held").over(above), F.lit(0)))
        .select("trade_id", "_block", "_above")
    )
    return (
        blocked.withColumn("_inside", F.coalesce(F.sum("_held").over(inside), F.lit(0)))
        .join(blocks, ["trade_id", "_block"])
        .withColumn("_higher", F.col("_inside") + F.col("_above"))
        .drop("_block", "_inside", "_above")
    )


def active_rows(store: DataFrame, trade_ids: Sequence[str] | None = None) -> DataFrame:
    """Active rows, optionally of given trades."""
    rows = store.filter(~F.col("expired_flag"))
    return rows if trade_ids is None else rows.filter(F.col("trade_id").isin(list(trade_ids)))


def active_by_maturity(store: DataFrame, first: Column, last: Column) -> DataFrame:
    """Active rows maturing in [first, last]; a month-partitioned store is pruned by the added month range."""
    rows = active_rows(store).filter(F.col("maturity_date").between(first, last))
    if "maturity_month" in store.columns:
        rows = rows.filter(F.col("maturity_month").between(month_of(first), month_of(last)))
    return rows


def lookup(store: DataFrame, trade_id: str, version: int, buckets: int = PARTITIONS) -> DataFrame:
    """Point lookup by primary key; a hash-partitioned store is pruned to one bucket."""
    rows = store.filter((F.col("trade_id") == trade_id) & (F.col("version") == version))
    if "bucket" in store.columns:
        rows = rows.filter(F.col("bucket") == bucket_of(F.lit(trade_id), buckets))
    return rows


def lookup_all(store: DataFrame, wanted: DataFrame, buckets: int = PARTITIONS) -> DataFrame:
    """Store rows for a frame of (trade_id, version) keys.

    Of a hash-partitioned store only the buckets of the keys are read, if Spark takes the keys for small enough to broadcast.
    """
    keys = wanted.select(*KEY).distinct()
    if "bucket" not in store.columns:
        return store.join(keys, KEY, "left_semi")
    # as a comparison, since Spark prunes folders only by conditions that it takes for selective
    placed = keys.withColumn("bucket", bucket_of(F.col("trade_id"), buckets)).filter("bucket >= 0")
    return store.join(placed, [*KEY, "bucket"], "left_semi")


def lookup_ids(store: DataFrame, trade_ids: Sequence[str], buckets: int = PARTITIONS) -> DataFrame:
    """All versions of some trades: their buckets only and, in files of ``write_hash_layout``, their row groups only.

    For a handful of ids: ``IN`` reaches the files' Bloom filters up to ``spark.sql.parquet.pushdown.inFilterThreshold``
    ids (10 unless set), above that as a range of ids.  Frames of keys go to ``lookup_all``.
    """
    ids = sorted(set(trade_ids))
    rows = store.filter(F.col("trade_id").isin(ids))
    if "bucket" not in store.columns:
        return rows
    places = store.sparkSession.range(0, 1, 1, 1).select(F.array_distinct(F.array(*[bucket_of(F.lit(i), buckets) for i in ids])))
    return rows.filter(F.col("bucket").isin(places.first()[0])) if ids else rows


def hash_layout(store: DataFrame, buckets: int = PARTITIONS) -> DataFrame:
    return store.withColumn("bucket", bucket_of(F.col("trade_id"), buckets))


def month_layout(store: DataFrame) -> DataFrame:
    return store.withColumn("maturity_month", month_of(F.col("maturity_date")))


def write_hash_layout(store: DataFrame, path: str, buckets: int = PARTITIONS) -> None:
    """Write by hash bucket.  The rebalance hint lets Spark split large and join small buckets.

    Files are sorted by key and hold Bloom filters of ``trade_id``, so that lookups skip the row groups of other trades.
    """
    laid = hash_layout(store, buckets).hint("rebalance", "bucket").sortWithinPartitions("bucket", *KEY)
    writer = laid.write.mode("overwrite").option("parquet.bloom.filter.enabled#trade_id", "true")
    writer.option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy("bucket").parquet(path)


def write_month_layout(store: DataFrame, path: str) -> None:
    """Write by maturity month, once; ``plans.months.MonthTable`` is the form that takes upserts."""
    laid = month_layout(store).hint("rebalance", "maturity_month")
    laid.write.mode("overwrite").partitionBy("maturity_month").parquet(path)
