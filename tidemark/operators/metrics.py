"""Outcome counts of judged records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import DB_GUARDRAIL
from tidemark.schemas import KEY

ACCEPTED = "accept"
TOTAL = "ALL"


def outcome_metrics(
    judged: DataFrame, by: Sequence[str] = (), arrived: Column | None = None, now: Column | None = None
) -> DataFrame:
    """Per outcome and in total: records, replacements of the current version, failed upserts.

    Expects ``reason``, ``version`` and ``seen_version`` as the rules leave them.  With the ``arrived``
    timestamp of a record, ``lag_seconds`` is the longest time from arrival to ``now``.
    """
    lag = F.lit(None).cast("long")
    if arrived is not None:
        lag = F.unix_seconds(F.current_timestamp() if now is None else now) - F.unix_seconds(arrived)
    facts = judged.select(
        *by,
        F.coalesce("reason", F.lit(ACCEPTED)).alias("outcome"),
        (F.col("reason").isNull() & F.col("version").eqNullSafe(F.col("seen_version"))).cast("int").alias("replaced"),
        (F.coalesce("reason", F.lit("")) == DB_GUARDRAIL).cast("int").alias("failed"),
        lag.alias("lag"),
    )
    # reduced per outcome first, so the rollup expands a few rows only
    per_outcome = facts.groupBy(*by, "outcome").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("replaced").alias("replacements"),
        F.sum("failed").alias("failed_upserts"),
        F.max("lag").alias("lag_seconds"),
    )
    totals = per_outcome.rollup(*by, "outcome").agg(
        F.sum("records").alias("records"),
        F.sum("replacements").alias("replacements"),
        F.sum("failed_upserts").alias("failed_upserts"),
        F.max("lag_seconds").alias("lag_seconds"),
    )
    named = totals.withColumns({c: F.coalesce(F.col(c), F.lit(TOTAL)) for c in [*by, "outcome"]})
    return named if arrived is not None else named.drop("lag_seconds")


def duplicates(records: DataFrame, by: Sequence[str]) -> DataFrame:
    """``duplicates`` per group and in total: records whose (trade_id, version) came before in the group."""
    copies = records.groupBy(*by, *KEY).agg((F.count(F.lit(1)) - 1).alias("copies"))
    per_group = copies.groupBy(*by).agg(F.sum("copies").alias("duplicates"))
    totals = per_group.rollup(*by).agg(F.sum("duplicates").alias("duplicates"))
    return totals.withColumns({c: F.coalesce(F.col(c), F.lit(TOTAL)) for c in by})
