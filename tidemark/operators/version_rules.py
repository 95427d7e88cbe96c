"""Per-key version and maturity rules as window plans.

Why a running maximum is enough: a rejected record never exceeds the tide mark of its key, so the
maximum over *all* earlier records equals the maximum over the accepted ones, and sequential
state per key turns into one window.  With, for a record of version ``v``,

* ``seen``   = max version of earlier records of the stream, across batches,
* ``active`` = max active version in the store before the batch,
* ``top``    = the larger of both,

the outcome is ``v < seen`` rule 1; ``v = seen`` and matured rule 2; ``v < top`` or ``v = top`` and
matured the store's guardrail; anything else is accepted.

Records are ordered by the ``order`` columns, whose combination must be unique per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import DB_GUARDRAIL, RULE_1, RULE_2
from tidemark.operators.marks import earlier_max
from tidemark.operators.store import latest_active_version
from tidemark.schemas import KEY

LOWER = "lower"
MATURED = "matured"
EXPIRED_KEY = "expired_key"

PREFILTER_REASONS = {LOWER: RULE_1, MATURED: RULE_2}
# Reason texts of the strict variant and of the status function.
STRICT_REASONS = {LOWER: "lower_version", MATURED: "expired_same_version"}
STATUS_OK = "OK"
STATUS = {
    LOWER: "REJECTED: lower_version",
    MATURED: "REJECTED: same_version_maturity_before_today",
    EXPIRED_KEY: "REJECTED: db_guardrail_prevented_update",
}
MATURITY_REGRESSION = "MATURITY_BEFORE_STORED"


def _today(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of


def _mark(trades: DataFrame, order: Sequence[str], value: Column, out: str, start: DataFrame | None = None) -> DataFrame:
    """Add the per-trade ``start`` columns and the maximum of ``value`` over the earlier rows of the trade.

    Rows with a ``reject_code`` stay in the frame but outside the rules.
    """
    refused = F.col("reject_code").isNotNull() if "reject_code" in trades.columns else None
    return earlier_max(trades, "trade_id", order, value, out, start, refused)


def _with_code(reason: Column, trades: DataFrame) -> Column:
    return F.coalesce(F.col("reject_code"), reason) if "reject_code" in trades.columns else reason


def prefilter(
    trades: DataFrame,
    order: Sequence[str],
    as_of: Column | None = None,
    state: DataFrame | None = None,
    names: Mapping[str, str] = PREFILTER_REASONS,
) -> DataFrame:
    """Stream tier: add ``reason`` (null = accepted) and ``seen_version``.

    ``state`` (trade_id, seen_version) carries the mark of earlier batches.
    """
    start = None if state is None else state.select("trade_id", F.col("seen_version").alias("_start"))
    marked = _mark(trades, order, F.col("version"), "_run", start)
    seen = F.col("_run") if state is None else F.greatest("_run", "_start")
    v = F.col("version")
    matured = F.col("maturity_date") < _today(as_of)
    reason = F.when(v < F.col("seen_version"), F.lit(names[LOWER])).when(
        (v == F.col("seen_version")) & matured, F.lit(names[MATURED])
    )
    return (
        marked.withColumn("seen_version", seen)
        .withColumn("reason", _with_code(reason, trades))
        .drop("_run", "_start")
    )


def guardrail(
    trades: DataFrame,
    store: DataFrame,
    order: Sequence[str],
    as_of: Column | None = None,
) -> DataFrame:
    """Store tier alone: add ``reason`` and ``db_error`` for records that meet active rows of the store."""
    levels = latest_active_version(store).withColumn("seen_version", F.lit(None).cast("int"))
    judged = two_tier(trades, levels, order, as_of, tiers=("store",))
    return judged.drop("seen_version")


def two_tier(
    trades: DataFrame,
    levels: DataFrame | None,
    order: Sequence[str],
    as_of: Column | None = None,
    tiers: Sequence[str] = ("stream", "store"),
) -> DataFrame:
    """Both tiers in one pass: add ``reason``, ``seen_version``, ``active_version`` and ``db_error``.

    ``levels`` has one row per trade: (trade_id, seen_version, active_version).  With
    ``tiers=("active",)`` the stream rules look at active rows only, as the written specification
    says, instead of at every version ever seen.
    """
    start = None
    if levels is not None:
        start = levels.select(
            "trade_id",
            F.col("seen_version").alias("_seen"),
            F.col("active_version").alias("_active"),
        )
    marked = _mark(trades, order, F.col("version"), "_run", start)
    if start is None:
        marked = marked.withColumns({"_seen": F.lit(None).cast("int"), "_active": F.lit(None).cast("int")})
    marked = marked.withColumn("seen_version", F.greatest("_run", "_seen")).withColumn(
        "active_version", F.greatest("_run", "_active")
    )

    v, seen, top = F.col("version"), F.col("seen_version"), F.greatest("seen_version", "active_version")
    if "stream" not in tiers:
        top = F.col("active_version")
    matured = F.col("maturity_date") < _today(as_of)
    lower_in_store = v < top
    same_in_store = (v == top) & matured
    if "active" in tiers:
        reason = F.when(lower_in_store, F.lit(RULE_1)).when(same_in_store, F.lit(RULE_2))
    else:
        reason = F.when(lower_in_store | same_in_store, F.lit(DB_GUARDRAIL))
        if "stream" in tiers:
            reason = (
                F.when(v < seen, F.lit(RULE_1)).when((v == seen) & matured, F.lit(RULE_2)).otherwise(reason)
            )
    by_store = F.col("reason") == DB_GUARDRAIL
    return (
        marked.withColumn("reason", _with_code(reason, trades))
        .withColumn("db_error", F.when(by_store, guardrail_error(lower_in_store)))
        .drop("_run", "_seen", "_active")
    )


def guardrail_error(lower: Column) -> Column:
    """Error text of the store guardrail."""
    version = F.col("version").cast("string")
    # Message formats of the store.
    higher = F.concat(
        F.lit("REJECTED_BY_DB_GUARDRAIL: active higher version exists for trade_id="),
        F.col("trade_id"),
        F.lit(", incoming_version="),
        version,
    )
    matured = F.concat(
        F.lit("REJECTED_BY_DB_GUARDRAIL: inserting/updating active trade with maturity before today for trade_id="),
        F.col("trade_id"),
        F.lit(" version="),
        version,
    )
    return F.when(lower, higher).otherwise(matured)


def upsert_status(
    trades: DataFrame,
    store: DataFrame,
    order: Sequence[str],
    as_of: Column | None = None,
) -> DataFrame:
    """Status per record of an upsert that refuses to touch expired rows: add ``status``.

    A record that was refused before has its ``reject_code`` as the status.  A record whose (trade_id, version) is expired in the store never becomes active, so it does not
    raise the mark.
    """
    expired = store.filter("expired_flag").select(*KEY, F.lit(True).alias("_expired_key"))
    keyed = trades.join(expired, KEY, "left")
    blocked = F.coalesce(F.col("_expired_key"), F.lit(False))
    start = latest_active_version(store).withColumnRenamed("active_version", "_active")
    marked = _mark(keyed, order, F.when(~blocked, F.col("version")), "_run", start)
    v, top = F.col("version"), F.greatest("_run", "_active")
    matured = F.col("maturity_date") < _today(as_of)
    status = (
        F.when(v < top, F.lit(STATUS[LOWER]))
        .when((v == top) & matured, F.lit(STATUS[MATURED]))
        .when(blocked, F.lit(STATUS[EXPIRED_KEY]))
        .otherwise(F.lit(STATUS_OK))
    )
    return marked.withColumn("status", _with_code(status, trades)).drop("_run", "_active", "_expired_key")


def maturity_regression(
    trades: DataFrame,
    stored: DataFrame,
    order: Sequence[str],
) -> DataFrame:
    """Reject records that mature before the latest accepted maturity of their trade.

    ``stored`` has one row per trade with its ``maturity_date``.  Adds ``floor_maturity`` and ``reason``.
    """
    start = stored.select("trade_id", F.col("maturity_date").alias("_stored"))
    marked = _mark(trades, order, F.unix_date("maturity_date"), "_run", start)
    floor = F.greatest(F.date_from_unix_date("_run"), "_stored")
    return (
        marked.withColumn("floor_maturity", floor)
        .withColumn(
            "reason",
            _with_code(
                F.when(F.col("maturity_date") < F.col("floor_maturity"), F.lit(MATURITY_REGRESSION)), trades
            ),
        )
        .drop("_run", "_stored")
    )
