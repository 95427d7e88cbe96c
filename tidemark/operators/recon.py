"""Convergence, reconciliation and deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def converge(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Union of the same records from several sources, labelled with ``source_system``."""
    merged = None
    for name, df in sources.items():
        labelled = df.withColumn("source_system", F.lit(name))
        merged = labelled if merged is None else merged.unionByName(labelled)
    return merged


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Mismatches of two snapshots: keys, ``status`` and the comma-separated differing columns.

    ``status`` is ``missing_left``, ``missing_right`` or ``differs``; matching rows are left out.
    Both sides must be unique by ``keys``.
    """
    a = left.select(*keys, F.struct(*compare).alias("_left"))
    b = right.select(*keys, F.struct(*compare).alias("_right"))
    differing = F.array_join(
        F.filter(
            F.array(
                *[
                    F.when(~F.col(f"_left.`{c}`").eqNullSafe(F.col(f"_right.`{c}`")), F.lit(c))
                    for c in compare
                ]
            ),
            lambda name: name.isNotNull(),
        ),
        ",",
    )
    status = (
        F.when(F.col("_left").isNull(), F.lit("missing_left"))
        .when(F.col("_right").isNull(), F.lit("missing_right"))
        .when(~F.col("_left").eqNullSafe(F.col("_right")), F.lit("differs"))
    )
    return (
        a.join(b, list(keys), "full_outer")
        .withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select(*keys, "status", F.when(F.col("status") == "differs", differing).alias("differing"))
    )


def reconcile_summary(mismatches: DataFrame) -> DataFrame:
    return mismatches.groupBy("status", "differing").agg(F.count(F.lit(1)).alias("rows"))


def dedup_ttl(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], ttl_seconds: int) -> DataFrame:
    """Keep a record if no earlier record of its key lies within the TTL before it.

    Inside (key, span of one TTL) only the first record can be kept, so a grouped minimum stands for the span and a burst of one
    key is reduced before the shuffle.  It is kept if the last record of the spans before lies more than the TTL back.  ``tie``
    columns make the order total; of records equal in all of them one is kept.  Records without a time are all kept.
    """
    micros, span = f"unix_micros(cast(`{ts}` AS timestamp))", ttl_seconds * 1_000_000
    timed = df.filter(F.col(ts).isNotNull()).withColumn("_span", F.expr(f"({micros} - pmod({micros}, {span})) div {span}"))
    rest = [c for c in df.columns if c not in keys]
    firsts = timed.groupBy(*keys, "_span").agg(F.min_by(F.struct(*rest), F.struct(ts, *tie)).alias("_row"), F.max(ts).alias("_last"))
    previous = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_span"))
    marked = firsts.select(*keys, "_row.*", previous.alias("_previous"))
    fresh = F.col("_previous").isNull() | (F.col(ts) > F.col("_previous") + F.make_dt_interval(secs=F.lit(ttl_seconds)))
    return marked.filter(fresh).select(*df.columns).unionByName(df.filter(F.col(ts).isNull()))


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, ttl: str) -> DataFrame:
    """Streaming form: drop repeats of a key seen within the watermark delay ``ttl`` (such as ``6 hours``).

    Spark keeps the first record of a key and forgets it once the watermark passes; unlike
    ``dedup_ttl`` a repeat does not extend the time.
    """
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(list(keys))
