"""The highest value among the earlier rows of a key, without putting a key's rows into one task.

A running maximum needs to know, for a row at place ``o``, the largest value that the key has had before ``o``.  It is enough
to know *where each value came first*: the answer is the largest value whose first place is before ``o``.  First places are
a grouped minimum, reduced before the shuffle, so a key with very many rows sends one row per distinct value and task.
A value that came after a larger one is never an answer and is dropped, so what is left of a key is a staircase: larger values at
later places.

Rows meet the staircase of their key in one join, one row per key, so Spark's adaptive skew join can split a frequent key, and
rows move once.  Staircases are kept in blocks of ``2 ** BLOCK_BITS`` neighbouring values.  Keys with more than ``LISTED``
steps list their blocks alone, and only their rows look into a block by a second join, for which no row moves again; where no
key is that large, that join's right side is empty and Spark drops it at run time.

The plan is the same at every size and no job runs while it is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 12
#: Steps of a key that travel with its rows.
LISTED = 1_024


def staircases(rows: DataFrame, key: str, order: Sequence[str], value: Column, listed: int = LISTED) -> DataFrame:
    """``_key, _block, _low, _steps, _small``: the blocks of each key's staircase, and whether the key has few steps."""
    # rows without key or value are told inside the minimum: a filter would be pushed below a join of ``rows``, whose exchange
    # would then differ from the one of the rows themselves
    told = F.when(F.col("_key").isNotNull() & F.col("_value").isNotNull(), F.col("_here"))
    first = (
        rows.select(F.col(key).alias("_key"), value.cast("int").alias("_value"), F.struct(*order).alias("_here"))
        .groupBy("_key", "_value")
        .agg(F.min(told).alias("_first"))
        .filter("_first IS NOT NULL")
        .withColumn("_block", F.shiftright("_value", BLOCK_BITS))
    )
    larger = Window.partitionBy("_key", "_block").orderBy(F.desc("_value")).rowsBetween(Window.unboundedPreceding, -1)
    steps = first.withColumn("_before", F.min("_first").over(larger)).filter("_before IS NULL OR _first < _before")
    blocks = steps.groupBy("_key", "_block").agg(F.min("_first").alias("_low"), F.collect_list(F.struct("_first", "_value")).alias("_steps"))
    higher = Window.partitionBy("_key").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.min("_low").over(higher)).filter("_before IS NULL OR _low < _before")
    return blocks.withColumn("_small", F.sum(F.size("_steps")).over(Window.partitionBy("_key")) <= listed).drop("_before")


def earlier_max(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    value: Column,
    out: str,
    start: DataFrame | None = None,
    refused: Column | None = None,
    listed: int = LISTED,
) -> DataFrame:
    """Add ``out``, the maximum of the integer ``value`` over the earlier rows of the key, null if there is none.

    The key is text; ``order`` columns give a total order per key.  ``start`` has one row per key whose other columns are added too.  ``refused``
    rows raise nothing and get nulls; they take part in the joins under keys of their own, so they spread evenly
    even if they have no key.  Rows with a null value raise nothing.
    """
    here = F.struct(*order)
    # no staircase has a null key, but the join below would tell so to one of the two uses alone, and staircases be made twice
    blocks = staircases(rows if refused is None else rows.filter(~refused), key, order, value, listed).filter("_key IS NOT NULL")
    # the block first, so that the largest entry is the highest block
    entry = F.struct("_block", "_low", F.when(F.col("_small"), F.col("_steps")).alias("_steps"))
    tops = blocks.groupBy("_key").agg(F.collect_list(entry).alias("_blocks"))
    if start is not None:
        tops = tops.join(start.withColumnRenamed(key, "_key"), "_key", "full_outer")

    # rows that look up nothing take part under keys of their own
    apart = F.concat(F.lit("\x00"), F.xxhash64(*order).cast("string"))
    own = F.col(key) if refused is None else F.when(refused, apart).otherwise(F.col(key))
    held = rows.withColumn("_own", own).join(tops, F.col("_own") == F.col("_key"), "left").drop("_key")
    held = held.withColumn("_top", F.array_max(F.filter("_blocks", lambda b: b["_low"] < here))).drop("_blocks")
    # by the key alone, by which the rows lie and are sorted already: an equality of blocks would be a second key and move every
    # row, also where no key is large, as both sides of a join are shuffled before Spark sees that one is empty
    # under another name for the key, so that these few rows are shuffled though they lie by it: Spark sees only of a shuffled side that
    # it is empty
    large = blocks.filter("NOT _small").select(F.coalesce("_key", F.lit("")).alias("_key"), "_block", F.col("_steps").alias("_looked_up"))
    same_block = F.col("_top._block") - F.col("_block") == 0
    held = held.join(large, (F.col("_own") == F.col("_key")) & same_block, "left")
    known = F.filter(F.coalesce("_top._steps", "_looked_up"), lambda v: v["_first"] < here)
    return held.withColumn(out, F.array_max(F.transform(known, lambda v: v["_value"]))).drop(
        "_own", "_key", "_top", "_block", "_looked_up"
    )
