"""Mixing sources to target weights by entropy balancing.

Every document has a rate between 0 and ``MOST`` copies.  Of all rates that take each source's target of words, the ones of
largest entropy relative to one copy each are exponential tilts of the base odds by the document's size:
``rate = MOST * s(a + tilt * size / mean size)`` with the logistic function s and ``s(a) = 1 / MOST``.  The tilts, one per
source, solve the convex dual; Newton iterations find them.  As a rate depends on the source and the size alone, gradient and
Hessian are sums over a table of (source, size, documents), aggregated anew by Spark in every iteration.

Rates are rounded into whole copies from the largest size of a source to the smallest: the copies of a size are the nearest
number to what its documents and the words still owed ask for, and the remainder is owed to the next smaller size.  So a
source's total misses its target by about a small document.  This fold reads one row per size of a source, as many as its
longest document has words at most, in integers (millionths of a word).  Within a size the documents are ranked by hash in
salted groups, so no group of equal sources and sizes has to be sorted by one task.

Defined results: null text has size 0 and is never taken; a null source is a source of its own, the last one; rows are told
apart by occurrence if doc_id, source and size repeat; an empty table gives no rows; reruns agree.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

MOST = 3
#: Weights dealt to the sources in their order, again and again.
WEIGHTS = (1, 2, 3)
SALTS = 64
MILLION = 1_000_000
_BASE = math.log(1 / (MOST - 1))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``: words ``[^\\x20\\x09-\\x0D]+`` of the whole text."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size"))


def targets(cells: DataFrame) -> DataFrame:
    """``source, source_size, target``: shares of all words by weight; none above MOST times its source, the excess shared anew.

    That is one level for all sources: ``target = min(weight * level, MOST * source_size)`` with the level at which the
    targets add up.  Sources are sorted by the level at which they reach their cap; one row per source, so one task is enough.
    """
    per = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.lit(MOST) * F.col("source_size"))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumns(
        {
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    ).withColumn("level", F.col("left") / F.col("weights"))
    per = per.withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    # the last source is always free, as all caps together are MOST times all words
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"]
    target = F.when(F.col("weight") * level < F.col("cap"), F.col("weight") * level).otherwise(F.col("cap").cast("double"))
    return per.select("source", "source_size", target.cast("double").alias("target"))


def _share(tilt, size, mean) -> F.Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(_BASE) + tilt * size / mean)))


def tilts(cells: DataFrame, wanted: DataFrame, most_steps: int = 60) -> DataFrame:
    """``source, source_size, target, mean, tilt`` with each source's expected words at its target.

    A source at its cap has no finite tilt: all its documents get ``MOST`` copies and ``tilt`` is null.  Newton's step is
    bisected when it leaves the interval known to hold the solution.
    """
    mean = cells.filter("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("mean"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    state = wanted.join(mean, same(wanted, mean), "left").select(
        wanted["*"],
        "mean",
        F.when((F.col("mean").isNotNull()) & (F.col("target") < MOST * F.col("source_size") * (1 - 1e-9)), 0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(False).alias("done"),
    )
    state = stage(state, "mix-state")
    for _ in range(most_steps):
        if not state.filter("tilt IS NOT NULL AND NOT done").limit(1).count():
            break
        share = _share(F.col("tilt"), F.col("size"), F.col("mean"))
        words = F.col("size") * F.col("docs") * F.lit(float(MOST))
        sums = (
            cells.join(state.withColumnRenamed("source", "of"), cells["source"].eqNullSafe(F.col("of")))
            .filter("tilt IS NOT NULL")
            .groupBy("source")
            .agg(F.sum(words * share).alias("f"), F.sum(words * F.col("size") / F.col("mean") * share * (1 - share)).alias("d"))
        )
        joined = state.join(sums.withColumnRenamed("source", "of"), state["source"].eqNullSafe(F.col("of")), "left").drop("of")
        over = F.col("f") > F.col("target")
        joined = joined.withColumns(
            {
                "low": F.when(over, F.col("low")).otherwise(F.col("tilt")),
                "high": F.when(over, F.col("tilt")).otherwise(F.col("high")),
                "step": F.try_divide(F.col("target") - F.col("f"), F.col("d")),
                "done": F.col("done") | (F.abs(F.col("f") - F.col("target")) <= F.lit(1e-9) * F.greatest("target", F.lit(1.0))),
            }
        )
        span = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
        wide = F.col("tilt") + F.when(over, -1.0).otherwise(1.0) * (1 + F.abs("tilt"))
        newton = F.col("tilt") + F.col("step")
        inside = (newton > F.coalesce("low", newton - 1)) & (newton < F.coalesce("high", newton + 1)) & (F.abs("step") <= 4 * (1 + F.abs("tilt")))
        tilt = F.when(F.col("done"), F.col("tilt")).when(inside, newton).otherwise(F.coalesce(span, wide))
        state = stage(joined.withColumn("tilt", tilt).select(*state.columns), "mix-state")
    return state.select("source", "source_size", "target", "mean", F.round("tilt", 9).alias("tilt"))


def round_rates(cells: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of the sizes of one source: ``whole`` of every document and one more of ``further`` documents."""
    cells = cells.sort_values("size", ascending=False, ignore_index=True)
    owed, whole, further = 0, [], []
    for size, docs, rate in zip(cells["size"].tolist(), cells["docs"].tolist(), cells["rate"].tolist(), strict=True):
        wanted = size * docs * rate + owed
        n = min(max((2 * wanted + size * MILLION) // (2 * size * MILLION), 0), MOST * docs) if size else 0
        owed = wanted - n * size * MILLION
        whole.append(n // docs)
        further.append(n % docs)
    return cells.assign(whole=whole, further=further)[["source", "size", "source_size", "target", "whole", "further"]]


def copies(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, source, size, occurrence, source_size, target, copies``."""
    rows = stage(sizes(docs), "mix-sizes")
    cells = stage(rows.groupBy("source", "size").agg(F.count("*").alias("docs")), "mix-cells")
    found = tilts(cells, targets(cells))
    joined = cells.join(found.withColumnRenamed("source", "of"), cells["source"].eqNullSafe(F.col("of"))).drop("of")
    rate = F.when(F.col("tilt").isNull(), F.lit(MOST * MILLION)).otherwise(
        F.round(_share(F.col("tilt"), F.col("size"), F.col("mean")) * MOST * MILLION).cast("long")
    )
    joined = joined.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0).cast("long"))
    plan = joined.select("source", "size", "docs", "rate", "source_size", "target").groupBy("source").applyInPandas(
        round_rates, "source string, size long, source_size long, target double, whole long, further long"
    )
    salted = rows.withColumns({"hash": F.xxhash64("doc_id"), "salt": F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")})
    groups = salted.groupBy("source", "size", "salt").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("source", "size", "salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    other = groups.join(plan.withColumnsRenamed({"source": "of", "size": "of_size"}), F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size")))
    other = other.select(
        F.col("source").alias("of"), F.col("size").alias("of_size"), F.col("salt").alias("of_salt"), "ahead", "source_size", "target", "whole", "further"
    )
    inside = Window.partitionBy("source", "size", "salt").orderBy("hash", "doc_id")
    twin = Window.partitionBy("source", "size", "salt", "hash", "doc_id").orderBy("doc_id")
    ranked = salted.withColumns({"rank": F.row_number().over(inside), "occurrence": F.row_number().over(twin)})
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size")) & (F.col("salt") == F.col("of_salt"))
    taken = F.col("whole") + F.when(F.col("ahead") + F.col("rank") <= F.col("further"), 1).otherwise(0)
    return ranked.join(other, same).select("doc_id", "source", "size", "occurrence", "source_size", "target", taken.cast("long").alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies``; ``taken`` is the words that the mix takes of a document."""
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as the mix has them: each as often as it is taken."""
    plan = copies(docs).filter("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("occurrence").alias("__n"), "copies"
    )
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    twin = Window.partitionBy("doc_id", "source", "__words").orderBy("doc_id")
    rows = docs.withColumn("__words", size).withColumn("__row", F.row_number().over(twin))
    same = (
        rows["doc_id"].eqNullSafe(plan["__id"]) & rows["source"].eqNullSafe(plan["__source"]) & (rows["__words"] == plan["__size"]) & (rows["__row"] == plan["__n"])
    )
    return rows.join(plan.withColumnRenamed("copies", "__copies"), same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
