"""Quality rules by DataFrame functions alone: base counts and a hashed n-gram log-likelihood ratio.

Base rules count words, symbols, repeated lines and repeated three-word windows of each text, with array functions.

The ratio compares two multinomials over hashed one- and two-word terms (``BUCKETS`` classes, smoothed by one): the terms of
trusted rows (all labelled ones) and the terms of the whole corpus, counted over all documents.  A text's value is the mean of its terms'
log ratios, so long and short texts compare.  Every document meets the same threshold: the ``TRUST`` quantile of the values of
trusted rows that were not counted as the target (a half, by hash), taken from a histogram in steps of ``STEP``, so the verdict is deterministic.

The table of weights has ``BUCKETS`` numbers whatever the input; it is part of the plan as one array.

Defined results: null text has no words and fails the base rules; without trusted rows all weights and the threshold are 0,
so only the base rules decide; repeated rows get equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

BUCKETS = 4_096
#: Bits of the bitmap that picks out documents before the join with labels; its false positives cost time alone.
ID_BITS = 1 << 23
TRUST = 0.01
STEP = 0.001
LEAST_WORDS = 50
MOST_REPEATED = 50

_SPACE = r"[\x20\x09-\x0D]+"


def with_words(docs: DataFrame) -> DataFrame:
    """``docs`` with the arrays ``words`` and ``hashes`` (of the words)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.withColumn("words", F.array_remove(F.split(text, _SPACE), ""))
    return words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long) to rows of ``with_words``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.withColumn("n_words", F.size("words").cast("long")).withColumn("__lines", lines)
    # windows as (hash, place), sorted: a window found again stands beside its like
    starts = F.sequence(F.lit(0), F.col("n_words").cast("int") - 3)
    window = lambda i: F.struct(
        F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2)).alias("h"), i.alias("i")
    )
    windows = F.when(F.col("n_words") >= 4, F.sort_array(F.transform(starts, window)))
    counted = counted.withColumn("__windows", F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>")))
    like = lambda x, k: (F.get("__windows", k)["h"] == x["h"])
    again = F.filter("__windows", lambda x, k: F.coalesce(like(x, k + 1), F.lit(False)) | F.coalesce(like(x, k - 1), F.lit(False)))
    counted = counted.withColumn("__again", F.transform(again, lambda x: x["i"]))
    # places covered by windows that start at the repeated ones
    covered = F.size(F.array_distinct(F.flatten(F.transform("__again", lambda i: F.array(i, i + 1, i + 2)))))
    return counted.withColumns(
        {
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": covered.cast("long"),
        }
    ).drop("__lines", "__windows", "__again")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def terms(hashes: Column) -> Column:
    """Buckets (from 1) of all one- and two-word terms of an array of word hashes."""
    single = F.transform(hashes, lambda h: (F.pmod(h, F.lit(BUCKETS)) + 1).cast("int"))
    pair = lambda h, i: (F.pmod(F.xxhash64(F.get(hashes, i), h), F.lit(BUCKETS)) + 1).cast("int")
    return F.concat(single, F.transform(F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))), pair))


def term_weights(rows: DataFrame, trusted_rows: DataFrame) -> list[float]:
    """log(share in trusted rows / share in all rows) of every bucket, from rows with ``hashes``."""
    raw, trusted = [1] * BUCKETS, [1] * BUCKETS
    for held, counts in ((rows, raw), (trusted_rows, trusted)):
        found = held.select(F.explode(terms(F.col("hashes"))).alias("bucket")).groupBy("bucket")
        for r in found.agg(F.count("*").alias("n")).collect():  # at most BUCKETS rows
            counts[r["bucket"] - 1] += r["n"]
    if sum(trusted) == BUCKETS:
        return [0.0] * BUCKETS
    scale = math.log(sum(raw) / sum(trusted))
    return [round(math.log(t / n) + scale, 9) for t, n in zip(trusted, raw, strict=True)]


def with_value(docs: DataFrame, weights: list[float]) -> DataFrame:
    """Adds ``value``: the mean log ratio of the text's terms, null without terms."""
    table = F.array(*[F.lit(w) for w in weights])
    listed = terms(F.col("hashes"))
    total = F.aggregate(listed, F.lit(0.0), lambda s, b: s + F.element_at(table, b))
    return docs.withColumn("value", F.when(F.size("words") > 0, F.round(total / (2 * F.size("words") - 1), 6)))


def threshold(rows: DataFrame) -> float:
    """The TRUST quantile of ``value`` among ``rows``, as the lower edge of its histogram step; 0 without any."""
    steps = rows.groupBy(F.floor(F.col("value") / STEP).alias("step")).count()
    found = sorted((r["step"], r["count"]) for r in steps.collect())  # log ratios span a few thousand steps at most
    if not found:
        return 0.0
    need, seen = TRUST * sum(n for _, n in found), 0
    for step, n in found:
        seen += n
        if seen >= need:
            return step * STEP
    return found[-1][0] * STEP


def _fitted() -> Column:
    """The half of the rows that the target multinomial may count."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)) == 0, F.lit(False))


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows that may have a doc_id of ``ids``: by a bitmap of ID_BITS bits, broadcast as words, so the others' texts do not move."""
    place = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(ID_BITS))
    word, bit = F.shiftright(place, 6).cast("int"), place.bitwiseAND(F.lit(63)).cast("int")
    words = ids.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word")
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__mask"))
    found = rows.withColumns({"__at": word, "__of": F.call_function("shiftleft", F.lit(1).cast("long"), bit)})
    same = (F.col("__at") == F.col("__word")) & (F.col("__mask").bitwiseAND(F.col("__of")) != 0)
    return found.join(F.broadcast(words), same, "left_semi").drop("__at", "__of")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, value``.

    Trusted are all rows with ``labels.quality`` 1 that have enough words.  Texts are joined with labels for the target terms
    alone, and only those that a bitmap lets through; the threshold joins the written values.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    target = _among(rows.filter(_fitted()), good.filter(_fitted())).join(good, "doc_id", "left_semi")
    weights = term_weights(with_words(rows), with_words(target).filter(F.size("words") >= LEAST_WORDS))
    counted = base_counts(with_words(rows)).withColumn("base_failed", base_failed())
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "value"]
    valued = stage(with_value(counted, weights).select(*columns), "quality-values")
    held = valued.filter(~F.col("base_failed") & ~_fitted() & F.col("value").isNotNull()).select("doc_id", "value")
    least = threshold(held.join(good, "doc_id", "left_semi"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("value") >= F.lit(least), F.lit(False))
    return valued.withColumn("kept", kept).select(*columns[:7], "kept", "value")
