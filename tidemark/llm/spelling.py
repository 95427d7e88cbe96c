"""Grouping of spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart, the shorter one (of equal lengths: the first in code-point order) is cut into two disjoint chunks
of ``q = length // 2`` code points, its head and its tail; the longer one gives positional grams of the same size.  One edit
leaves the head or the tail whole, and the whole one stands in the other word with a shift of at most one: a head at its own
place, a tail shifted by the difference of the lengths.  Grams at other places cannot meet a chunk, so only those are written.

What is left beside the whole chunk is one edit apart as well, so the same rule cuts it again, and a key is a chunk with one
of the two chunks of the rest: three quarters of a word.  However frequent a chunk is, words that share it alone never meet.
Two words can agree in several of the four keys; the pair counts at the first of them, so no pair has to be made distinct.
Pairs are verified in the join by their edit distance.

A word's form is its near word of largest count (ties: first in code-point order), if that is ``RATIO`` times the word's own; its
root is the last of the chain of forms.  Counts grow by that ratio along a chain, so chains are short, and pointer doubling
ends after a few joins.  Everything is DataFrame functions; words are counted before they are shuffled.

Defined results: null and empty texts have no words; a null doc_id is written as nothing before the colon of the hashed text;
repeated rows count each; an empty table gives no rows; other columns of the table are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

# Letters of a word, the least length and count of a word, the share of hashed words that lose a letter.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
ONE_IN = 31
#: How many times as frequent as a word its form is.
RATIO = 10

_UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))


def with_lost_letters(word: Column, doc_id: Column) -> Column:
    """The word, of which a hash of document and word decides whether and where it loses a letter."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % ONE_IN == 0, shorter).otherwise(word)


def count_words(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: words of whole texts, lower-cased in A-Z, some with a lost letter, and how often they occur."""
    # a lost letter only shortens, so shorter runs cannot become words
    runs = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    found = documents.select("doc_id", F.explode(runs).alias("run"))
    found = found.select("doc_id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    words = found.select(with_lost_letters(F.col("run"), F.col("doc_id")).alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _keys(word: str, size: str, length: str) -> list[Column]:
    """The four keys of a word of ``size`` code points, as one of ``length`` cut into chunks would give them."""
    w, m, n = F.col(word), F.col(size), F.col(length)
    q = F.floor(n / 2).cast("int")
    r = F.floor((n - q) / 2).cast("int")
    part = lambda start, count: F.substring(w, start, count)
    head, tail = part(F.lit(1), q), part(m - q + 1, q)
    return [
        F.concat(head, part(q + 1, r)),
        F.concat(head, part(m - r + 1, r)),
        F.concat(tail, part(F.lit(1), r)),
        F.concat(tail, part(m - q - r + 1, r)),
    ]


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: all pairs of words (columns word, n; distinct words) at an edit distance of one, each once."""
    sized = words.select("word", "n", F.length("word").alias("size"))

    def keyed(rows: DataFrame) -> DataFrame:
        hashed = [F.xxhash64(F.lit(slot), "length", key) for slot, key in enumerate(_keys("word", "size", "length"))]
        return rows.select("word", "n", "size", "length", F.posexplode(F.array(*hashed)).alias("slot", "key"))

    chunks = keyed(sized.withColumn("length", F.col("size"))).toDF("a", "a_n", "a_size", "length", "slot", "key")
    # the longer word looks for words of its own length and of one less
    grams = keyed(sized.withColumn("length", F.explode(F.array(F.col("size") - 1, F.col("size"))))).toDF("b", "b_n", "b_size", "length", "slot", "key")
    same = [x == y for x, y in zip(_keys("a", "a_size", "a_size"), _keys("b", "b_size", "a_size"), strict=True)]
    first = F.when(same[0], 0).when(same[1], 1).when(same[2], 2).when(same[3], 3)
    ordered = (F.col("a_size") < F.col("b_size")) | (F.col("a") < F.col("b"))
    found = chunks.join(grams, ["key", "slot", "length"]).filter(ordered & (F.levenshtein("a", "b", 1) == 1) & (first == F.col("slot")))
    return found.select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of all words of ``forms`` (word, form): the last word of each chain, by pointer doubling."""
    found = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        found = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return found


def group_words(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words`` (columns word, n)."""
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = stage(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")).alias("near"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("form")).alias("near")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("near"))
    judged = words.join(best, "word", "left")
    strong = -F.col("near.less") >= ratio * F.col("n")
    judged = judged.select(
        "word",
        F.when(strong, F.col("near.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, -F.col("near.less")).alias("form_n"),
    )
    judged = stage(judged, "spelling-forms")
    ends = roots(judged.filter("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(documents: DataFrame) -> DataFrame:
    return group_words(count_words(documents))
