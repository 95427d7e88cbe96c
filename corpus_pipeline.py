"""A corpus pipeline of five stages over ``documents``; part of the subpackage ``tidemark.llm``.

Every stage takes the documents that its predecessor kept, decides on all of them, and hands on what stays, as Parquet in the
cluster's shared folder.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact, mixing, ngram_join, toxicity
from tidemark.llm.common import stage
from tidemark.llm.queries import remainder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; labels train the score and decide nothing themselves."""
    model = toxicity.train(*toxicity.sample(docs, table(spark, sf_dir, "labels"), remainder(4) != 2))
    return toxicity.score_texts(docs, model).filter(f"score < {toxicity.THRESHOLD}").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts, the document with the smallest doc_id."""
    return exact.keep_rows(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by word n-grams, the one with the smallest doc_id."""
    return ngram_join.keep_rows(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded bytes of every document of the mix."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: A trained score, near copies, Newton iterations and byte-pair merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
