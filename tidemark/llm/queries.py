"""Registered queries of the subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, burst, chat, exact, langid, mixing, ngram_join, quality, routing, spelling, suffixes, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(*langid.sample(docs, remainder(3) != 1))
    found = langid.predict_languages(docs.select("doc_id", "text"), model).withColumn("doc_id", F.col("row.doc_id"))
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score", "accepted")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("value")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(*toxicity.sample(docs, labels, remainder(4) != 2))
    scored = toxicity.score_texts(docs.select("doc_id", "text"), model).withColumn("doc_id", F.col("row.doc_id"))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", predicted)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return burst.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_bpe": op5_bpe,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc": op7_warc,
    "op8_chat": op8_chat,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE = {
    "op4_exact_dedup": r"""
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM (
            SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
            FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        )
    """,
    "op8_chat": """
        WITH lists AS (
            SELECT conv_id, count(*) AS n,
                   list(concat('<|im_start|>', replace(coalesce(role, ''), '<|', '< |'), chr(10), replace(coalesce(text, ''), '<|', '< |'),
                               '<|im_end|>', chr(10)) ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS lines,
                   list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations GROUP BY conv_id
        ), prefixes AS (
            SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n)) AS k FROM lists)
        )
        SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_copies, array_to_string(any_value(lines), '') AS chat
        FROM lists WHERE turns NOT IN (SELECT turns FROM prefixes) GROUP BY turns, n
    """,
}
