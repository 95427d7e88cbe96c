"""Chat formatting with cumulative-snapshot collapse, by DataFrame functions alone.

Logs often hold a conversation several times, once per turn: each snapshot is a prefix of the next.  A running hash over a
conversation's turns (an exclusive-or of two 64-bit hashes of place, role and text, with different seeds) identifies every
prefix.  A conversation whose full hash is the hash of a proper prefix of a longer one is dropped by an anti-join; of
identical conversations the one with the smallest conv_id stays.  What remains is rendered with a chat template.

Defined results: a null role or text counts as empty; turns of equal number are ordered by role and text, and null turn numbers
come first; a null conv_id is a conversation of its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    """Text in which no marker of the template can be read: ``<|`` gets a space."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def turns_with_prefix(turns: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, p, q, size``: p and q hash the turns up to this one, size is the conversation's length."""
    rows = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.withColumn("place", F.row_number().over(order))
    upto = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    hashed = lambda seed: F.xxhash64(F.lit(seed), "place", "role", "text")
    return placed.withColumns(
        {
            "p": F.bit_xor(hashed(1)).over(upto),
            "q": F.bit_xor(hashed(2)).over(upto),
            "size": F.count("*").over(Window.partitionBy("conv_id")),
        }
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, size, copies`` of the conversations that are no proper prefix of another; one of identical ones."""
    marked = turns_with_prefix(turns)
    whole = marked.filter("place = size").groupBy("size", "p", "q").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = marked.filter("place < size").select(F.col("place").cast("long").alias("size"), "p", "q").distinct()
    return whole.join(inner, ["size", "p", "q"], "left_anti").select("conv_id", "size", "copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, chat``: the rendered maximal conversations."""
    kept = maximal_conversations(turns).withColumnsRenamed({"conv_id": "__id", "size": "n_turns", "copies": "n_copies"})
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    held = rows.join(kept, rows["conv_id"].eqNullSafe(kept["__id"]))
    listed = held.groupBy("conv_id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("list"))
    line = lambda t: F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(MIDDLE), escaped(t["text"]), F.lit(CLOSE))
    return listed.select("conv_id", F.col("n_turns").cast("long"), "n_copies", F.array_join(F.transform("list", line), "").alias("chat"))
