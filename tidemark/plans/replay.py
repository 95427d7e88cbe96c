"""Dead letters back into the table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ingest import ingest_batch, prepare_lines
from tidemark.plans.table import Batch, TradeTable
from tidemark.sources.dlq import decode_dlq

ORDER = ["batch", "file_path", "file_block_start", "row_id"]


def letter_lines(table: TradeTable, reasons: Sequence[str] | None = None) -> DataFrame:
    """The records inside a table's dead letters as lines, in their order, optionally of some reasons only."""
    letters = decode_dlq(table.dead_letters())
    if reasons is not None:
        letters = letters.filter(F.col("reason").isin(list(reasons)))
    return letters.select(F.coalesce("raw", F.to_json("trade")).alias("line"), *ORDER)


def replay_letters(
    table: TradeTable,
    lines: DataFrame,
    number: int,
    as_of: datetime.date | None = None,
    source: str = "replay",
) -> Batch:
    """Judge dead letters again as one batch, after the cause was repaired.

    ``lines`` comes from ``letter_lines``, repaired as needed.  ``number`` names the replay; the same number
    is not applied twice.  Letters refused again become new dead letters.
    """
    return ingest_batch(table, prepare_lines(lines), ORDER, source, number, as_of)
