"""Version rules with Spark's own keyed state: the highest versions of trades in the state store, by groups of trades."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.envelope import RULE_1, RULE_2
from tidemark.functions.keys import bucket_of

# Spark's store that keeps state on disk; transformWithState needs it.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Trades share state by hash in so many groups.  A group's marks are read and written together, so choose it for about a thousand
#: trades a group; it stays as it is for the life of a checkpoint.
GROUPS = 1 << 10


class TideMark(StatefulProcessor):
    """The highest version that each trade of a group has had in the stream.

    A call serves all trades of a group that a batch has: state is read and written once for them, and their running maxima are
    one pass over the rows.  The rows come in no order, so they are sorted by arrival first; they are a group's share of a batch,
    which the source's limits bound.
    """

    def __init__(self, order: Sequence[str], columns: Sequence[str]):
        self.order, self.columns = list(order), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getValueState("marks", "trade_ids array<string>, seen_versions array<int>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable", ignore_index=True)
        kept = self.marks.get()
        held = {} if kept is None else dict(zip(*kept, strict=True))
        codes, trades = pd.factorize(batch["trade_id"], use_na_sentinel=False)
        trades = [None if pd.isna(t) else t for t in trades]
        start = np.array([held.get(t, np.nan) for t in trades])
        version = batch["version"].astype("float64")
        # the highest version before each row: of the batch so far and of the state
        before = pd.Series(np.fmax(version.groupby(codes).cummax().groupby(codes).shift(1), start[codes]), index=batch.index)
        same = (version == before) & batch["matured"].astype(bool)
        reason = pd.Series([None] * len(batch), dtype="object").mask(version < before, RULE_1).mask(same, RULE_2)
        tops = np.fmax(version.groupby(codes).max().to_numpy(), start)
        risen = {trades[i]: int(tops[i]) for i in np.flatnonzero(tops != start)}
        if risen:
            held |= risen
            self.marks.update((list(held), [int(v) for v in held.values()]))
        yield batch[self.columns].assign(seen_version=before.astype("Int32"), reason=reason)

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stateful_prefilter(trades: DataFrame, order: Sequence[str], as_of, groups: int = GROUPS) -> DataFrame:
    """The stream tier over a streaming frame of sound records: adds ``seen_version`` and ``reason`` (null = accepted).

    Equal to ``version_rules.prefilter`` over all records, however they are split into batches, as long as batches come in
    order of arrival.  Marks live in the query's checkpoint, so a restarted query goes on where it stopped.
    """
    given = trades.withColumn("matured", F.coalesce(F.col("maturity_date") < as_of, F.lit(False)))
    given = given.withColumn("_group", bucket_of(F.col("trade_id"), groups))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in trades.schema.fields)
    return given.groupBy("_group").transformWithStateInPandas(
        TideMark(order, trades.columns), outputStructType=f"{schema}, seen_version int, reason string", outputMode="Append", timeMode="None"
    )
