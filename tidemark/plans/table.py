"""The trade table on storage: one snapshot, a folder per batch, one commit marker per batch, and a compaction job.

Layout under the table's root (``K`` is a batch's key, made from its source and its number or name):

=====================================  =================================================================
``snapshot-U/store|seen|commits/``     the table as of a commit: store rows and stream marks by bucket, batches folded in
``begun/K``                            marker that pins a batch's business date and time at its first attempt
``accepted|marks/batch=K-U/``          store rows that an attempt of a batch changes, and the stream marks of its trades
``outcomes|dlq|metrics/batch=K-U/``    its records with their reasons, dead letters, counts
``commits/S``                          marker of the S-th commit: which attempt of which batch it was
``snapshots/N``                        marker of the N-th snapshot: its folder and the commits it has folded in
=====================================  =================================================================

A marker is a small file that is created only if it does not exist.  That is all that writers share, so several sources may
run at once: a writer judges its batch against the commits it has seen, and if another one commits first, it finds its
marker's number taken, reads the levels of its trades again, and judges once more.  Every attempt (``U``) of a batch or a
compaction writes to folders of its own and readers open only what markers name, so a slow or repeated attempt never
writes under what another one has published.  Creating a marker is a rename that refuses to replace, which is atomic on HDFS
and local disks; an object store needs a committer with the same promise.

``compact`` writes the next snapshot with one plan; ``retire`` removes what no marker needs any more.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import PARTITIONS, bucket_of
from tidemark.operators.store import apply_rows, expire_matured, hash_layout, latest_active_version, latest_per_key, lookup
from tidemark.plans.markers import Markers
from tidemark.schemas import KEY, STORE, STORE_COLUMNS
from tidemark.session import no_rows, one_row, shuffles_freed

BATCH, GONE = "batch", "gone"
CHANGES = T.StructType([*STORE.fields, T.StructField(GONE, T.BooleanType())])
_SEEN = "trade_id string, seen_version int"
_COMMITS = "batch string, seq long, as_of date, at timestamp"


@dataclass(frozen=True)
class Batch:
    """An attempt of a begun batch with its pinned date and time; ``base`` is the last commit it was judged against."""

    key: str
    attempt: str
    source: str
    as_of: datetime.date
    at: datetime.datetime
    base: int = -1
    seq: int | None = None

    @property
    def folder(self) -> str:
        return f"{self.key}-{self.attempt}"

    @property
    def committed(self) -> bool:
        return self.seq is not None


@dataclass(frozen=True)
class State:
    """What a reader sees: a snapshot, the last commit folded into it, and the attempts committed since, in their order."""

    snapshot: int
    folder: str
    folded: int
    last: int
    since: dict[str, int] = field(default_factory=dict)


def batch_key(source: str, name: str | int) -> str:
    return hashlib.sha256(json.dumps([source, str(name)]).encode()).hexdigest()[:32]


class TradeTable(Markers):
    def __init__(self, spark: SparkSession, root: str, buckets: int = PARTITIONS, compact_every: int = 64):
        super().__init__(spark, root)
        self.buckets = buckets
        self.compact_every = compact_every

    def path(self, kind: str, key: str | None = None) -> str:
        return f"{self.root}/{kind}" + (f"/{BATCH}={key}" if key else "")

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, store: DataFrame | None = None, buckets: int = PARTITIONS, compact_every: int = 64
    ) -> TradeTable:
        """Start a table, empty or from a frame of store rows unique by primary key."""
        table = cls(spark, root, buckets, compact_every)
        rows = no_rows(spark, STORE) if store is None else store.select(*STORE_COLUMNS)
        folder = table._write_snapshot(rows, no_rows(spark, _SEEN), no_rows(spark, _COMMITS))
        no_rows(spark, "value string").write.mode("overwrite").text(table.path("dlq", "none"))
        table._mark("snapshots/0", {"folder": folder, "folded": -1})
        return table

    def state(self) -> State:
        snapshot, marker = max(self._markers("snapshots", self._numbers("snapshots")[-1] - 1).items())
        commits = self._markers("commits", marker["folded"])
        since = {c["batch"]: n for n, c in commits.items()}
        return State(snapshot, marker["folder"], marker["folded"], max([marker["folded"], *commits]), since)

    def _folded(self, state: State) -> DataFrame:
        return self.spark.read.schema(_COMMITS).parquet(f"{self.root}/{state.folder}/commits")

    # ---- batches ------------------------------------------------------------------------------------

    def _committed(self, key: str, state: State) -> int | None:
        since = [seq for folder, seq in state.since.items() if folder.startswith(f"{key}-")]
        if since:
            return since[0]
        row = self._folded(state).filter(F.col("batch").startswith(f"{key}-")).first()
        return None if row is None else row["seq"]

    def has(self, source: str, name: str | int) -> bool:
        """Whether a batch is part of the table."""
        return self._committed(batch_key(source, name), self.state()) is not None

    def begin(self, source: str, name: str | int, as_of: datetime.date | None = None) -> Batch:
        """Start an attempt of a batch, with the date and time pinned at its first one."""
        key = batch_key(source, name)
        path, files = self._files()
        if not files.exists(path(f"{self.root}/begun/{key}")):
            clock = self.spark.range(1).select(F.current_date().alias("d"), F.current_timestamp().alias("t")).first()
            at = clock["t"].replace(microsecond=0)
            # of two first attempts, one pins the date and time of both
            self._mark(f"begun/{key}", {"as_of": str(as_of or clock["d"]), "at": at.isoformat()})
        pinned = self._marker(f"begun/{key}")
        state = self.state()
        day, at = datetime.date.fromisoformat(pinned["as_of"]), datetime.datetime.fromisoformat(pinned["at"])
        return Batch(key, uuid.uuid4().hex, source, day, at, state.last, self._committed(key, state))

    def commit(self, batch: Batch) -> Batch | None:
        """Make a batch part of the table; None if another batch was committed after ``batch.base``: judge again."""
        seq = batch.base + 1
        content = {"batch": batch.folder, "as_of": str(batch.as_of), "at": batch.at.isoformat()}
        if not self._mark(f"commits/{seq}", content):
            return None
        return replace(batch, seq=seq)

    def apply(self, source: str, name: str | int, judge: Callable[[Batch], None], as_of: datetime.date | None = None) -> Batch:
        """Begin a batch, let ``judge`` write its folders, and commit it; again as often as others commit first."""
        batch = self.begin(source, name, as_of)
        while not batch.committed:
            judge(batch)
            batch = self.commit(batch) or self.begin(source, name)
        state = self.state()
        if len(state.since) > self.compact_every:
            self.compact()
        return batch

    def expire(self, as_of: datetime.date | None = None) -> Batch:
        """Overnight expiry: one batch of the newly matured rows alone."""

        def judge(batch: Batch) -> None:
            active = self.read().filter("NOT expired_flag")
            due = expire_matured(active, F.lit(batch.as_of)).filter("expired_flag")
            self.write_changes(batch, due.withColumn(GONE, F.lit(False)))

        day = as_of or self.spark.range(1).select(F.current_date().alias("d")).first()["d"]
        return self.apply("expire", str(day), judge, day)

    def delete(self, trade_ids: DataFrame, name: str) -> Batch:
        """Remove all versions of the listed trades, as one batch of their rows marked as gone."""

        def judge(batch: Batch) -> None:
            listed = self.read().join(trade_ids.select("trade_id").distinct(), "trade_id", "left_semi")
            self.write_changes(batch, listed.withColumn(GONE, F.lit(True)))

        return self.apply("delete", name, judge)

    def write_changes(self, batch: Batch, rows: DataFrame, marks: DataFrame | None = None) -> None:
        """Store rows that a batch changes, one per primary key, and the stream marks of its trades."""
        rows.select(*CHANGES.names).write.mode("overwrite").parquet(self.path("accepted", batch.folder))
        seen = no_rows(self.spark, _SEEN) if marks is None else marks
        seen.select("trade_id", "seen_version").write.mode("overwrite").parquet(self.path("marks", batch.folder))

    def begin_round(self, source: str, until: int) -> None:
        """Note the limit of a round of a landing folder, in seconds; the round's batch is named ``until <limit>``."""
        self._mark(f"rounds-{source}/{until}", {})

    def last_round(self, source: str) -> int:
        """The largest limit whose batch is committed; 0 if there is none."""
        return next((n for n in reversed(self._numbers(f"rounds-{source}")) if self.has(source, f"until {n}")), 0)

    # ---- snapshots ----------------------------------------------------------------------------------

    def _write_snapshot(self, store: DataFrame, seen: DataFrame, commits: DataFrame) -> str:
        """Write a snapshot to a folder of its own; it is part of the table once a marker names the folder."""
        folder = f"snapshot-{uuid.uuid4().hex}"
        with shuffles_freed(self.spark):
            for name, rows in (("store", store), ("seen", seen)):
                laid = hash_layout(rows, self.buckets).hint("rebalance", "bucket")
                laid.write.partitionBy("bucket").parquet(f"{self.root}/{folder}/{name}")
        commits.write.parquet(f"{self.root}/{folder}/commits")
        return folder

    def compact(self) -> State:
        """Write the table as it is now as the next snapshot.  Batches committed meanwhile stay beside it.

        Of compactions that run at once, the first to publish wins and the others delete what they have written.
        """
        state = self.state()
        commits = self._folded(state)
        for seq, c in self._markers("commits", state.folded).items():
            if seq <= state.last:
                row = (c["batch"], seq, datetime.date.fromisoformat(c["as_of"]), datetime.datetime.fromisoformat(c["at"]))
                commits = commits.unionByName(one_row(self.spark, _COMMITS, row))
        folder = self._write_snapshot(self.read(state), self._seen(state), commits)
        if not self._mark(f"snapshots/{state.snapshot + 1}", {"folder": folder, "folded": state.last}):
            path, files = self._files()
            files.delete(path(f"{self.root}/{folder}"), True)
        return self.state()

    def retire(self, keep_history: bool = True) -> list[str]:
        """Remove superseded snapshots, folded batches' changes and markers; returns the removed paths.

        Outcomes, dead letters and metrics are history and stay, unless ``keep_history`` is false.  Call it when no reader of
        an older snapshot is left.
        """
        path, files = self._files()
        state = self.state()
        folded = self._folded(state)
        gone = []
        for n, marker in self._markers("snapshots").items():
            if n < state.snapshot:
                gone += [f"{self.root}/{marker['folder']}", f"{self.root}/snapshots/{n}"]
        kinds = ["accepted", "marks", *([] if keep_history else ["outcomes", "dlq", "metrics"])]
        for row in folded.filter(F.col("seq") <= state.folded).toLocalIterator():
            gone += [self.path(kind, row["batch"]) for kind in kinds] + [f"{self.root}/commits/{row['seq']}"]
        return [p for p in gone if files.exists(path(p)) and files.delete(path(p), True)]

    # ---- reads --------------------------------------------------------------------------------------

    def _laid(self, kind: str, state: State, schema: T.StructType) -> DataFrame:
        laid = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(laid).parquet(f"{self.root}/{state.folder}/{kind}")

    def _since(self, kind: str, state: State, schema: T.StructType) -> DataFrame:
        """Rows of the batches committed since the snapshot, with their ``seq``; folders are named, none is listed."""
        found = no_rows(self.spark, T.StructType([*schema.fields, T.StructField("seq", T.LongType())]))
        if not state.since:
            return found
        paths = [self.path(kind, key) for key in state.since]
        numbers = F.create_map(*[F.lit(x) for key, seq in state.since.items() for x in (key, seq)])
        rows = self.spark.read.schema(schema).option("basePath", self.path(kind)).parquet(*paths)
        key = F.regexp_extract(F.col("_metadata.file_path"), f"{BATCH}=([0-9a-f-]+)", 1)
        return rows.withColumn("seq", F.element_at(numbers, key).cast("long")).select(*found.columns)

    def _newest(self, state: State) -> DataFrame:
        return latest_per_key(self._since("accepted", state, CHANGES), KEY, ["seq"], CHANGES.names)

    def _overlaid(self, base: DataFrame, newest: DataFrame) -> DataFrame:
        rest = apply_rows(base, newest.select(*STORE_COLUMNS))
        return rest.join(newest.filter(GONE).select(*KEY), KEY, "left_anti")

    def read(self, state: State | None = None) -> DataFrame:
        """The store as of the last committed batch."""
        state = state or self.state()
        base = self._laid("store", state, STORE).drop("bucket")
        return self._overlaid(base, self._newest(state)) if state.since else base

    def lookup(self, trade_id: str, version: int) -> DataFrame:
        """One store row; only its bucket of the snapshot is read."""
        state = self.state()
        base = lookup(self._laid("store", state, STORE), trade_id, version, self.buckets).drop("bucket")
        newest = latest_per_key(lookup(self._since("accepted", state, CHANGES), trade_id, version), KEY, ["seq"], CHANGES.names)
        return self._overlaid(base, newest)

    def _seen(self, state: State, ids: DataFrame | None = None, buckets: list[int] | None = None) -> DataFrame:
        kind = T.StructType.fromDDL(_SEEN)
        base, marks = self._laid("seen", state, kind), self._since("marks", state, kind)
        if ids is not None:
            base = base.filter(F.col("bucket").isin(buckets)).join(ids, "trade_id", "left_semi")
            marks = marks.join(ids, "trade_id", "left_semi")
        both = base.select("trade_id", "seen_version").unionByName(marks.select("trade_id", "seen_version"))
        return both.groupBy("trade_id").agg(F.max("seen_version").alias("seen_version"))

    def levels(self, touched: DataFrame | None = None) -> DataFrame:
        """(trade_id, seen_version, active_version) of all trades, or of the trades in ``touched``.

        With ``touched`` only the buckets of those trades are read (partition pruning, at most one number per bucket is
        collected), and the rest is a semi join whose small side Spark broadcasts if its measured size allows.
        """
        state = self.state()
        base, newest = self._laid("store", state, STORE), self._newest(state)
        ids = buckets = None
        if touched is not None:
            ids = touched.select("trade_id").distinct()
            held = bucket_of(F.col("trade_id"), self.buckets)
            buckets = [r["b"] for r in ids.select(held.alias("b")).distinct().collect()]
            base = base.filter(F.col("bucket").isin(buckets)).join(ids, "trade_id", "left_semi")
            newest = newest.join(ids, "trade_id", "left_semi")
        active = latest_active_version(self._overlaid(base.drop("bucket"), newest))
        return self._seen(state, ids, buckets).join(active, "trade_id", "full_outer").select("trade_id", "seen_version", "active_version")

    def committed(self) -> DataFrame:
        """``batch``: the folders of all committed batches."""
        state = self.state()
        done = self._folded(state).select(BATCH)
        for key in state.since:
            done = done.unionByName(one_row(self.spark, f"{BATCH} string", (key,)))
        return done

    def _history(self, kind: str) -> DataFrame:
        """All batches' rows of a kind; an unfinished batch's are told by ``batch`` and left out."""
        done = self.committed()
        if kind == "dlq":
            text = self.spark.read.text(self.path(kind))
            place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start")]
            # numbered in the scan, before the join can move a row
            rows = text.select("value", BATCH, *place).withColumn("row_id", F.monotonically_increasing_id())
        else:
            rows = self.spark.read.parquet(self.path(kind))
        return rows.join(done, BATCH, "left_semi")

    def outcomes(self) -> DataFrame:
        return self._history("outcomes")

    def dead_letters(self) -> DataFrame:
        """``value`` and, for the order of letters, ``batch, file_path, file_block_start, row_id``."""
        return self._history("dlq")

    def metrics(self) -> DataFrame:
        return self._history("metrics")
