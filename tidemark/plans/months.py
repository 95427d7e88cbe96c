"""The store by maturity month, upserted by whole months and published by one marker.

Layout under the root:

=====================================  =================================================================
``rows/attempt=U/maturity_month=M/``   the rows of a month as an attempt ``U`` has written them
``heads/N``                            marker of the N-th state: for every month that has rows, its attempt
=====================================  =================================================================

An upsert writes the months that its rows leave or enter to a folder of its own and then creates the next marker, which names
the new folders of those months and the old ones of the others.  A row that moves from one month to another is thereby in
exactly one of them in every state that a reader can see, wherever a writer stops.  Of two writers at once the first to
create the marker counts; the other one starts again from the new state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import month_of
from tidemark.operators.store import apply_rows
from tidemark.plans.markers import Markers
from tidemark.schemas import KEY, STORE, STORE_COLUMNS
from tidemark.session import no_rows, written

MONTH = "maturity_month"
#: The month of rows without a maturity date.
UNDATED = "none"
_LAID = T.StructType([*STORE.fields, T.StructField(MONTH, T.StringType())])


def by_month(rows: DataFrame) -> DataFrame:
    return rows.select(*STORE_COLUMNS, F.coalesce(month_of(F.col("maturity_date")), F.lit(UNDATED)).alias(MONTH))


class MonthTable(Markers):
    @classmethod
    def create(cls, spark: SparkSession, root: str, store: DataFrame) -> MonthTable:
        """Start a table from store rows unique by primary key."""
        table = cls(spark, root)
        if not table._mark("heads/0", table._write(store)):
            raise ValueError(f"{root} holds a table already")
        return table

    def head(self) -> tuple[int, dict[str, str]]:
        """Number of the newest state, and the attempt that wrote each of its months."""
        number = self._numbers("heads")[-1]
        return number, self._marker(f"heads/{number}")

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Write rows to a folder of its own: its months with the attempt's name."""
        attempt = uuid.uuid4().hex
        place = f"{self.root}/rows/attempt={attempt}"
        by_month(rows).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(place)
        path, files = self._files()
        names = [s.getPath().getName() for s in files.listStatus(path(place))]
        return {n.removeprefix(f"{MONTH}="): attempt for n in names if n.startswith(f"{MONTH}=")}

    def read(self, months: dict[str, str] | None = None) -> DataFrame:
        """Store rows with their ``maturity_month``, by which folders are pruned; of the newest state unless one is given."""
        months = self.head()[1] if months is None else months
        if not months:
            return no_rows(self.spark, _LAID)
        paths = [f"{self.root}/rows/attempt={attempt}/{MONTH}={month}" for month, attempt in sorted(months.items())]
        return self.spark.read.schema(_LAID).option("basePath", f"{self.root}/rows").parquet(*paths).select(*_LAID.names)

    def touched(self, months: dict[str, str], rows: DataFrame) -> DataFrame:
        """``maturity_month, rows`` of the months that rows (as of ``by_month``) leave or enter.

        Where the keys are now is a semi join of the store's two key columns: Spark broadcasts the keys of a small batch.
        """
        leaving = self.read(months).join(rows.select(*KEY), KEY, "left_semi").select(MONTH)
        return rows.select(MONTH).unionAll(leaving).groupBy(MONTH).agg(F.count(F.lit(1)).alias("rows"))

    def held(self, months: dict[str, str], touched: DataFrame) -> DataFrame:
        """The rows of the touched months; the folders of other months are pruned at run time."""
        # one row per month; as a comparison, since Spark prunes folders only by conditions that it takes for selective
        wanted = F.broadcast(touched.filter("rows > 0").select(MONTH))
        return self.read(months).join(wanted, MONTH, "left_semi")

    def upsert(self, rows: DataFrame, on_expired: str = "reactivate") -> int:
        """Overlay unique store rows, rewriting only the months they leave or enter; returns the number of the new state."""
        rows = written(by_month(rows), "months-batch")
        while True:
            number, months = self.head()
            touched = written(self.touched(months, rows), "months-touched")
            old = {r[MONTH] for r in touched.select(MONTH).collect()}  # a name per month, as many as folders
            fresh = self._write(apply_rows(self.held(months, touched), rows, on_expired))
            after = {month: attempt for month, attempt in months.items() if month not in old} | fresh
            if self._mark(f"heads/{number + 1}", after):
                return number + 1
            path, files = self._files()
            for attempt in set(fresh.values()):
                files.delete(path(f"{self.root}/rows/attempt={attempt}"), True)

    def retire(self) -> list[str]:
        """Remove months that only states before the newest name, and their markers; call it when no reader of those is left."""
        path, files = self._files()
        number, months = self.head()
        gone = []
        for n, before in self._markers("heads").items():
            if n < number:
                gone += [f"{self.root}/rows/attempt={a}/{MONTH}={m}" for m, a in before.items() if months.get(m) != a]
                gone.append(f"{self.root}/heads/{n}")
        return [p for p in gone if files.exists(path(p)) and files.delete(path(p), True)]
