"""Progress of streams while they run: counts by observation, and a listener that writes them down."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = "query string, run_id string, batch long, at timestamp, metric string, value double"


def observed(df: DataFrame, name: str = "counts") -> DataFrame:
    """Count a stream's records as they pass, without a pass of their own: all, refused while decoding, latest version."""
    refused = F.col("reject_code").isNotNull() if "reject_code" in df.columns else F.lit(False)
    return df.observe(name, F.count(F.lit(1)).alias("records"), F.count_if(refused).alias("refused"), F.max("version").alias("top_version"))


class ProgressLog(StreamingQueryListener):
    """Hands every batch's figures to ``write`` as (query, run id, batch, time, metric, value).

    ``write`` gets a batch's rows at a time; what it raises is kept in ``failures`` and does not stop the stream.
    """

    def __init__(self, write: Callable[[list[tuple]], None]):
        self.write = write
        self.failures: list[str] = []
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = json.loads(event.progress.json)
        figures = {"input_rows": told["numInputRows"], "seconds": told.get("durationMs", {}).get("triggerExecution", 0) / 1000}
        figures["input_rows_per_second"] = told.get("processedRowsPerSecond", 0.0)
        for name, row in told.get("observedMetrics", {}).items():
            figures |= {f"{name}.{k}": v for k, v in row.items() if isinstance(v, int | float)}
        rows = [(told.get("name") or told["id"], told["runId"], told["batchId"], told["timestamp"], k, float(v)) for k, v in figures.items()]
        try:
            self.write(rows)
        except Exception as problem:  # noqa: BLE001 - progress must not stop the stream
            self.failures.append(str(problem))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, run_id: str, seconds: float = 30) -> bool:
        """Until all of a finished query's figures have come: they arrive a little after its end."""
        return self._ended.setdefault(str(run_id), threading.Event()).wait(seconds)


def progress_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Figures of a listener as a frame."""
    named = spark.createDataFrame(rows, PROGRESS.replace("at timestamp", "at string"))
    return named.withColumn("at", F.to_timestamp("at"))
