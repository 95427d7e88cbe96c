"""Session helpers: local test session and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(
    scratch: str, cores: int | str = 8, shuffle_partitions: int | None = None, app: str = "tidemark"
) -> SparkSession:
    """A local session for tests and benchmarks, with ``scratch`` as its folder for intermediate tables.

    On a cluster, use the session you are given.
    """
    parts = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.checkpoint.dir", scratch)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path for written intermediate tables.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  There is no other place that all executors see, so an
    unset one is an error on a cluster.  In local mode all run in one process, and an unset one gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        base = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/tidemark/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """The frame written to the shared folder and read back, where a plan needs it more than once and it is dear to compute."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: With this set while a write is planned, Spark deletes its shuffle files as soon as it ends.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _INSIDE, _BEFORE = threading.Lock(), Counter(), {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files; they else stay until the driver happens to collect its garbage.

    Threads may be inside at once; the last one to leave puts the setting back.
    """
    with _LOCK:
        if not _INSIDE[spark]:
            _BEFORE[spark] = spark.conf.get(_FREED, None)
            spark.conf.set(_FREED, "true")
        _INSIDE[spark] += 1
    try:
        yield
    finally:
        with _LOCK:
            _INSIDE[spark] -= 1
            if not _INSIDE[spark]:
                del _INSIDE[spark]
                before = _BEFORE.pop(spark)
                spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def whole_rows(df: DataFrame) -> DataFrame:
    """The same rows, of which no column is pruned below this point, for a joined frame that a plan uses more than once.

    Each use would else prune columns of its own, and two exchanges with different columns cannot be one.  The condition always
    holds; Spark does not see that.
    """
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.filter(F.hash(*hashable) >= F.lit(-(2**31)))


def one_row(spark: SparkSession, schema: str, values: tuple) -> DataFrame:
    """A single literal row in one partition; needs no Python worker."""
    fields = T.StructType.fromDDL(schema).fields
    columns = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values, strict=True)]
    return spark.range(0, 1, 1, 1).select(*columns)


def no_rows(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """An empty frame of a schema."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
