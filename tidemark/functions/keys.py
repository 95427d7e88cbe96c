"""Hash placement of keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: hash partitions of the trade store and of the input topic.
PARTITIONS = 32


def bucket_of(key: Column, buckets: int = PARTITIONS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def uniform(*cols: Column, salt: int = 0) -> Column:
    """A reproducible draw in [0, 1) from the given columns."""
    return F.pmod(F.xxhash64(F.lit(salt), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def draw(*cols: Column, low: int, high: int, salt: int = 0) -> Column:
    """A reproducible integer draw in [low, high]."""
    return (F.pmod(F.xxhash64(F.lit(salt), *cols), F.lit(high - low + 1)) + F.lit(low)).cast("int")
