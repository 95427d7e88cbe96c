"""Random trade records as a Spark job: every field is a hash of the record number, so runs repeat and split freely."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import draw, uniform

# Profile of the generated records.
COUNTERPARTIES = 100
BOOKS = 50
MATURITY_DAYS = 5 * 365
CREATED_DAYS = 10 * 365
CREATED_TODAY = {"v1": 0.6, "vn": 0.8, "other": 0.5}
OTHER_ID_OFFSET = 100_000


def shares(total: int, v1_percent: float, vn_percent: float) -> tuple[int, int, int]:
    """Record counts (v1, vn, other); too large percentages are cut, vn first."""
    v1 = round(total * v1_percent / 100)
    vn = round(total * vn_percent / 100)
    if v1 + vn > total:
        vn = max(0, total - v1)
        v1 = min(v1, total)
    return v1, vn, total - v1 - vn


def generate_trades(
    spark: SparkSession,
    total: int,
    v1_percent: float = 20.0,
    vn_percent: float = 30.0,
    today: Column | None = None,
    seed: int = 0,
    numbers: DataFrame | None = None,
) -> DataFrame:
    """Records in the generator's naming, plus ``kind`` (v1, vn, other) and a random ``position``.

    v1 records have unique ids and version 1; vn records repeat v1 ids with versions 2 to 4; the others
    have new ids and versions 1 to 4.  Write ordered by ``position`` for a shuffled file.  ``numbers``
    may supply the record numbers 0..total-1 as ``id``; by default Spark makes them.
    """
    day = F.current_date() if today is None else today
    v1, vn, _ = shares(total, v1_percent, vn_percent)
    # without v1 records the vn records refer to ids of their own
    pool = v1 if v1 or not vn else vn
    n = F.col("id")

    def pick(low: int, high: int, salt: int) -> Column:
        return draw(n, low=low, high=high, salt=seed * 64 + salt)

    kind = F.when(n < v1, F.lit("v1")).when(n < v1 + vn, F.lit("vn")).otherwise(F.lit("other"))
    referred = F.pmod(F.xxhash64(F.lit(seed * 64 + 1), n), F.lit(max(1, pool))) + 1
    number = (
        F.when(F.col("kind") == "v1", n + 1)
        .when(F.col("kind") == "vn", referred)
        .otherwise(n - (v1 + vn) + pool + 1 + OTHER_ID_OFFSET)
    )
    trade_id = F.when(F.col("kind") == "other", F.format_string("T%06d", "number")).otherwise(
        F.format_string("T%05d", "number")
    )
    version = F.when(F.col("kind") == "v1", F.lit(1)).when(F.col("kind") == "vn", pick(2, 4, 2)).otherwise(pick(1, 4, 3))
    maturity = F.date_add(day, pick(-MATURITY_DAYS, MATURITY_DAYS, 4))
    chance = F.create_map(*[F.lit(x) for pair in CREATED_TODAY.items() for x in pair])[F.col("kind")]
    is_today = uniform(n, salt=seed * 64 + 5) < chance
    created = F.when(is_today, day).otherwise(F.date_add(day, pick(-CREATED_DAYS, 0, 6)))
    source = spark.range(total) if numbers is None else numbers.select("id")
    return (
        source.withColumn("kind", kind)
        .withColumn("number", number)
        .withColumn("maturity", maturity)
        .select(
            trade_id.alias("Trade Id"),
            version.cast("long").alias("Version"),
            F.concat(F.lit("CP-"), pick(1, COUNTERPARTIES, 7)).alias("Counter-Party_Id"),
            F.concat(F.lit("B"), pick(1, BOOKS, 8)).alias("Book-Id"),
            F.date_format("maturity", "dd/MM/yyyy").alias("Maturity_Date"),
            F.date_format(created, "dd/MM/yyyy").alias("Created_Date"),
            F.when(F.col("maturity") < day, F.lit("Y")).otherwise(F.lit("N")).alias("Expired"),
            F.col("kind"),
            F.xxhash64(F.lit(seed * 64 + 9), n).alias("position"),
        )
    )
