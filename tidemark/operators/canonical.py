"""From raw lines or foreign column names to the canonical trade columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import any_date, iso_date
from tidemark.functions.envelope import PARSE_ERROR
from tidemark.functions.payload import payload_is_json, payload_text
from tidemark.schemas import FIELD_NAMES


def _canonical(pick: Callable[[str], Column]) -> dict[str, Column]:
    version = F.trim(pick("version"))
    return {
        "trade_id": pick("trade_id"),
        "version": F.when(version.isNull() | (version == ""), F.lit(0)).otherwise(version.try_cast("int")),
        "counter_party_id": pick("counter_party_id"),
        "book_id": pick("book_id"),
        "maturity_date": any_date(pick("maturity_date")),
        "created_date": any_date(pick("created_date")),
        "payload": payload_text(pick("payload")),
    }


def decode_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Parse JSON text once and add the canonical columns plus ``reject_code``.

    ``reject_code`` is PARSE_ERROR for a line that is not a JSON object, a version that is not an
    integer, or a payload text that is not JSON; the canonical columns of such rows are null.
    A missing version counts as 0 and a missing payload as ``{}``.
    """
    fields = F.from_json(F.col(line), "map<string,string>", {"mode": "PERMISSIVE"})
    parsed = df.withColumn("_fields", fields)

    def pick(name: str) -> Column:
        return F.coalesce(*[F.try_element_at("_fields", F.lit(alias)) for alias in FIELD_NAMES[name]])

    decoded = parsed.withColumns(_canonical(pick))
    broken = F.col("_fields").isNull() | F.col("version").isNull() | ~payload_is_json(F.col("payload"))
    decoded = decoded.withColumn("reject_code", F.when(broken, F.lit(PARSE_ERROR))).drop("_fields")
    sound = F.col("reject_code").isNull()
    return decoded.withColumns({name: F.when(sound, F.col(name)) for name in FIELD_NAMES})


def canonicalize(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rename and convert a structured frame in any accepted naming; ``keep`` columns pass through."""

    def pick(name: str) -> Column:
        present = [F.col(f"`{alias}`").cast("string") for alias in FIELD_NAMES[name] if alias in df.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    columns = [c.alias(name) for name, c in _canonical(pick).items()]
    return df.select(*columns, *(keep or []))


def strict_decode(df: DataFrame, line: str = "line") -> DataFrame:
    """The strict variant: trade_id, an integer version and an ISO maturity date must all be present.

    Adds ``trade_id``, ``version``, ``maturity_date`` and ``reject_code`` (``parse_error`` or null).
    """
    parsed = df.withColumn("_fields", F.from_json(F.col(line), "map<string,string>", {"mode": "PERMISSIVE"}))
    maturity = F.try_element_at("_fields", F.lit("maturity_date"))
    plain_day = F.when(~maturity.contains("T"), iso_date(maturity))
    decoded = parsed.withColumns(
        {
            "trade_id": F.try_element_at("_fields", F.lit("trade_id")),
            "version": F.trim(F.try_element_at("_fields", F.lit("version"))).try_cast("int"),
            "maturity_date": plain_day,
        }
    ).drop("_fields")
    missing = F.col("trade_id").isNull() | F.col("version").isNull() | F.col("maturity_date").isNull()
    return decoded.withColumn("reject_code", F.when(missing, F.lit("parse_error")))
