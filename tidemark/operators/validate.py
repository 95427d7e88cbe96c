"""Record validation: rules are data, compiled once into one column of reasons."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import NOT_NULL

REQUIRED = ("trade_id", "version", "maturity_date", "created_date")


def reasons(rules: Mapping[str, Column]) -> Column:
    """Codes of all violated rules, in rule order.  A rule whose condition is null is not violated."""
    return F.filter(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules.items()]), lambda r: r.isNotNull())


def not_null_rules(columns: Sequence[str] = REQUIRED) -> dict[str, Column]:
    return {f"{NOT_NULL}:{name}": F.col(name).isNull() for name in columns}


def rules_from_spec(spec: str | Mapping | Sequence) -> dict[str, Column]:
    """Compile a rule specification.

    ``spec`` is JSON text, or the parsed list of ``{"code": ..., "reject_when": SQL predicate}``.
    Stream and batch jobs load the same specification.
    """
    parsed = json.loads(spec) if isinstance(spec, str) else spec
    items = parsed["rules"] if isinstance(parsed, Mapping) else parsed
    return {item["code"]: F.expr(item["reject_when"]) for item in items}


def load_rules(spark: SparkSession, path: str) -> dict[str, Column]:
    """Compile a specification file: JSON, or YAML where a YAML reader is installed."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as missing:
            raise ValueError("no YAML reader is installed; use a JSON specification") from missing
        return rules_from_spec(yaml.safe_load(text))
    return rules_from_spec(text)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reasons`` (array of codes) and ``is_valid``."""
    return df.withColumn("reasons", reasons(rules)).withColumn("is_valid", F.size("reasons") == 0)


def constraint_check(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Set ``reject_code`` to CONSTRAINT_NOT_NULL where a required column is null, keeping earlier codes."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    earlier = F.col("reject_code") if "reject_code" in df.columns else F.lit(None).cast("string")
    return df.withColumn("reject_code", F.coalesce(earlier, F.when(missing, F.lit(NOT_NULL))))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key violations of a frame: keys held by more than one row, with the count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
