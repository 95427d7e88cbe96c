"""Payload handling: JSON text in, one JSON object out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "{}"

# JSON texts that count as "no payload".
NO_PAYLOAD = ["", "null", "{}", "[]", "0", "false", '""']


def payload_text(text: Column) -> Column:
    """Canonical payload text; anything empty becomes ``{}``."""
    trimmed = F.trim(text)
    return F.when(trimmed.isNull() | trimmed.isin(NO_PAYLOAD), F.lit(EMPTY)).otherwise(trimmed)


def payload_is_json(text: Column) -> Column:
    """True when the canonical payload parses; ``{}`` is not parsed again."""
    return (text == EMPTY) | F.try_parse_json(text).isNotNull()


def payload_field(text: Column, path: str, as_type: str = "string") -> Column:
    """One payload field by JSON path; null when absent or of another type."""
    return F.try_variant_get(F.try_parse_json(text), path, as_type)
