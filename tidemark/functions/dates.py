"""Date text to DATE.  Unreadable text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
DMY_SHAPE = r"^\d{2}/\d{2}/\d{4}$"


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD``, alone or ahead of a ``T`` time part."""
    day = F.substring_index(text, "T", 1)
    return F.when(day.rlike(ISO_SHAPE), F.try_to_date(day, "yyyy-MM-dd"))


def dmy_date(text: Column) -> Column:
    """``DD/MM/YYYY``, the generator's style."""
    return F.when(text.rlike(DMY_SHAPE), F.try_to_date(text, "dd/MM/yyyy"))


def any_date(text: Column) -> Column:
    return F.coalesce(iso_date(text), dmy_date(text))


def month_of(day: Column) -> Column:
    """Range-partition label of a maturity date."""
    return F.date_format(day, "yyyy-MM")
