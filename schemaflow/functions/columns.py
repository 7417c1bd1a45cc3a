"""Scalar expressions over order rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The segments, and the hour as text.
SEGMENTS = ("retail", "wholesale", "premium")
HOUR_FORMAT = "yyyy-MM-dd-HH"
HOUR_PATTERN = r"^\d{4}-\d{2}-\d{2}-\d{2}$"


def net_cents() -> Column:
    """Total less discount, as long; overflow raises under ANSI mode."""
    return F.col("total_cents") - F.col("discount_cents")


def date_hour(time: Column) -> Column:
    """Hour label of a time, in the session time zone."""
    return F.date_format(time, HOUR_FORMAT)


def is_date_hour(label: Column) -> Column:
    return label.rlike(HOUR_PATTERN)


def padded_id(prefix: str, width: int, number: Column) -> Column:
    """``prefix-`` and the number, zero-padded to ``width`` digits."""
    return F.format_string(f"{prefix}-%0{width}d", number)


def segment_of(number: Column) -> Column:
    """Segment picked in turn by ``number``."""
    return F.element_at(F.array(*map(F.lit, SEGMENTS)), (number % len(SEGMENTS) + 1).cast("int"))


def millis_to_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def null_binary() -> Column:
    return F.lit(None).cast("binary")
