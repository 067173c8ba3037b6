"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(start: str, end: str) -> str:
    """SQL for the minutes between two timestamps, each cut to whole seconds first."""
    return f"(unix_timestamp({end}) - unix_timestamp({start})) / 60.0D"


def iso_timestamp(text: str) -> str:
    """SQL for ISO-8601 text as a zone-less timestamp; null when it does not parse."""
    return f"try_cast({text} AS TIMESTAMP_NTZ)"


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def daypart(hour: Column) -> Column:
    """Peak 8-9 and 17-19, night 1-5, off-peak otherwise."""
    return (
        F.when(hour.between(8, 9) | hour.between(17, 19), "peak")
        .when(hour.between(1, 5), "night")
        .when(hour.isNotNull(), "off_peak")
    )


def month_key(ts: Column) -> Column:
    """``yyyy-MM`` of a timestamp or date, the partition key of long-lived tables."""
    return F.date_format(ts, "yyyy-MM")
