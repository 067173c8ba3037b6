"""Console preview and row counts taken while writing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def preview(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return the number of rows written, without a second job."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]
