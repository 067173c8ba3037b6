"""Number helpers: defaults, rounding and fixed-point columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIP_NUMBERS = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")


def zero_if_null(df: DataFrame, columns: Sequence[str] = TRIP_NUMBERS) -> DataFrame:
    """Missing numbers become zero."""
    return df.fillna(0, subset=[c for c in columns if c in df.columns])


def rounded(df: DataFrame, money: int = 2, coordinates: int = 6) -> DataFrame:
    """Round double columns: coordinates to 6 digits, everything else to 2."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    digits = {c: coordinates if c.endswith(("_longitude", "_latitude")) else money for c in doubles}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def as_decimals(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast measures to fixed-point types, half up. A value too wide is an error, as in a table."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})
