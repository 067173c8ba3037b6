"""Zone ids from coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grid box and cell size, in millionths of a degree.
LAT_MIN, LAT_MAX = 40_500_000, 41_000_000
LON_MIN, LON_MAX = -74_300_000, -73_700_000
CELL = 10_000


def micro_degrees(degrees: Column) -> Column:
    """Degrees as whole millionths; null when no such place exists."""
    return F.when(F.abs(degrees) <= 180.0, F.rint(degrees * 1_000_000).cast("bigint"))


def grid_zone(lat: Column, lon: Column) -> Column:
    """``zone_{row}_{column}`` of a point in degrees, null outside the half-open box.

    Works on whole micro-degrees: dividing degrees by 0.01 as doubles puts points that lie
    on a cell border into the wrong cell.
    """
    lat_u, lon_u = micro_degrees(lat), micro_degrees(lon)
    inside = (lat_u >= LAT_MIN) & (lat_u < LAT_MAX) & (lon_u >= LON_MIN) & (lon_u < LON_MAX)
    row = F.floor((lat_u - LAT_MIN) / CELL)
    column = F.floor((lon_u - LON_MIN) / CELL)
    return F.when(inside, F.concat_ws("_", F.lit("zone"), row.cast("string"), column.cast("string")))
