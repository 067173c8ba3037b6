"""Row selection: days, periods, known zones, valid trips."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.tables import LANDING_DATE

PICKUP = "tpep_pickup_datetime"


def on_day(trips: DataFrame, day: dt.date | str | None) -> DataFrame:
    """Trips picked up on one day; all of them without a day.

    Spark turns the date test into a timestamp range that reaches the Parquet scan; landed
    trips are pruned by their partition as well.
    """
    if day is None:
        return trips
    wanted = F.lit(str(day)).cast("date")
    trips = trips.filter(F.to_date(PICKUP) == wanted)
    return trips.filter(F.col(LANDING_DATE) == wanted) if LANDING_DATE in trips.columns else trips


def _moment(df: DataFrame, column: str, moment: dt.datetime | str) -> Column:
    return F.lit(str(moment)).cast(df.schema[column].dataType)


def since(df: DataFrame, column: str, moment: dt.datetime | str) -> DataFrame:
    return df.filter(F.col(column) >= _moment(df, column, moment))


def until(df: DataFrame, column: str, moment: dt.datetime | str) -> DataFrame:
    return df.filter(F.col(column) < _moment(df, column, moment))


def in_months(trips: DataFrame, months: Sequence[str]) -> DataFrame:
    """Pickups in any of the months ``yyyy-MM``, as ranges the scan can use."""
    wanted = None
    for month in months:
        first = F.lit(f"{month}-01").cast("date")
        pickup_date = F.to_date(PICKUP)
        inside = (pickup_date >= first) & (pickup_date < F.add_months(first, 1))
        wanted = inside if wanted is None else wanted | inside
    return trips if wanted is None else trips.filter(wanted)


def known_zone(trips: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    return trips.filter(F.col(zone).isNotNull() & (F.col(zone) != ""))


def different_zones(trips: DataFrame) -> DataFrame:
    """Without trips that end in their pickup zone. A trip with one unknown end stays."""
    return trips.filter(~F.col("pickup_zone").eqNullSafe(F.col("dropoff_zone")))


def last_hours(windows: DataFrame, as_of: dt.datetime | str, hours: int) -> DataFrame:
    """Windows that start at most so many hours before ``as_of``, or later."""
    start = _moment(windows, "window_start", as_of) - F.make_dt_interval(hours=F.lit(hours))
    return windows.filter(F.col("window_start") >= start)


def retained(windows: DataFrame, as_of: dt.datetime | str, days: int = 7) -> DataFrame:
    """Windows young enough to keep."""
    return last_hours(windows, as_of, 24 * days)


def trip_rules(zone_range: tuple[int, int] | None = (1, 265)) -> dict[str, str]:
    """Conditions a valid trip meets, in the order they are reported."""
    rules = {
        "missing_pickup_time": "tpep_pickup_datetime IS NOT NULL",
        "missing_dropoff_time": "tpep_dropoff_datetime IS NOT NULL",
        "dropoff_before_pickup": "tpep_dropoff_datetime >= tpep_pickup_datetime",
        "distance_not_positive": "trip_distance > 0",
        "fare_not_positive": "fare_amount > 0",
        "total_not_positive": "total_amount > 0",
        "passengers_out_of_range": "passenger_count BETWEEN 1 AND 6",
    }
    if zone_range:
        low, high = zone_range
        for end in ("pickup", "dropoff"):
            inside = f"try_cast({end}_zone AS INT) BETWEEN {low} AND {high}"
            rules[f"{end}_zone_out_of_range"] = inside
    return rules


def with_reject_reason(
    trips: DataFrame, zone_range: tuple[int, int] | None = (1, 265)
) -> DataFrame:
    """Add the first rule a trip breaks, null for a valid trip. Unknown counts as broken."""
    broken = " ".join(
        f"WHEN NOT coalesce({holds}, false) THEN '{name}'"
        for name, holds in trip_rules(zone_range).items()
    )
    return trips.selectExpr("*", f"CASE {broken} END AS reject_reason")


def split_invalid(
    trips: DataFrame, zone_range: tuple[int, int] | None = (1, 265)
) -> tuple[DataFrame, DataFrame]:
    """Valid trips, and the others with their reason."""
    judged = with_reject_reason(trips, zone_range)
    valid = judged.filter("reject_reason IS NULL").drop("reject_reason")
    return valid, judged.filter("reject_reason IS NOT NULL")
