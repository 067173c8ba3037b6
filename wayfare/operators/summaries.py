"""Summaries of trips. Every function maps a DataFrame to a DataFrame, and those over
windows take streams as well as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import measures as m
from wayfare.functions.payment import with_payment_flags
from wayfare.functions.times import daypart, is_weekend
from wayfare.operators.filters import PICKUP, different_zones, known_zone


DAILY = (
    m.rows("total_trips"),
    m.total("total_revenue", "total_amount"),
    m.mean("avg_fare", "fare_amount"),
    m.mean("avg_distance", "trip_distance"),
    m.mean("avg_duration_minutes", "duration_minutes", m.MINUTE_UNITS),
    m.mean("avg_passengers", "passenger_count"),
    m.matches("credit_card_trips", "is_credit"),
    m.matches("cash_trips", "is_cash"),
    m.mean("avg_tip", "tip_amount"),
    m.largest("max_fare", "total_amount"),
    m.smallest_positive("min_fare", "total_amount"),
)
HOURLY = (
    m.rows("trip_count"),
    m.total("total_revenue", "total_amount"),
    m.mean("avg_fare", "fare_amount"),
    m.mean("avg_distance", "trip_distance"),
    m.mean("avg_duration", "duration_minutes", m.MINUTE_UNITS),
    m.mean("avg_passengers", "passenger_count"),
)
ROUTE = (
    m.rows("route_count"),
    m.mean("avg_fare", "fare_amount"),
    m.mean("avg_distance", "trip_distance"),
    m.mean("avg_duration_minutes", "duration_minutes", m.MINUTE_UNITS),
    m.total("total_revenue", "total_amount"),
)


def zone_window_measures(nulls: str = "zero") -> tuple[m.Measure, ...]:
    return (
        m.rows("trip_count"),
        m.total("total_revenue", "total_amount", nulls=nulls),
        m.mean("avg_fare", "fare_amount", nulls=nulls),
        m.mean("avg_distance", "trip_distance", nulls=nulls),
        m.mean("avg_passengers", "passenger_count", nulls=nulls),
        m.matches("payment_cash_count", "is_cash"),
        m.matches("payment_credit_count", "is_credit"),
    )


def global_measures(nulls: str = "zero") -> tuple[m.Measure, ...]:
    return (
        m.rows("total_trips"),
        m.total("total_revenue", "total_amount", nulls=nulls),
        m.mean("avg_fare", "fare_amount", nulls=nulls),
        m.mean("avg_trip_distance", "trip_distance", nulls=nulls),
        m.mean("avg_passengers", "passenger_count", nulls=nulls),
    )


def daily_summary(trips: DataFrame) -> DataFrame:
    """One row per pickup date. Extremes are over the total amount; means skip nulls."""
    trips = with_payment_flags(trips)
    parts = m.partials(trips, [f"to_date({PICKUP}) AS date"], DAILY)
    return m.finish(parts, ["date"], DAILY)


def hourly_zone_stats(trips: DataFrame) -> DataFrame:
    """One row per pickup date, hour and zone; trips without a zone form their own group."""
    keys = [f"to_date({PICKUP}) AS date", f"hour({PICKUP}) AS hour", "pickup_zone AS zone_id"]
    return m.finish(m.partials(trips, keys, HOURLY), ["date", "hour", "zone_id"], HOURLY)


def route_analysis(trips: DataFrame, self_routes: bool = True) -> DataFrame:
    """One row per pickup and dropoff zone."""
    keys = ["pickup_zone", "dropoff_zone"]
    trips = trips if self_routes else different_zones(trips)
    return m.finish(m.partials(trips, keys, ROUTE), keys, ROUTE)


def route_parts(trips: DataFrame) -> DataFrame:
    """Mergeable parts of the routes of each pickup date, to be stored and replaced by date."""
    keys = [f"to_date({PICKUP}) AS date", "pickup_zone", "dropoff_zone"]
    return m.partials(trips, keys, ROUTE)


def routes_from_parts(parts: DataFrame) -> DataFrame:
    """One row per route over all dates of the parts."""
    keys = ["pickup_zone", "dropoff_zone"]
    return m.finish(m.combine(parts, keys, ROUTE), keys, ROUTE)


# Window bounds as zone-less timestamps; on streams the session zone is UTC.
BOUNDS = (
    "CAST(window.start AS TIMESTAMP_NTZ) AS window_start",
    "CAST(window.end AS TIMESTAMP_NTZ) AS window_end",
)


def _window(time: str, width: str) -> str:
    return f"window({time}, '{width}') AS window"


def zone_window_partials(
    trips: DataFrame, width: str = "1 minute", time: str = PICKUP, nulls: str = "zero"
) -> DataFrame:
    """Mergeable parts per zone and window."""
    trips = with_payment_flags(known_zone(trips))
    keys = [_window(time, width), "pickup_zone AS zone_id"]
    return m.partials(trips, keys, zone_window_measures(nulls))


def zone_window_stats(
    trips: DataFrame, width: str = "1 minute", time: str = PICKUP, nulls: str = "zero"
) -> DataFrame:
    """One row per known zone and tumbling window. Missing numbers count as zero unless
    ``nulls="skip"``."""
    parts = zone_window_partials(trips, width, time, nulls)
    return m.finish(parts, ["zone_id", *BOUNDS], zone_window_measures(nulls))


def widen_windows(parts: DataFrame, width: str, nulls: str = "zero") -> DataFrame:
    """Merge parts of narrow windows into wider ones and finish them."""
    wanted = zone_window_measures(nulls)
    keys = [_window("window.start", width), "zone_id"]
    return m.finish(m.combine(parts, keys, wanted), ["zone_id", *BOUNDS], wanted)


def global_window_stats(
    trips: DataFrame, width: str = "1 minute", time: str = PICKUP, nulls: str = "zero"
) -> DataFrame:
    """One row per window over all known zones."""
    wanted = global_measures(nulls)
    parts = m.partials(known_zone(trips), [_window(time, width)], wanted)
    return m.finish(parts, BOUNDS, wanted)


def rebucket(windows: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Trips per wider window over all zones of a window table."""
    counts = (m.summed("trip_count", "trip_count"),)
    parts = m.partials(windows, [_window("window_start", width)], counts)
    return m.finish(parts, BOUNDS, counts)


def revenue_series(windows: DataFrame) -> DataFrame:
    """Revenue per window start over all zones."""
    revenue = (m.total("total_revenue", "total_revenue"),)
    return m.finish(m.partials(windows, ["window_start"], revenue), ["window_start"], revenue)


def daypart_profile(hourly: DataFrame) -> DataFrame:
    """Hourly zone statistics by part of the day and weekend; means weighted by trips."""
    wanted = (
        m.summed("trip_count", "trip_count"),
        m.total("total_revenue", "total_revenue"),
        m.weighted_mean("avg_fare", "avg_fare", "trip_count"),
        m.weighted_mean("avg_distance", "avg_distance", "trip_count"),
        m.weighted_mean("avg_duration", "avg_duration", "trip_count", m.MINUTE_UNITS),
    )
    hourly = hourly.withColumns(
        {"daypart": daypart(F.col("hour")), "is_weekend": is_weekend(F.col("date"))}
    )
    parts = m.partials(hourly, ["zone_id", "daypart", "is_weekend"], wanted)
    return m.finish(parts, ["zone_id", "daypart", "is_weekend"], wanted)
