"""Ordered views and top-k. Every order ends with the key, so ties have one answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_date(daily: DataFrame) -> DataFrame:
    return daily.orderBy("date")


def by_hour(hourly: DataFrame) -> DataFrame:
    """Busiest zones first within each date and hour."""
    return hourly.orderBy("date", "hour", F.desc("trip_count"), "zone_id")


def newest_first(windows: DataFrame) -> DataFrame:
    return windows.orderBy(F.desc("window_start"), F.desc("trip_count"), "zone_id")


def latest_windows(windows: DataFrame, limit: int) -> DataFrame:
    """The newest rows, busiest first within a window."""
    return newest_first(windows).limit(limit)


def busiest_windows(windows: DataFrame, limit: int) -> DataFrame:
    return windows.orderBy(F.desc("trip_count"), F.desc("window_start"), "zone_id").limit(limit)


def top_routes(routes: DataFrame, limit: int) -> DataFrame:
    return routes.orderBy(F.desc("route_count"), "pickup_zone", "dropoff_zone").limit(limit)


def top_zones(windows: DataFrame, limit: int = 10) -> DataFrame:
    """Zones with the most trips over a window table."""
    totals = windows.groupBy("zone_id").agg(F.sum("trip_count").alias("trip_count"))
    return totals.orderBy(F.desc("trip_count"), "zone_id").limit(limit)


def top_active_zones(windows: DataFrame, k: int) -> DataFrame:
    """The ``k`` busiest zones of every window.

    Spark cuts each task's rows to ``k`` per window before the shuffle, so what moves does
    not grow with the number of zones.
    """
    order = Window.partitionBy("window_start").orderBy(F.desc("trip_count"), "zone_id")
    return (
        windows.withColumn("zone_rank", F.row_number().over(order))
        .filter(F.col("zone_rank") <= k)
        .select(
            F.col("window_start").alias("update_time"),
            "zone_id",
            "zone_rank",
            "trip_count",
            "total_revenue",
        )
    )
