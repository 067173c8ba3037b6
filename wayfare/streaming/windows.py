"""Windowed summaries over streams of trips."""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterator
from itertools import chain

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wayfare.functions import measures as m
from wayfare.operators.filters import PICKUP
from wayfare.operators.summaries import (
    global_window_stats,
    zone_window_measures,
    zone_window_partials,
    zone_window_stats,
)

# How late a row may come by each clock: pickups are sent up to an hour after the fact.
DELAYS = {PICKUP: "1 hour", "producer_timestamp": "10 seconds"}


def with_event_time(trips: DataFrame, column: str = PICKUP, delay: str | None = DELAYS[PICKUP]) -> DataFrame:
    """Use a column as event time; rows later than ``delay`` may be dropped.

    Watermarks need zoned timestamps; the session zone must be UTC. Without a delay nothing
    is dropped and state is never released, which suits bounded replays only.
    """
    trips = trips.withColumn("event_time", F.col(column).cast("timestamp"))
    return trips.withWatermark("event_time", delay) if delay else trips


def with_processing_time(trips: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Use the time of the micro-batch, which stays the same when a batch runs again.

    No row is late by this clock. The watermark is there to release the state of past
    windows; its delay covers a clock that is set back.
    """
    timed = trips.withColumn("event_time", F.current_timestamp())
    return timed.withWatermark("event_time", delay)


def with_heartbeats(trips: DataFrame, delay: str = "1 minute") -> DataFrame:
    """``with_processing_time`` for trips that may stop coming: a row a second from the clock moves the
    watermark, so that append mode gives a window soon after its end on a silent source too.

    Heartbeats have a zone until they have passed the watermark, since Spark moves filters on other
    columns in front of it; the filter that takes them out names the event time and stays behind.
    """
    spark = trips.sparkSession
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in trips.schema if f.name != "pickup_zone"]
    beats = beats.select(*empty, F.lit("clock").alias("pickup_zone"), F.lit(True).alias("heartbeat"))
    both = trips.withColumn("heartbeat", F.lit(False)).unionByName(beats)
    timed = with_processing_time(both, delay)
    return timed.where("NOT heartbeat OR event_time < TIMESTAMP'1970-01-01'").drop("heartbeat")


def wait_for_trips(
    query: StreamingQuery, stored: Callable[[], DataFrame], trips: int, seconds: float = 300
) -> DataFrame:
    """Let a query run until its stored windows hold so many trips, then stop it."""
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end and query.isActive:
            query.awaitTermination(1)
            try:
                if stored().agg(F.sum("trip_count")).first()[0] == trips:
                    return stored()
            except AnalysisException as error:  # nothing is stored yet
                if "PATH_NOT_FOUND" not in str(error.getCondition()):
                    raise
    finally:
        query.stop()
    raise TimeoutError(f"the closed windows do not hold {trips} trips")


TOP_ZONES = "update_time timestamp_ntz, zone_id string, zone_rank int, trip_count bigint, total_revenue double"


class BestZones(StatefulProcessor):
    """Holds the best ``k`` zones of a window, and gives them when the watermark has passed what came."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "zones array<string>, counts array<bigint>, revenues array<double>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        held = list(zip(*self.best.get())) if self.best.exists() else []
        found = ((r.zone_id, r.trip_count, r.total_revenue) for r in rows)
        best = heapq.nsmallest(self.k, chain(held, found), key=lambda z: (-z[1], z[0]))
        self.best.update(tuple(map(list, zip(*best))))
        self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        if self.best.exists():
            held = zip(*self.best.get())
            self.best.clear()
            for rank, (zone, count, revenue) in enumerate(held, 1):
                yield Row(update_time=key[0], zone_id=zone, zone_rank=rank, trip_count=count, total_revenue=revenue)

    def close(self) -> None:
        pass


def stream_top_zones(trips: DataFrame, k: int, width: str = "1 hour", nulls: str = "zero") -> DataFrame:
    """The ``k`` busiest zones of every window, once it is closed: two stateful operators in append mode.

    The first sums up zones; the second holds no more than the best ``k`` of a window, merges what comes,
    and gives them when the watermark moves on. Ties go by zone. State has to be in RocksDB, which
    ``start_emissions`` sees to.
    """
    wanted = zone_window_measures(nulls)
    totals = m.finish(zone_window_partials(trips, width, "event_time", nulls), ["window", "zone_id"], wanted)
    start = F.col("window.start").cast("timestamp_ntz").alias("update_time")
    return (
        totals.select(F.window_time("window").alias("event_time"), start, "zone_id", "trip_count", "total_revenue")
        .groupBy("update_time")
        .transformWithState(BestZones(k), TOP_ZONES, "Append", "EventTime")
    )


def stream_zone_windows(trips: DataFrame, width: str = "1 minute", nulls: str = "zero") -> DataFrame:
    return zone_window_stats(trips, width, "event_time", nulls)


def stream_global_windows(trips: DataFrame, width: str = "1 minute", nulls: str = "zero") -> DataFrame:
    return global_window_stats(trips, width, "event_time", nulls)
