"""Replaying historical files as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.filters import in_months, since
from wayfare.tables import TRIP_SCHEMA


def replay_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRIP_SCHEMA,
    pattern: str = "*.parquet",
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Parquet files as a stream; each trigger takes at most so many files or bytes."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def select_period(
    trips: DataFrame, months: Sequence[str] = (), start: str | None = None
) -> DataFrame:
    """Restrict a replay to months (``yyyy-MM``) and to pickups from ``start`` on."""
    if months:
        trips = in_months(trips, months)
    if start:
        trips = since(trips, "tpep_pickup_datetime", start)
    return trips


def replay_schedule(trips: DataFrame, speed: float = 1000.0) -> DataFrame:
    """Seconds after the start of the replay at which each trip is due.

    The first pickup is a scalar subquery: one number, computed once.
    """
    pickup = F.unix_timestamp("tpep_pickup_datetime")
    first = trips.select(F.min("tpep_pickup_datetime")).scalar()
    return trips.withColumn("due_seconds", (pickup - F.unix_timestamp(first)) / F.lit(float(speed)))


MICROS = 1_000_000
_EXACT = "decimal(38,0)"


def limited_schedule(
    trips: DataFrame, key: str, per_second: int, speed: float = 1000.0, turns: int = 64
) -> DataFrame:
    """``replay_schedule`` under a cap: adds ``due_micros``, and ``sent_micros``, when a sender that
    sends ``per_second`` records a second at most, in the order of their due times, sends each.

    A record is sent when it is due, or one slot (``1 / per_second``) after the one before it,
    whichever is later. So a time with ``n`` records takes ``n`` slots from
    ``max(due, end of the time before)`` on, and that is a prefix in the max-plus algebra: over the due
    times of a day, then over the days. Only counts are put in order; no record is.

    Records of one time take turns: by the remainder of the integer ``key`` by ``turns``, then by key.
    Each remainder of a time is ranked on its own, so a time with a third of all records is ``turns``
    tasks' work. Records without a pickup time are never due. Everything is whole numbers of
    ``1 / per_second`` microseconds; ``sent_micros`` is rounded down to the microsecond.
    """
    pickup = F.unix_timestamp("tpep_pickup_datetime")
    first = trips.select(F.min("tpep_pickup_datetime")).scalar()
    micros = F.round((pickup - F.unix_timestamp(first)) * MICROS / F.lit(float(speed))).cast("long")
    turn = F.pmod(F.col(key), F.lit(turns))
    due = trips.withColumns({"due_micros": micros, "_turn": turn}).where("due_micros IS NOT NULL")

    counts = due.groupBy("due_micros", "_turn").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("due_micros").orderBy("_turn").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    times = _sent_times(counts.groupBy("due_micros").agg(F.sum("_n").alias("_n")), per_second)
    starts = counts.join(times, "due_micros").select("due_micros", "_turn", "_before", "_start")

    rank = F.row_number().over(Window.partitionBy("due_micros", "_turn").orderBy(key)) - 1
    slot = F.col("_start") + (F.col("_before") + rank).cast(_EXACT) * MICROS
    sent = F.floor(slot / F.lit(per_second)).cast("long")
    return due.join(starts, ["due_micros", "_turn"]).select(*trips.columns, "due_micros", sent.alias("sent_micros"))


def _sent_times(times: DataFrame, per_second: int) -> DataFrame:
    """Adds ``_start`` to (due_micros, _n): when the first record of each time is sent, in parts of
    ``1 / per_second`` microseconds.

    With ``N`` records before a time, ``start = N * slot + max(due - N * slot)`` over all times so far.
    A day of replay needs what lies before it only as two numbers, so the window over all days has one
    row for each.
    """
    day = F.floor(F.col("due_micros") / F.lit(24 * 3600 * MICROS))
    sofar = Window.partitionBy("_day").orderBy("due_micros")
    own_before = F.coalesce(F.sum("_n").over(sofar.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reach = F.col("due_micros").cast(_EXACT) * per_second - F.col("_ahead").cast(_EXACT) * MICROS
    inside = (
        times.withColumn("_day", day)
        .withColumn("_ahead", own_before)
        .withColumn("_reach", F.max(reach).over(sofar))
    )
    days = inside.groupBy("_day").agg(F.sum("_n").alias("_n"), F.max("_reach").alias("_reach"))
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast(_EXACT) * MICROS
    carried = days.select("_day", "_reach", passed.alias("_passed")).select(
        "_day", "_passed", F.max(F.col("_reach") - F.col("_passed")).over(earlier).alias("_carried")
    )
    own = F.col("_reach") - F.col("_passed")
    start = F.greatest(own, F.col("_carried")) + F.col("_passed") + F.col("_ahead").cast(_EXACT) * MICROS
    return inside.join(carried, "_day").select("due_micros", start.alias("_start"))
