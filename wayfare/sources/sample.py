"""The sample ``events`` table seen as trips.

Every column is a plain expression, so the same mapping serves tables and streams.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sources.trips import enrich
from wayfare.tables import struct

EVENTS_SCHEMA = struct(
    event_id="bigint",
    ts="timestamp_ntz",
    user_id="bigint",
    event_type="string",
    value="double",
    props="string",
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Files of events as a stream; ``split_events`` says how many make one slice."""
    options = {"maxFilesPerTrigger": "1", **options}
    return spark.readStream.schema(EVENTS_SCHEMA).options(**options).parquet(path)


def split_events(spark: SparkSession, sf_dir: str, path: str, slices: int = 5, sentinels: int = 2) -> int:
    """The events in slices by time, written one after the other, as if they came in turn. All tasks
    write a slice; the number of files of a slice is returned, for a trigger to take just one.

    Some events of the last half hour of a slice come with the next one, so their windows are
    emitted again. Sentinels come last, days behind the events, each a slice of its own: they move the
    watermark past all windows of the events, and in append mode their own windows stay open.
    """
    events = read_events(spark, sf_dir)
    bounds = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    width = (bounds["b"] - bounds["a"]) / slices
    borders = [bounds["a"] + width * k for k in range(1, slices)]
    late = F.expr("event_id % 2 = 1")
    near = dt.timedelta(minutes=30)
    number = F.lit(0)
    for border in borders:
        behind = F.col("ts") >= F.lit(border).cast("timestamp_ntz")
        late_ones = (F.col("ts") >= F.lit(border - near).cast("timestamp_ntz")) & late
        number = number + (behind | late_ones).cast("int")
    files = spark.sparkContext.defaultParallelism
    for k in range(slices):
        own = events.where(number == k)  # with a range of times that reaches the scan
        if k:
            own = own.where(F.col("ts") >= F.lit(borders[k - 1] - near).cast("timestamp_ntz"))
        if k < slices - 1:
            own = own.where(F.col("ts") < F.lit(borders[k]).cast("timestamp_ntz"))
        own.repartition(files).write.mode("append").parquet(path)
    for k in range(sentinels):
        at = bounds["b"] + dt.timedelta(days=3 * (k + 1))
        row = ["1L AS event_id", "1L AS user_id", "'view' AS event_type", "0D AS value", "'{\"k\": 1}' AS props"]
        sentinel = spark.range(0, files, 1, files).selectExpr(*row).withColumn("ts", F.lit(at).cast("timestamp_ntz"))
        sentinel.select(*EVENTS_SCHEMA.names).write.mode("append").parquet(path)
    return files


def as_raw_trips(events: DataFrame, coarse_zones: bool = False) -> DataFrame:
    """Events as raw trip rows. Coarse zones fold the users into 20 busy zones."""
    zone = "user_id % 20" if coarse_zones else "user_id + 1"
    return events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k").selectExpr(
        "event_id AS trip_id",
        "ts AS tpep_pickup_datetime",
        "ts + make_dt_interval(0, 0, CAST(5 + k % 55 AS INT)) AS tpep_dropoff_datetime",
        "nullif(event_id % 7, 0L) AS passenger_count",
        "k / 4.0D AS trip_distance",
        f"CASE WHEN event_id % 97 <> 0 THEN {zone} END AS PULocationID",
        "k + 1 AS DOLocationID",
        """CASE event_type WHEN 'purchase' THEN 1L WHEN 'click' THEN 2L WHEN 'view' THEN 3L END
           AS payment_type""",
        "value AS fare_amount",
        """CASE event_type WHEN 'error' THEN -value WHEN 'purchase' THEN value + k / 10.0D
           ELSE value END AS total_amount""",
        "CASE event_type WHEN 'purchase' THEN k / 10.0D ELSE 0.0D END AS tip_amount",
    )


def read_sample_trips(spark: SparkSession, sf_dir: str, coarse_zones: bool = False) -> DataFrame:
    return enrich(as_raw_trips(read_events(spark, sf_dir), coarse_zones))


def with_coordinates(events: DataFrame) -> DataFrame:
    """Pickup points on a lattice that covers the zone grid and a margin around it."""
    return events.selectExpr(
        "event_id AS trip_id",
        "(40450000 + event_id * 37 % 620 * 1000) / 1e6D AS pickup_latitude",
        "(-74350000 + event_id * 53 % 720 * 1000) / 1e6D AS pickup_longitude",
    )


def as_messages(events: DataFrame, bad_times: bool = False) -> DataFrame:
    """Events as trip messages: one JSON text per row, payment types mixed, some cut off.

    With ``bad_times`` some pickup times are no times, and some are absent.
    """
    iso = r"yyyy-MM-dd\'T\'HH:mm:ss.SSSSSS"
    pickup = f"date_format(tpep_pickup_datetime, '{iso}')"
    if bad_times:
        pickup = f"""CASE WHEN trip_id % 103 = 0 THEN 'yesterday'
            WHEN trip_id % 107 <> 0 THEN {pickup} END"""
    fields = f"""to_json(named_struct(
        'trip_id', trip_id,
        'pickup_datetime', {pickup},
        'tpep_dropoff_datetime', date_format(tpep_dropoff_datetime, '{iso}'),
        'passenger_count', passenger_count,
        'trip_distance', trip_distance,
        'fare_amount', fare_amount,
        'tip_amount', tip_amount,
        'total_amount', total_amount,
        'pickup_zone', CAST(PULocationID AS STRING),
        'dropoff_zone', CAST(DOLocationID AS STRING),
        'producer_timestamp', date_format(tpep_pickup_datetime, '{iso}')))"""
    # The payment payloads in turn, as JSON literals.
    payment = """element_at(array('1', '2', '"CREDIT"', '"cash"', '"1"', '2.0'),
        CAST(trip_id % 6 + 1 AS INT))"""
    return as_raw_trips(events, coarse_zones=True).selectExpr(
        "trip_id",
        f"""concat('{{"payment_type":', {payment}, ',', substring({fields}, 2)) AS full_text""",
    ).selectExpr(
        "trip_id",
        "CASE WHEN trip_id % 101 = 0 THEN left(full_text, 12) ELSE full_text END AS value",
    )
