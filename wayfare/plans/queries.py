"""The registered queries: every operator over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.numbers import as_decimals, rounded, zero_if_null
from wayfare.functions.zones import grid_zone
from wayfare.operators import inventory, merge, migration, quality, ranking, summaries, uniqueness
from wayfare.operators.filters import PICKUP, known_zone, last_hours, on_day, retained, since, split_invalid, until
from wayfare.plans import batch, live, rollups, serving
from wayfare.session import new_workdir, use_utc
from wayfare.sinks.ordered import first_rows, write_ordered
from wayfare.sinks.parquet import land_by_date, write_by_month, write_plain
from wayfare.sources import messages as msg
from wayfare.sources import replay, sample
from wayfare.sources.trips import enrich, read_trips, read_trips_merged
from wayfare.streaming import windows as sw
from wayfare.streaming.upsert import current_rows, publish, read_emissions, start_emissions
from wayfare.tables import DAILY_SUMMARY, DECIMAL_TYPES, HOURLY_ZONE_STATS, REAL_TIME_ZONES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "2024-01-05"
AS_OF = "2024-01-30 00:00:00"
REPLAY_START = "2024-01-03 00:00:00"
RAW_COLUMNS = [
    "trip_id",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pickup_zone",
    "dropoff_zone",
    "payment_type",
    "fare_amount",
    "total_amount",
    "tip_amount",
]


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(use_utc(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.read_sample_trips(spark, sf_dir)


def _busy_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.read_sample_trips(spark, sf_dir, coarse_zones=True)


# --- sources and projections ---------------------------------------------------------


@query
def trips_enriched(spark, sf_dir):
    return _trips(spark, sf_dir).select(*RAW_COLUMNS, "duration_minutes")


@query
def trips_from_drifted_files(spark, sf_dir):
    """One folder of files whose column types differ from the wanted ones and from each other."""
    raw = sample.as_raw_trips(sample.read_events(spark, sf_dir)).drop("trip_id")
    base = new_workdir(spark, "drifted")
    early = until(raw, PICKUP, "2024-01-16").withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("double"),
            "PULocationID": F.col("PULocationID").cast("string"),
            "payment_type": F.col("payment_type").cast("int"),
        }
    )
    late = since(raw, PICKUP, "2024-01-16").withColumns(
        {
            "fare_amount": F.col("fare_amount").cast("string"),
            "tpep_dropoff_datetime": F.col("tpep_dropoff_datetime").cast("string"),
            "DOLocationID": F.col("DOLocationID").cast("int"),
        }
    )
    write_plain(early, base, "append")
    write_plain(late, base, "append")
    return enrich(read_trips(spark, base)).select(
        *[c for c in RAW_COLUMNS if c != "trip_id"], "duration_minutes"
    )


@query
def trips_from_merged_files(spark, sf_dir):
    """Early files lack a column that later files have, and store another as double."""
    raw = sample.as_raw_trips(sample.read_events(spark, sf_dir))
    base = new_workdir(spark, "merged")
    early = until(raw, PICKUP, "2024-01-16").drop("tip_amount")
    write_plain(early.withColumn("passenger_count", F.col("passenger_count").cast("double")), base, "append")
    write_plain(since(raw, PICKUP, "2024-01-16"), base, "append")
    merged = read_trips_merged(spark, base)
    return enrich(merged).select(*RAW_COLUMNS, "duration_minutes")


@query
def trips_zero_filled(spark, sf_dir):
    return zero_if_null(_trips(spark, sf_dir)).select(*RAW_COLUMNS)


@query
def trips_rounded(spark, sf_dir):
    """A seventh of each measure, which never ends by itself, to two digits."""
    shares = [f"{c} / 7 AS {c}" for c in ("trip_distance", "total_amount", "duration_minutes")]
    return rounded(_trips(spark, sf_dir).selectExpr("trip_id", *shares))


@query
def publish_keys(spark, sf_dir):
    """The time of publication differs between runs; that it is set does not."""
    published = msg.with_publish_fields(_busy_trips(spark, sf_dir))
    return published.selectExpr(
        "trip_id", "pickup_zone", "partition_key", "producer_timestamp IS NOT NULL AS stamped"
    )


@query
def grid_zones(spark, sf_dir):
    points = sample.with_coordinates(sample.read_events(spark, sf_dir))
    return points.select(
        "trip_id",
        grid_zone(F.col("pickup_latitude"), F.col("pickup_longitude")).alias("pickup_zone"),
    )


@query
def valid_trips(spark, sf_dir):
    valid, _ = split_invalid(_trips(spark, sf_dir))
    return valid.select(*RAW_COLUMNS)


@query
def rejected_by_reason(spark, sf_dir):
    _, rejects = split_invalid(_trips(spark, sf_dir))
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("trip_count"))


@query
def json_trips(spark, sf_dir):
    texts = sample.as_messages(sample.read_events(spark, sf_dir))
    return msg.usable(msg.parse_messages(texts)).select(
        "trip_id",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "is_credit",
        "is_cash",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "pickup_zone",
        "dropoff_zone",
    )


@query
def json_rejects(spark, sf_dir):
    texts = sample.as_messages(sample.read_events(spark, sf_dir))
    return msg.rejected(msg.parse_messages(texts))


@query
def payment_class_counts(spark, sf_dir):
    texts = sample.as_messages(sample.read_events(spark, sf_dir))
    trips = msg.usable(msg.parse_messages(texts))
    return trips.groupBy("is_credit", "is_cash").agg(F.count(F.lit(1)).alias("trip_count"))


@query
def message_fates(spark, sf_dir):
    """Where every message ends: in a window, rejected for a reason, or without a zone."""
    texts = sample.as_messages(sample.read_events(spark, sf_dir), bad_times=True)
    parsed = msg.parse_messages(texts, event_column=PICKUP)
    counted = summaries.zone_window_stats(msg.usable(parsed), "1 hour")
    rejects = msg.rejected(parsed).groupBy("reject_reason").agg(F.count("*").alias("messages"))
    zone_less = msg.usable(parsed).where("pickup_zone IS NULL OR pickup_zone = ''")
    return (
        counted.agg(F.sum("trip_count").alias("messages")).select(F.lit("in_window").alias("fate"), "messages")
        .union(rejects)
        .union(zone_less.agg(F.count("*")).select(F.lit("no_zone"), "count(1)"))
        .union(texts.agg(F.count("*")).select(F.lit("all"), "count(1)"))
    )


# --- summaries -----------------------------------------------------------------------


@query
def daily_summary(spark, sf_dir):
    return ranking.by_date(summaries.daily_summary(_trips(spark, sf_dir)))


@query
def daily_summary_for_date(spark, sf_dir):
    return summaries.daily_summary(on_day(_trips(spark, sf_dir), DAY))


@query
def hourly_zone_stats(spark, sf_dir):
    return ranking.by_hour(summaries.hourly_zone_stats(_trips(spark, sf_dir)))


@query
def hourly_zone_stats_for_date(spark, sf_dir):
    return ranking.by_hour(summaries.hourly_zone_stats(on_day(_trips(spark, sf_dir), DAY)))


@query
def zone_window_1m(spark, sf_dir):
    return summaries.zone_window_stats(_busy_trips(spark, sf_dir))


@query
def zone_window_5m(spark, sf_dir):
    return summaries.zone_window_stats(_busy_trips(spark, sf_dir), "5 minutes")


@query
def zone_window_nulls_skipped(spark, sf_dir):
    return summaries.zone_window_stats(_busy_trips(spark, sf_dir), "1 hour", nulls="skip")


@query
def zone_hour_from_minute_partials(spark, sf_dir):
    minutes = summaries.zone_window_partials(_busy_trips(spark, sf_dir), "1 minute")
    return summaries.widen_windows(minutes, "1 hour")


@query
def global_window_1m(spark, sf_dir):
    return summaries.global_window_stats(_trips(spark, sf_dir))


@query
def route_analysis(spark, sf_dir):
    return summaries.route_analysis(_trips(spark, sf_dir))


@query
def route_analysis_by_days(spark, sf_dir):
    """All days stored, then one of them again: the table still holds all of them."""
    path = new_workdir(spark, "routes")
    trips = _trips(spark, sf_dir)
    for part in (trips, on_day(trips, DAY)):
        batch.store("route_analysis", batch.stored_rows("route_analysis", part), path)
    return batch.read_stored(spark, "route_analysis", path)


@query
def route_analysis_no_self(spark, sf_dir):
    return summaries.route_analysis(_trips(spark, sf_dir), self_routes=False)


@query
def daypart_profile(spark, sf_dir):
    return summaries.daypart_profile(summaries.hourly_zone_stats(_busy_trips(spark, sf_dir)))


# --- serving -------------------------------------------------------------------------


@query
def top_routes(spark, sf_dir):
    return ranking.top_routes(summaries.route_analysis(_trips(spark, sf_dir)), 20)


@query
def top_active_zones(spark, sf_dir):
    hours = summaries.zone_window_stats(_busy_trips(spark, sf_dir), "1 hour")
    return ranking.top_active_zones(hours, 5)


@query
def top_zones_total(spark, sf_dir):
    return ranking.top_zones(summaries.zone_window_stats(_trips(spark, sf_dir)), 10)


def _windows_around(trips: DataFrame, hours: int) -> DataFrame:
    """Zone windows that can start in the last hours; the range reaches the scan."""
    recent = last_hours(trips.withColumn("window_start", F.col(PICKUP)), AS_OF, hours)
    return summaries.zone_window_stats(recent.drop("window_start"))


@query
def recent_windows_24h(spark, sf_dir):
    windows = _windows_around(_busy_trips(spark, sf_dir), 24)
    return ranking.newest_first(last_hours(windows, AS_OF, 24))


@query
def retained_windows_7d(spark, sf_dir):
    return retained(_windows_around(_busy_trips(spark, sf_dir), 24 * 7), AS_OF, 7)


@query
def rebucket_5m_last_hour(spark, sf_dir):
    windows = _windows_around(until(_busy_trips(spark, sf_dir), PICKUP, AS_OF), 1)
    return summaries.rebucket(until(last_hours(windows, AS_OF, 1), "window_start", AS_OF))


@query
def revenue_series(spark, sf_dir):
    return summaries.revenue_series(summaries.zone_window_stats(_trips(spark, sf_dir)))


@query
def latest_windows(spark, sf_dir):
    return ranking.latest_windows(summaries.zone_window_stats(_busy_trips(spark, sf_dir)), 100)


@query
def busiest_windows(spark, sf_dir):
    hours = summaries.zone_window_stats(_busy_trips(spark, sf_dir), "1 hour")
    return ranking.busiest_windows(hours, 100)


def _first_of_ordered(spark, windows, order):
    path = new_workdir(spark, "ordered")
    write_ordered(windows, path, order)
    return first_rows(spark, path, order, 100)


@query
def latest_windows_ordered(spark, sf_dir):
    """As ``latest_windows``, from the few files of an ordered table that can hold them."""
    windows = summaries.zone_window_stats(_busy_trips(spark, sf_dir))
    return _first_of_ordered(spark, windows, ["-window_start", "-trip_count", "zone_id"])


@query
def busiest_windows_ordered(spark, sf_dir):
    hours = summaries.zone_window_stats(_busy_trips(spark, sf_dir), "1 hour")
    return _first_of_ordered(spark, hours, ["-trip_count", "-window_start", "zone_id"])


@query
def table_inventory(spark, sf_dir):
    """Over stored tables, which are small beside the trips."""
    base = new_workdir(spark, "inventory")
    trips = _trips(spark, sf_dir)
    times = {
        "real_time_zones": "window_start",
        "daily_summary": "date",
        "hourly_zone_stats": "date",
        "route_analysis": None,
    }
    for name in times:
        batch.store(name, batch.stored_rows(name, trips), f"{base}/{name}")
    return inventory.table_inventory(
        {name: (batch.read_stored(spark, name, f"{base}/{name}"), time) for name, time in times.items()}
    )


@query
def table_counts(spark, sf_dir):
    trips = _trips(spark, sf_dir)
    return inventory.table_counts(
        {
            "daily_summary": summaries.daily_summary(trips),
            "route_analysis": summaries.route_analysis(trips),
        }
    )


@query
def dataset_profile(spark, sf_dir):
    return inventory.dataset_profile(sample.as_raw_trips(sample.read_events(spark, sf_dir)))


def _stored(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Compute and store serving tables, then offer them to SQL."""
    base = new_workdir(spark, "serving")
    trips = _busy_trips(spark, sf_dir)
    for name in names:
        batch.store(name, batch.stored_rows(name, trips), f"{base}/{name}")
    serving.register_tables(spark, base, names)


@query
def view_last_24h(spark, sf_dir):
    _stored(spark, sf_dir, "real_time_zones")
    serving.register_recent_view(spark, AS_OF)
    return spark.sql(f"SELECT * FROM {serving.RECENT_VIEW}")


@query
def stored_tables_sql(spark, sf_dir):
    """A report in SQL over all six stored tables."""
    _stored(spark, sf_dir, *batch.SUMMARIES)
    return spark.sql(
        """
        SELECT 'daily_summary' AS table_name, count(*) AS record_count,
               sum(total_trips) AS trips FROM daily_summary
        UNION ALL SELECT 'hourly_zone_stats', count(*), sum(trip_count) FROM hourly_zone_stats
        UNION ALL SELECT 'route_analysis', count(*), sum(route_count) FROM route_analysis
        UNION ALL SELECT 'real_time_zones', count(*), sum(trip_count) FROM real_time_zones
        UNION ALL SELECT 'real_time_global', count(*), sum(total_trips) FROM real_time_global
        UNION ALL SELECT 'top_active_zones', count(*), sum(trip_count) FROM top_active_zones
        """
    )


# --- merges, constraints, layouts ----------------------------------------------------


def _stored_days(spark, sf_dir):
    """Daily summaries of the first 20 days, as if stored by an earlier run."""
    return summaries.daily_summary(until(_trips(spark, sf_dir), PICKUP, "2024-01-21"))


def _newer_days(spark, sf_dir):
    """Daily summaries of the last 15 days with corrected figures."""
    days = summaries.daily_summary(since(_trips(spark, sf_dir), PICKUP, "2024-01-16"))
    return days.withColumns(
        {
            "total_trips": F.col("total_trips") + 1000,
            "total_revenue": F.col("total_revenue") * 2,
            "avg_fare": F.col("avg_fare") * 2,
            "avg_tip": F.col("avg_tip") * 2,
        }
    )


def _emitted_days(spark, sf_dir):
    """The corrected days, each emitted twice, with one and two trips more."""
    emitted = _newer_days(spark, sf_dir).withColumn("emission", F.explode(F.array(F.lit(1), F.lit(2))))
    return emitted.withColumn("total_trips", F.col("total_trips") + F.col("emission"))


@query
def merge_insert_absent(spark, sf_dir):
    return merge.merge_insert_absent(
        _stored_days(spark, sf_dir), _newer_days(spark, sf_dir), DAILY_SUMMARY.keys
    )


@query
def merge_replace(spark, sf_dir):
    """The batch holds two emissions per day; the later one wins."""
    return merge.merge_replace(
        _stored_days(spark, sf_dir),
        _emitted_days(spark, sf_dir),
        DAILY_SUMMARY.keys,
        sequence="emission",
    )


@query
def merge_insert_absent_repeated(spark, sf_dir):
    """The batch holds two emissions per day; the first one is there when the second comes."""
    return merge.merge_insert_absent(
        _stored_days(spark, sf_dir), _emitted_days(spark, sf_dir), DAILY_SUMMARY.keys, "emission"
    )


@query
def merge_partial_repeated(spark, sf_dir):
    return merge.merge_partial(
        _stored_days(spark, sf_dir),
        _emitted_days(spark, sf_dir),
        DAILY_SUMMARY.keys,
        ["total_trips", "total_revenue", "avg_fare"],
        "emission",
    )


@query
def merge_partial(spark, sf_dir):
    return merge.merge_partial(
        _stored_days(spark, sf_dir),
        _newer_days(spark, sf_dir),
        DAILY_SUMMARY.keys,
        ["total_trips", "total_revenue", "avg_fare"],
    )


@query
def merge_windows_keep_end(spark, sf_dir):
    """Re-emitted hours replace their measures but not the stored window end."""
    hours = summaries.zone_window_stats(_busy_trips(spark, sf_dir), "1 hour")
    batch = since(hours, "window_start", "2024-01-16").withColumns(
        {
            "trip_count": F.col("trip_count") + 1,
            "window_end": F.expr("window_end + INTERVAL 1 DAY"),
        }
    )
    target = until(hours, "window_start", "2024-01-21")
    return merge.merge_replace(target, batch, REAL_TIME_ZONES.keys, keep=["window_end"])


@query
def constraint_report(spark, sf_dir):
    return quality.constraint_report(
        summaries.hourly_zone_stats(_trips(spark, sf_dir)), HOURLY_ZONE_STATS
    )


@query
def duplicate_keys(spark, sf_dir):
    """Zone and hour pairs that occur on more than one day."""
    hourly = summaries.hourly_zone_stats(_trips(spark, sf_dir))
    return quality.duplicate_keys(hourly, ["hour", "zone_id"])


@query
def schema_migrated(spark, sf_dir):
    old_columns = DAILY_SUMMARY.schema.names[:7]
    old = summaries.daily_summary(_trips(spark, sf_dir)).select(*old_columns)
    return migration.fill_defaults(migration.add_missing_columns(old, DAILY_SUMMARY), DAILY_SUMMARY)


@query
def money_decimal_variant(spark, sf_dir):
    types = DECIMAL_TYPES["daily_summary"]
    days = summaries.daily_summary(_trips(spark, sf_dir))
    return as_decimals(days.select("date", "total_trips", *types), types)


@query
def decimal_layouts(spark, sf_dir):
    """All six tables in their fixed-point layouts: rows and revenue to the cent."""
    trips = _busy_trips(spark, sf_dir)
    rows = []
    for name, types in DECIMAL_TYPES.items():
        table = as_decimals(batch.SUMMARIES[name](trips), types)
        rows.append(
            table.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("record_count"),
                F.sum("total_revenue").cast("decimal(18,2)").alias("total_revenue"),
            )
        )
    return reduce(DataFrame.union, rows)


@query
def partitioned_roundtrip(spark, sf_dir):
    path = new_workdir(spark, "by-date")
    land_by_date(_trips(spark, sf_dir).select(*RAW_COLUMNS), path)
    return spark.read.parquet(path)


@query
def append_violations(spark, sf_dir):
    """Hours up to the 20th are stored; of those from the 18th on, three days are there already."""
    hours = summaries.hourly_zone_stats(_trips(spark, sf_dir))
    path, keys = new_workdir(spark, "unique"), list(HOURLY_ZONE_STATS.keys)
    uniqueness.append_unique(hours.where("date <= DATE'2024-01-20'"), path, keys)
    return uniqueness.violations(hours.where("date >= DATE'2024-01-18'"), path, keys, "date")


def _rolled_up(spark, sf_dir, table):
    """Three loads; the last one is late for all dates but one, and only its dates are merged again."""
    base = new_workdir(spark, "rollups")
    trips = _busy_trips(spark, sf_dir)
    late = F.dayofmonth(PICKUP) == 9
    for load, chosen in (("a", "trip_id % 2 = 0"), ("b", "trip_id % 2 = 1")):
        rollups.add_load(trips.where(chosen).where(~late), base, load)
    rollups.refresh(spark, base)
    rollups.add_load(trips.where(late), base, "late")
    rollups.refresh(spark, base)
    return rollups.windows(spark, base, table)


@query
def rolled_up_hours(spark, sf_dir):
    return _rolled_up(spark, sf_dir, rollups.HOURS)


@query
def rolled_up_days(spark, sf_dir):
    return _rolled_up(spark, sf_dir, rollups.DAYS)


@query
def monthly_windows_roundtrip(spark, sf_dir):
    path = new_workdir(spark, "by-month")
    write_by_month(summaries.zone_window_stats(_busy_trips(spark, sf_dir)), path, "replace")
    return spark.read.parquet(path)


@query
def replay_schedule(spark, sf_dir):
    period = replay.select_period(_trips(spark, sf_dir), ["2024-01"], REPLAY_START)
    return replay.replay_schedule(period, 1000.0).select("trip_id", PICKUP, "due_seconds")


@query
def replay_schedule_limited(spark, sf_dir):
    """A cap that the sender falls behind at times: 40 records a second at speed 100,000."""
    schedule = replay.limited_schedule(_trips(spark, sf_dir), "trip_id", 40, 100_000.0)
    return schedule.select("trip_id", PICKUP, "due_micros", "sent_micros")


# --- streams -------------------------------------------------------------------------


def _streamed_events(spark, sf_dir, sentinels=0):
    """The events in five slices, one per trigger; sentinels are for streams in append mode."""
    path = new_workdir(spark, "event-files")
    files = sample.split_events(spark, sf_dir, path, sentinels=sentinels)
    return sample.stream_events(spark, path, maxFilesPerTrigger=str(files))


def _streamed_trips(spark, sf_dir, coarse_zones=True, sentinels=0):
    return enrich(sample.as_raw_trips(_streamed_events(spark, sf_dir, sentinels), coarse_zones))


def _drain(spark, rows, purpose, output_mode="update", transform=None, time="window_start"):
    """Run a stream over everything available and return what it stored."""
    base = new_workdir(spark, purpose)
    stored = transform(rows).schema if transform else rows.schema
    start_emissions(
        rows,
        f"{base}/rows",
        f"{base}/checkpoint",
        output_mode,
        transform,
        time,
        parallelism=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return read_emissions(spark, f"{base}/rows", stored)


@query
def stream_zone_window(spark, sf_dir):
    rows = sw.stream_zone_windows(sw.with_event_time(_streamed_trips(spark, sf_dir)))
    emitted = _drain(spark, rows, "zone-window")
    return current_rows(emitted, ["zone_id", "window_start"]).drop("window_date")


@query
def stream_zone_window_append(spark, sf_dir):
    """Every window comes once, after the sentinel has closed it."""
    trips = _streamed_trips(spark, sf_dir, sentinels=1)
    rows = sw.stream_zone_windows(sw.with_event_time(trips))
    return _drain(spark, rows, "zone-window-append", "append").drop("window_date", "emission")


@query
def stream_global_window(spark, sf_dir):
    rows = sw.stream_global_windows(sw.with_event_time(_streamed_trips(spark, sf_dir)), "5 minutes")
    emitted = _drain(spark, rows, "global-window")
    return current_rows(emitted, ["window_start"]).drop("window_date")


@query
def stream_top_zones(spark, sf_dir):
    """The ranking is state of the stream, and comes when the second sentinel moves the watermark on."""
    trips = sw.with_event_time(_streamed_trips(spark, sf_dir, sentinels=2))
    rows = sw.stream_top_zones(trips, 5)
    emitted = _drain(spark, rows, "top-zones", "append", time="update_time")
    return emitted.drop("window_date", "emission")


@query
def stream_publish(spark, sf_dir):
    """Two streams with a path each, published into one table that keeps the rows of both."""
    table = new_workdir(spark, "published")
    keys = ["zone_id", "window_start"]
    for low, high in ((0, 10), (10, 20)):
        trips = _streamed_trips(spark, sf_dir).where(f"CAST(pickup_zone AS INT) BETWEEN {low} AND {high - 1}")
        emitted = _drain(spark, sw.stream_zone_windows(sw.with_event_time(trips)), f"publish-{low}")
        publish(emitted, table, keys, [])
        publish(emitted, table, keys)
    return spark.read.parquet(table).drop("window_date")


@query
def stream_processing_time(spark, sf_dir):
    """Windows depend on the clock; the trips and the revenue of a zone do not."""
    rows = sw.stream_zone_windows(sw.with_processing_time(_streamed_trips(spark, sf_dir)))
    emitted = _drain(spark, rows, "processing-time")
    windows = current_rows(emitted, ["zone_id", "window_start"])
    return windows.groupBy("zone_id").agg(F.sum("trip_count").alias("trip_count"))


@query
def stream_closed_by_clock(spark, sf_dir):
    """Windows by processing time, each stored once it is over, which the clock alone decides after the
    last trip. The query ends when every trip of a known zone lies in a closed window."""
    trips = sw.with_heartbeats(_streamed_trips(spark, sf_dir), "0 seconds")
    rows = sw.stream_zone_windows(trips, "2 seconds")
    wanted = known_zone(_busy_trips(spark, sf_dir)).count()
    base = new_workdir(spark, "closed-by-clock")
    running = start_emissions(
        rows, f"{base}/rows", f"{base}/checkpoint", "append", interval="1 second",
        parallelism=spark.sparkContext.defaultParallelism,
    )
    stored = sw.wait_for_trips(running, lambda: read_emissions(spark, f"{base}/rows", rows.schema), wanted)
    return stored.groupBy("zone_id").agg(F.sum("trip_count").alias("trip_count"))


@query
def stream_messages(spark, sf_dir):
    """Message texts to five-minute zone windows: parse, drop rejects, aggregate, upsert."""
    texts = sample.as_messages(_streamed_events(spark, sf_dir)).select("value")
    rows = live.zone_windows(texts, "5 minutes", PICKUP, "1 hour")
    emitted = _drain(spark, rows, "messages")
    return current_rows(emitted, ["zone_id", "window_start"]).drop("window_date")


@query
def stream_rejects(spark, sf_dir):
    texts = sample.as_messages(_streamed_events(spark, sf_dir)).select("value")
    base = new_workdir(spark, "rejects")
    live.start_rejects(texts, f"{base}/rows", f"{base}/checkpoint", None).awaitTermination()
    return spark.read.schema("value string, reject_reason string").parquet(f"{base}/rows")


@query
def stream_replay(spark, sf_dir):
    """History replayed as a stream, one file per trigger, from a start time on."""
    events = replay.replay_stream(
        spark, f"{sf_dir}/event[s].parquet", sample.EVENTS_SCHEMA, files_per_trigger=1
    )
    trips = replay.select_period(enrich(sample.as_raw_trips(events)), ["2024-01"], REPLAY_START)
    base = new_workdir(spark, "replay")
    rows = trips.select("trip_id", PICKUP, "pickup_zone", "total_amount")
    (
        rows.writeStream.format("parquet")
        .option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")
