"""Streams over several files, one file per micro-batch."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from conftest import ROOT
from helpers import NOON, plan_of
from pyspark.sql import functions as F

from wayfare.operators.ranking import top_active_zones
from wayfare.operators.summaries import global_window_stats, zone_window_stats
from wayfare.plans import live
from wayfare.session import STREAM_CONF
from wayfare.sinks import jdbc
from wayfare.sources.messages import parse_messages, rejected, usable
from wayfare.sources.replay import replay_stream
from wayfare.sources.sample import EVENTS_SCHEMA, as_messages, as_raw_trips, read_events, read_sample_trips
from wayfare.sources.trips import enrich
from wayfare.streaming.upsert import (
    current_rows,
    emission_writer,
    publish,
    published_and_open,
    read_emissions,
    remove_emissions,
    start_emissions,
)
from wayfare.streaming.windows import (
    stream_global_windows,
    stream_zone_windows,
    with_event_time,
    with_processing_time,
)
from wayfare.tables import struct

KEYS = ["zone_id", "window_start"]
TRIP = struct(tpep_pickup_datetime="timestamp_ntz", pickup_zone="string", payment_type="bigint",
              passenger_count="bigint", trip_distance="double", fare_amount="double", total_amount="double")


@pytest.fixture(scope="module")
def files(spark, sf_dir, tmp_path_factory):
    """The sample events as five files in time order, written one after the other."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = read_events(spark, sf_dir)
    edges = [dt.datetime(2024, 1, d) for d in (1, 7, 13, 19, 25)] + [dt.datetime(2024, 2, 1)]
    for low, high in zip(edges, edges[1:]):
        part = events.filter((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high)))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, files, per_trigger=1):
    events = replay_stream(spark, files, EVENTS_SCHEMA, files_per_trigger=per_trigger)
    return enrich(as_raw_trips(events, coarse_zones=True))


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    return sorted(map(repr, left.select(columns).collect())) == sorted(map(repr, right.select(columns).collect()))


def drain(spark, rows, base, **options):
    query = start_emissions(rows, f"{base}/rows", f"{base}/checkpoint", **options)
    query.awaitTermination()
    return query


def test_updates_merge_to_the_batch_result(spark, sf_dir, files, tmp_path):
    rows = stream_zone_windows(with_event_time(stream(spark, files)), "1 hour")
    query = drain(spark, rows, tmp_path)
    batches = {p["batchId"] for p in query.recentProgress if p["numInputRows"]}
    assert len(batches) == 5
    for folder in (tmp_path / "rows").glob("window_date=*/emission=*"):
        assert 1 <= len(list(folder.glob("*.parquet"))) <= 2
    emitted = read_emissions(spark, f"{tmp_path}/rows", rows.schema)
    expected = zone_window_stats(read_sample_trips(spark, sf_dir, coarse_zones=True), "1 hour")
    assert same(current_rows(emitted, KEYS).drop("window_date"), expected)

    publish(emitted, f"{tmp_path}/table", KEYS)
    publish(emitted, f"{tmp_path}/table", KEYS, ["2024-01-05", "2024-01-06"])
    table = spark.read.parquet(f"{tmp_path}/table")
    assert same(table.drop("window_date"), expected)

    view = published_and_open(table, emitted, KEYS, "2024-01-20")
    assert same(view.drop("window_date"), expected)
    assert plan_of(view).count("PartitionFilters: [isnotnull(window_date") == 2


def test_publish_keeps_what_other_emissions_stored(spark, tmp_path):
    table = f"{tmp_path}/table"
    for name, zone in (("first", "A"), ("second", "B")):
        trip_file(spark, tmp_path / name, (0, zone, 1.0), (1, "C", 2.0))
        query, _ = run_live(spark, tmp_path / name, tmp_path / f"{name}-run")
        schema = stream_zone_windows(with_event_time(replay_stream(spark, str(tmp_path / name), TRIP))).schema
        emitted = read_emissions(spark, f"{tmp_path}/{name}-run/rows", schema)
        publish(emitted, table, KEYS, [])
        publish(emitted, table, KEYS)
        assert all(o["numRowsDroppedByWatermark"] == 0 for p in query.recentProgress for o in p["stateOperators"])
    rows = {r.zone_id: r.trip_count for r in spark.read.parquet(table).collect()}
    assert rows == {"A": 1, "B": 1, "C": 1}
    assert remove_emissions(spark, f"{tmp_path}/first-run/rows", ["2024-01-05", "1999-01-01"]) == 1


def test_live_upserts_stage_every_batch(spark, files, tmp_path, monkeypatch):
    """No database here: the statements and the rows that would be staged are recorded."""
    statements, staged = [], []

    def record(df, table, target, keys, replace, execute, staging):
        staged.append((table, staging, df.count()))
        execute(jdbc.upsert_statement(table, staging, df.columns, keys, replace))

    monkeypatch.setattr(jdbc, "upsert", record)
    rows = stream_zone_windows(with_event_time(stream(spark, files)), "1 day")
    target = jdbc.JdbcTarget("jdbc:x", batch_size=100)
    query = live.start_upserts(rows, target, f"{tmp_path}/c", statements.append, "one", None)
    query.awaitTermination()
    assert len(staged) >= 5 and {s[:2] for s in staged} == {("real_time_zones", "real_time_zones_staging_one")}
    assert all("ON CONFLICT (zone_id, window_start) DO UPDATE SET" in s for s in statements)
    assert all("window_end = EXCLUDED" not in s for s in statements)


def test_state_lives_in_rocksdb(spark, files, tmp_path):
    rows = stream_global_windows(with_event_time(stream(spark, files)), "1 day")
    keys = ("spark.sql.shuffle.partitions", *STREAM_CONF)
    before = [spark.conf.get(key, None) for key in keys]
    query = drain(spark, rows, tmp_path, parallelism=3)
    assert query.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3
    assert [spark.conf.get(key, None) for key in keys] == before
    metrics = [o["customMetrics"] for p in query.recentProgress for o in p["stateOperators"]]
    assert any("rocksdbPutCount" in m for m in metrics)


def test_append_emits_closed_windows_once(spark, sf_dir, files, tmp_path):
    rows = stream_zone_windows(with_event_time(stream(spark, files)))
    drain(spark, rows, tmp_path, output_mode="append")
    emitted = read_emissions(spark, f"{tmp_path}/rows", rows.schema).drop("window_date", "emission")
    trips = read_sample_trips(spark, sf_dir, coarse_zones=True)
    last = trips.agg(F.max("tpep_pickup_datetime")).first()[0]
    closed = zone_window_stats(trips).filter(F.col("window_end") <= F.lit(last - dt.timedelta(seconds=10)))
    assert same(emitted, closed)
    assert emitted.count() < zone_window_stats(trips).count()


def test_top_zones_of_closed_hours(spark, sf_dir, files, tmp_path):
    rows = stream_zone_windows(with_event_time(stream(spark, files), delay="10 seconds"), "1 hour")
    drain(spark, rows, tmp_path, output_mode="append", transform=lambda b: top_active_zones(b, 3), time="update_time")
    expected = top_active_zones(zone_window_stats(read_sample_trips(spark, sf_dir, coarse_zones=True), "1 hour"), 3)
    schema = expected.schema
    emitted = read_emissions(spark, f"{tmp_path}/rows", schema).drop("window_date", "emission")
    last = expected.agg(F.max("update_time")).first()[0]
    assert same(emitted, expected.filter(F.col("update_time") < F.lit(last)))


def test_global_windows(spark, sf_dir, files, tmp_path):
    rows = stream_global_windows(with_event_time(stream(spark, files)), "5 minutes")
    drain(spark, rows, tmp_path)
    emitted = read_emissions(spark, f"{tmp_path}/rows", rows.schema)
    expected = global_window_stats(read_sample_trips(spark, sf_dir, coarse_zones=True), "5 minutes")
    assert same(current_rows(emitted, ["window_start"]).drop("window_date"), expected)


def trip_file(spark, folder, *trips):
    rows = [(NOON + dt.timedelta(seconds=s), zone, 1, 1, 1.0, amount, amount) for s, zone, amount in trips]
    spark.createDataFrame(rows, TRIP).coalesce(1).write.mode("append").parquet(str(folder))


def run_live(spark, folder, base, delay="10 seconds"):
    rows = stream_zone_windows(with_event_time(replay_stream(spark, str(folder), TRIP, files_per_trigger=1), delay=delay))
    query = drain(spark, rows, base)
    return query, current_rows(read_emissions(spark, f"{base}/rows", rows.schema), KEYS)


def test_a_window_emitted_again_is_replaced_not_added(spark, tmp_path):
    folder = tmp_path / "in"
    trip_file(spark, folder, (0, "A", 1.0), (1, "A", 1.0), (2, "A", 1.0))
    trip_file(spark, folder, (3, "A", 1.0), (4, "A", 1.0))
    _, rows = run_live(spark, folder, tmp_path)
    assert [(r.trip_count, r.total_revenue) for r in rows.collect()] == [(5, 5.0)]


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    folder = tmp_path / "in"
    trip_file(spark, folder, (0, "A", 1.0))
    _, rows = run_live(spark, folder, tmp_path)
    assert [r.trip_count for r in rows.collect()] == [1]
    trip_file(spark, folder, (5, "A", 2.0), (6, "B", 4.0))
    query, rows = run_live(spark, folder, tmp_path)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert {r.zone_id: (r.trip_count, r.total_revenue) for r in rows.collect()} == {"A": (2, 3.0), "B": (1, 4.0)}


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder = tmp_path / "in"
    trip_file(spark, folder, (0, "A", 1.0))
    trip_file(spark, folder, (600, "A", 1.0))
    trip_file(spark, folder, (620, "A", 1.0))  # Spark drops by the watermark of one batch before
    trip_file(spark, folder, (1, "A", 1.0), (601, "A", 1.0))
    query, rows = run_live(spark, folder, tmp_path / "strict")
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 1
    assert sorted(r.trip_count for r in rows.collect()) == [1, 3]
    _, rows = run_live(spark, folder, tmp_path / "patient", delay="1 hour")
    assert sorted(r.trip_count for r in rows.collect()) == [2, 3]
    _, rows = run_live(spark, folder, tmp_path / "never", delay=None)
    assert sorted(r.trip_count for r in rows.collect()) == [2, 3]


def test_a_batch_written_again_changes_nothing(spark, tmp_path):
    schema = struct(zone_id="string", window_start="timestamp_ntz", trip_count="bigint")
    first = spark.createDataFrame([("A", NOON, 3), ("B", NOON, 1)], schema)
    second = spark.createDataFrame([("A", NOON, 5)], schema)
    save = emission_writer(str(tmp_path / "rows"))
    save(first, 0)
    save(second, 1)
    save(second, 1)
    save(first, 0)
    emitted = read_emissions(spark, str(tmp_path / "rows"), schema)
    assert emitted.count() == 3
    assert {r.zone_id: r.trip_count for r in current_rows(emitted, KEYS).collect()} == {"A": 5, "B": 1}


def test_processing_time_counts_every_trip(spark, sf_dir, files, tmp_path):
    rows = stream_zone_windows(with_processing_time(stream(spark, files)))
    drain(spark, rows, tmp_path)
    emitted = current_rows(read_emissions(spark, f"{tmp_path}/rows", rows.schema), KEYS)
    known = read_sample_trips(spark, sf_dir, coarse_zones=True).filter("pickup_zone IS NOT NULL")
    assert emitted.agg(F.sum("trip_count")).first()[0] == known.count()
    assert emitted.filter("window_end != window_start + INTERVAL 1 MINUTE").count() == 0


def test_messages_to_windows_and_rejects(spark, files, sf_dir, tmp_path):
    texts = as_messages(replay_stream(spark, files, EVENTS_SCHEMA, files_per_trigger=2)).select("value")
    windows = live.start_windows(
        texts, f"{tmp_path}/windows", f"{tmp_path}/c1", "1 hour", "tpep_pickup_datetime", "1 hour", None
    )
    windows.awaitTermination()
    live.start_rejects(texts, f"{tmp_path}/rejects", f"{tmp_path}/c2", None).awaitTermination()

    table = as_messages(read_events(spark, sf_dir))
    parsed = parse_messages(table.select("value"))
    expected = zone_window_stats(usable(parsed), "1 hour")
    emitted = read_emissions(spark, f"{tmp_path}/windows", expected.schema)
    assert same(current_rows(emitted, KEYS).drop("window_date"), expected)
    cut = table.filter("trip_id % 101 = 0").count()
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == cut > 0


def test_processing_time_state_is_released(spark, tmp_path):
    folder = tmp_path / "in"
    for zone in ("A", "B", "C"):
        trip_file(spark, folder, (0, zone, 1.0))
    trips = replay_stream(spark, str(folder), TRIP, files_per_trigger=1)
    # One-millisecond windows end at once, so a later batch finds them closed.
    rows = stream_zone_windows(with_processing_time(trips, "0 seconds"), "1 millisecond")
    query = drain(spark, rows, tmp_path)
    states = [p["stateOperators"][0] for p in query.recentProgress]
    assert sum(s["numRowsRemoved"] for s in states) > 0
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0
    emitted = read_emissions(spark, f"{tmp_path}/rows", rows.schema)
    assert current_rows(emitted, KEYS).agg(F.sum("trip_count")).first()[0] == 3


def test_live_job_from_the_command_line(spark, sf_dir, tmp_path):
    texts = as_messages(read_events(spark, sf_dir)).select("value")
    texts.repartition(3).write.text(f"{tmp_path}/in")
    options = "--master local[4] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4"
    subprocess.run(
        [sys.executable, "-m", "wayfare.plans.live", "--files", f"{tmp_path}/in", "--once",
         "--event-column", "tpep_pickup_datetime", "--width", "5 minutes", "--parallelism", "2",
         "--output", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/checkpoint"],
        cwd=ROOT,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": f"{options} pyspark-shell"},
        check=True,
        capture_output=True,
    )
    parsed = parse_messages(texts)
    expected = zone_window_stats(usable(parsed), "5 minutes")
    emitted = read_emissions(spark, f"{tmp_path}/out/windows", expected.schema)
    assert same(current_rows(emitted, KEYS).drop("window_date"), expected)
    assert same(spark.read.parquet(f"{tmp_path}/out/rejects"), rejected(parsed))
