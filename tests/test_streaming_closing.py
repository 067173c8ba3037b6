"""Windows that close by themselves, rankings in state, late rows of long runs, folded emissions."""

import datetime as dt
import itertools

import pytest
from helpers import NOON
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_streaming import KEYS, TRIP, drain, same, trip_file

from wayfare.operators.ranking import top_active_zones
from wayfare.operators.summaries import zone_window_stats
from wayfare.plans import live
from wayfare.plans.queries import QUERIES
from wayfare.sources import sample
from wayfare.sources.replay import replay_stream
from wayfare.streaming import windows as sw
from wayfare.streaming.progress import late_rows
from wayfare.streaming.upsert import compact_emissions, current_rows, emission_writer, read_emissions, runs_to_fold, start_emissions
from wayfare.tables import struct

ROWS = struct(zone_id="string", window_start="timestamp_ntz", trip_count="bigint")


def test_a_silent_source_closes_its_windows(spark, tmp_path):
    folder = tmp_path / "in"
    trip_file(spark, folder, (0, "A", 1.0), (1, "B", 1.0), (2, "A", 1.0))
    trips = sw.with_heartbeats(replay_stream(spark, str(folder), TRIP), "0 seconds")
    rows = sw.stream_zone_windows(trips, "2 seconds")
    query = start_emissions(rows, f"{tmp_path}/rows", f"{tmp_path}/c", "append", interval="1 second", parallelism=2)
    stored = sw.wait_for_trips(query, lambda: read_emissions(spark, f"{tmp_path}/rows", rows.schema), 3, 120)
    assert {r.zone_id: r["sum(trip_count)"] for r in stored.groupBy("zone_id").sum("trip_count").collect()} == {"A": 2, "B": 1}
    assert not query.isActive


def test_heartbeats_alone_store_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    trip_file(spark, folder, (0, None, 1.0))
    trips = sw.with_heartbeats(replay_stream(spark, str(folder), TRIP), "0 seconds")
    rows = sw.stream_zone_windows(trips, "1 second")
    query = start_emissions(rows, f"{tmp_path}/rows", f"{tmp_path}/c", "append", interval="1 second", parallelism=2)
    with pytest.raises(TimeoutError):
        sw.wait_for_trips(query, lambda: read_emissions(spark, f"{tmp_path}/rows", rows.schema), 1, 12)


def test_top_zones_in_state(spark, tmp_path):
    """Ties, more zones than places, and several windows; the sentinels' own windows stay open."""
    folder = tmp_path / "in"
    for hour in range(3):
        rows = [(hour * 3600 + k, f"Z{k % 7}", float(k)) for k in range(20 + hour)]
        trip_file(spark, folder, *rows)
    trip_file(spark, folder, (100_000, "S", 0.0))
    trip_file(spark, folder, (200_000, "S", 0.0))
    trips = sw.with_event_time(replay_stream(spark, str(folder), TRIP, files_per_trigger=1))
    rows = sw.stream_top_zones(trips, 3)
    drain(spark, rows, tmp_path, output_mode="append", time="update_time", parallelism=2)
    emitted = read_emissions(spark, f"{tmp_path}/rows", rows.schema).drop("window_date", "emission")
    batch = spark.read.schema(TRIP).parquet(str(folder)).where("pickup_zone <> 'S'")
    expected = top_active_zones(zone_window_stats(batch, "1 hour"), 3)
    assert expected.count() == 9 and same(emitted, expected)


@pytest.mark.parametrize("name", ["stream_zone_window_append", "stream_top_zones"])
def test_nothing_is_filled_in_from_the_table(spark, sf_dir, name, monkeypatch):
    """A stream that reads nothing stores nothing, and the query has no other source."""
    read = sample.stream_events
    monkeypatch.setattr(sample, "stream_events", lambda *a, **k: read(*a, **k).where("event_id < 0"))
    try:
        assert QUERIES[name](spark, sf_dir).count() == 0
    except AnalysisException as error:
        assert "PATH_NOT_FOUND" in str(error.getCondition())


def test_late_rows_of_more_batches_than_a_query_remembers(spark, tmp_path):
    """Every second file is late; a query remembers a hundred reports."""
    folder = tmp_path / "in"
    trip_file(spark, folder, (0, "A", 1.0))
    one = next(folder.glob("part-*.parquet")).read_bytes()
    trip_file(spark, folder, (100_000, "B", 1.0))
    for k in range(118):
        (folder / f"part-late-{k:04d}.parquet").write_bytes(one)
    trips = sw.with_event_time(replay_stream(spark, str(folder), TRIP, files_per_trigger=1), delay="10 seconds")
    said = []
    with late_rows(spark, said.append) as late:
        query = drain(spark, sw.stream_zone_windows(trips), tmp_path, parallelism=1)
        total = late.total(query)
    remembered = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    emitted = current_rows(read_emissions(spark, f"{tmp_path}/rows", sw.stream_zone_windows(trips).schema), KEYS)
    windowed = emitted.agg(F.sum("trip_count")).first()[0]
    assert total + windowed == 120 and total > remembered
    assert len(said) == total


def batch_of(spark, k, zones=3):
    rows = [(f"Z{(k + z) % 5}", NOON + dt.timedelta(days=z % 2), 10 * k + z) for z in range(zones)]
    return spark.createDataFrame(rows, ROWS).coalesce(1)


def folders(path):
    return sorted(str(f.relative_to(path)) for f in path.glob("window_date=*/emission=*"))


def test_compaction_bounds_the_folders(spark, tmp_path):
    plain, folded = tmp_path / "plain", tmp_path / "folded"
    keep, fold = emission_writer(str(plain)), emission_writer(str(folded), keys=KEYS, compact_every=5)
    for k in range(40):
        keep(batch_of(spark, k), k)
        fold(batch_of(spark, k), k)
    assert len(folders(plain)) == 80 and len(folders(folded)) <= 2 * (8 + 5)
    rows = [current_rows(read_emissions(spark, str(p), ROWS), KEYS) for p in (plain, folded)]
    assert same(*rows)
    # The newest batch may come again.
    fold(batch_of(spark, 39), 39)
    assert same(rows[0], current_rows(read_emissions(spark, str(folded), ROWS), KEYS))


def test_a_compaction_that_broke_off_changes_nothing(spark, tmp_path, monkeypatch):
    """Between writing and removing, and when it is run again after that."""
    path = tmp_path / "rows"
    save = emission_writer(str(path))
    for k in range(20):
        save(batch_of(spark, k), k)
    expected = current_rows(read_emissions(spark, str(path), ROWS), KEYS).collect()
    with monkeypatch.context() as patch:
        patch.setattr("wayfare.streaming.upsert.remove_partitions", lambda *a: 0)
        compact_emissions(spark, str(path), ROWS, KEYS)
    assert len(folders(path)) == 40
    assert sorted(current_rows(read_emissions(spark, str(path), ROWS), KEYS).collect()) == sorted(expected)
    assert compact_emissions(spark, str(path), ROWS, KEYS) > 20
    assert sorted(current_rows(read_emissions(spark, str(path), ROWS), KEYS).collect()) == sorted(expected)


def test_runs_are_neighbours_and_few():
    sizes = [(e, 5_000) for e in range(500)]
    written = 0
    for end in range(2, 501):
        live = [s for s in sizes if s[0] < end]
        for run in runs_to_fold(live[:-1], 8):
            inside = [s for s in live if run[0] <= s[0] <= run[-1]]
            assert [e for e, _ in inside] == run
            written += sum(b for _, b in inside)
            sizes = [s for s in sizes if s[0] not in run]
            sizes = sorted([*sizes, (run[-1], sum(b for _, b in inside))])
        assert len([s for s in sizes if s[0] < end]) <= 32
    assert runs_to_fold([], 8) == [] == runs_to_fold([(1, 5), (9, 5)], 8)
    alternating = list(zip(itertools.count(), itertools.islice(itertools.cycle([10, 10**9]), 100)))
    assert len(alternating) - sum(len(r) - 1 for r in runs_to_fold(alternating, 8)) <= 32


def test_writers_go_with_the_rows_of_a_date(spark, tmp_path):
    rows = spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS zone_id", "TIMESTAMP_NTZ'2024-01-05 00:00:00' AS window_start", "id AS trip_count"
    )
    few = spark.createDataFrame([("A", NOON + dt.timedelta(days=5), 1)], ROWS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as it is inside a stateful stream
    try:
        emission_writer(str(tmp_path / "rows"), rows_per_writer=100)(rows.unionByName(few), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = {f.parent.parent.name: 0 for f in (tmp_path / "rows").glob("*/*/part-*.parquet")}
    for f in (tmp_path / "rows").glob("*/*/part-*.parquet"):
        files[f.parent.parent.name] += 1
    assert files["window_date=2024-01-10"] == 1 and 5 < files["window_date=2024-01-05"] <= 10


def test_closed_only_needs_a_clock():
    with pytest.raises(SystemExit):
        live.main(["--files", "x", "--once", "--closed-only", "--output", "o", "--checkpoint", "c"])
