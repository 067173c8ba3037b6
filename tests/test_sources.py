import datetime as dt
import random

import pytest
from helpers import NOON, at, plan_of, raw_trips, trips
from pyspark.sql import functions as F

from wayfare.operators.filters import on_day
from wayfare.sources.footers import by_signature, footers, profile
from wayfare.sources.replay import limited_schedule
from wayfare.sources.trips import enrich, has_rows, read_trips, read_trips_merged
from wayfare.tables import TRIP_SCHEMA


def write(df, path):
    df.write.parquet(str(path))
    return str(path)


def test_reads_only_the_trip_columns(spark, tmp_path):
    path = write(raw_trips(spark, {}).withColumn("extra", F.lit(1)), tmp_path / "t")
    df = read_trips(spark, path)
    assert df.columns == TRIP_SCHEMA.names
    assert "extra" not in plan_of(df)


def test_zoned_timestamps_read_as_zone_less(spark, tmp_path):
    zoned = raw_trips(spark, {}).withColumn("tpep_pickup_datetime", F.lit("2024-01-05 12:00:00").cast("timestamp"))
    path = write(zoned, tmp_path / "t")
    assert read_trips(spark, path).first().tpep_pickup_datetime == NOON
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan_of(on_day(read_trips(spark, path), "2024-01-05"))


def test_columns_of_another_type_are_cast(spark, tmp_path):
    stored = raw_trips(spark, {"zone": 3}, {"zone": 4}).withColumns(
        {
            "passenger_count": F.lit(2.0),
            "PULocationID": F.when(F.col("PULocationID") == 3, "3").otherwise("x"),
            "payment_type": F.lit(1).cast("int"),
            "fare_amount": F.lit("12.5"),
            "trip_distance": F.lit(1.5).cast("float"),
        }
    )
    rows = read_trips(spark, write(stored, tmp_path / "t")).orderBy(F.asc_nulls_last("PULocationID")).collect()
    assert [r.PULocationID for r in rows] == [3, None]
    assert (rows[0].passenger_count, rows[0].payment_type, rows[0].fare_amount, rows[0].trip_distance) == (2, 1, 12.5, 1.5)


def test_missing_columns_are_null(spark, tmp_path):
    path = write(raw_trips(spark, {}).drop("tip_amount"), tmp_path / "t")
    assert read_trips(spark, path).first().tip_amount is None


def test_several_folders_with_different_types(spark, tmp_path):
    a = write(raw_trips(spark, {"passengers": 1}), tmp_path / "a")
    b = write(raw_trips(spark, {}).withColumn("passenger_count", F.lit(3.0)), tmp_path / "b")
    assert sorted(r.passenger_count for r in read_trips(spark, a, b).collect()) == [1, 3]


def test_merged_schemas_keep_every_column(spark, tmp_path):
    a = write(raw_trips(spark, {"zone": 1}), tmp_path / "a")
    b = write(raw_trips(spark, {"zone": 2}).withColumn("airport_fee", F.lit(1.75)), tmp_path / "b")
    rows = {r.PULocationID: r.airport_fee for r in read_trips_merged(spark, a, b).collect()}
    assert rows == {1: None, 2: 1.75}


def test_one_folder_of_files_with_several_types(spark, tmp_path):
    path = str(tmp_path / "mixed")
    for k, kind in enumerate(["bigint", "double", "bigint", "string", "double", "int"]):
        frame = raw_trips(spark, {"zone": k}).withColumn("passenger_count", F.lit(k).cast(kind))
        frame.withColumn("extra", F.lit(k).cast(kind)).write.mode("append").parquet(path)
    rows = read_trips(spark, path).collect()
    assert sorted((r.PULocationID, r.passenger_count) for r in rows) == [(k, k) for k in range(6)]
    merged = read_trips_merged(spark, path)
    assert dict(merged.dtypes)["extra"] == "string" and dict(merged.dtypes)["passenger_count"] == "bigint"
    assert sorted(float(r.extra) for r in merged.collect()) == [float(k) for k in range(6)]


def test_enrich_renames_only_what_is_there(spark):
    df = raw_trips(spark, {"zone": 12})
    assert enrich(df).first().pickup_zone == "12"
    renamed = df.withColumnRenamed("PULocationID", "pickup_zone")
    assert enrich(renamed).first().pickup_zone == "12"
    assert "dropoff_zone" not in enrich(df.drop("DOLocationID")).columns


def test_given_duration_is_kept(spark):
    df = raw_trips(spark, {}).withColumn("duration_minutes", F.lit(99.5))
    assert enrich(df).first().duration_minutes == 99.5


def test_duration_uses_whole_seconds(spark):
    row = trips(spark, {"pickup": at("2024-01-05T23:59:59.999"), "dropoff": at("2024-01-06T00:00:59.001")}).first()
    assert row.duration_minutes == 1.0
    assert row.tpep_pickup_datetime.date() == dt.date(2024, 1, 5)




def test_has_rows(spark):
    df = raw_trips(spark, {})
    assert has_rows(df) and not has_rows(df.filter("false"))


def test_day_filter_prunes_date_folders(spark, tmp_path):
    from wayfare.sinks.parquet import land_by_date

    path = str(tmp_path / "landed")
    land_by_date(raw_trips(spark, {}, {"pickup": at("2024-01-06T08:00:00")}), path)
    day = on_day(spark.read.parquet(path), "2024-01-06")
    assert day.count() == 1
    plan = plan_of(day)
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan
    landed = on_day(enrich(read_trips(spark, path)), "2024-01-06")
    assert landed.count() == 1
    assert "PartitionFilters: [isnotnull(pickup_date" in plan_of(landed)
    assert read_trips(spark, path).columns == [*TRIP_SCHEMA.names, "pickup_date"]


def test_folders_of_different_types_stay_apart(spark, tmp_path):
    path = write(raw_trips(spark, {}), tmp_path / "t")
    assert plan_of(read_trips(spark, path)).count("Location: ") == 1
    mixed = write(raw_trips(spark, {}).withColumn("fare_amount", F.lit("1.5")), tmp_path / "u")
    assert sorted(r.fare_amount for r in read_trips(spark, path, mixed).collect()) == [1.5, 10.0]


@pytest.mark.parametrize("day,rows", [("2024-01-05", 1), (dt.date(2024, 1, 6), 1), (None, 2), ("2023-01-01", 0)])
def test_day_modes(spark, day, rows):
    df = trips(spark, {"pickup": at("2024-01-05T23:59:59.999999")}, {"pickup": at("2024-01-06T00:00:00")})
    assert on_day(df, day).count() == rows


def test_profiles(spark, tmp_path):
    from wayfare.operators.inventory import dataset_profile, file_profile

    df = raw_trips(spark, {}, {"pickup": at("2024-01-07T00:00:00")}, {"pickup": None})
    path = write(df.coalesce(1), tmp_path / "t")
    row = dataset_profile(read_trips(spark, path)).first()
    assert tuple(row) == (3, 10, NOON, at("2024-01-07T00:00:00"))
    (only,) = file_profile(spark.read.parquet(path)).collect()
    size = next((tmp_path / "t").glob("*.parquet")).stat().st_size
    assert (only.bytes, only.row_count) == (size, 3)


def queue(dues, per_second):
    """Plain sender: (due, key) in order, each sent when due or one slot after the one before."""
    free = None
    for due, key in sorted(dues, key=lambda d: (d[0], d[1] % 64, d[1])):
        sent = due * per_second if free is None else max(due * per_second, free)
        free = sent + 1_000_000
        yield key, sent // per_second


@pytest.mark.parametrize("per_second, speed", [(1, 1.0), (3, 1.0), (7, 10.0), (1000, 1000.0), (2, 0.1)])
def test_limited_schedule_is_a_queue(spark, per_second, speed):
    """Ties, bursts of a hundred records in a second, gaps of days, and a queue carried over midnight."""
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1, 23, 59, 0)
    offsets = [rng.choice([0, 30, 30, 59, 61, 90_000, 90_001, 300_000]) + rng.randint(0, 20) for _ in range(300)]
    offsets += [45] * 150 + [200_000] * 3
    data = [(k, start + dt.timedelta(seconds=s, milliseconds=300)) for k, s in enumerate(offsets)]
    trips = spark.createDataFrame(data + [(9999, None)], "trip_id long, tpep_pickup_datetime timestamp_ntz")
    got = limited_schedule(trips, "trip_id", per_second, speed).collect()
    first = min(offsets)
    dues = [(round((s - first) * 1_000_000 / speed), k) for k, s in enumerate(offsets)]
    assert {r.trip_id: r.due_micros for r in got} == {k: d for d, k in dues}
    assert {r.trip_id: r.sent_micros for r in got} == dict(queue(dues, per_second))


def test_limited_schedule_orders_counts_not_records(spark):
    """The only window without partitions is over days; records are ranked inside a turn of a time."""
    trips = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "trip_id long, tpep_pickup_datetime timestamp_ntz")
    plan = plan_of(limited_schedule(trips, "trip_id", 10))
    assert "RangePartitioning" not in plan and "rangepartitioning" not in plan
    assert plan.count("SinglePartition") >= 1 and "CartesianProduct" not in plan
    assert limited_schedule(trips.where("false"), "trip_id", 10).collect() == []


def jobs_of(spark, run):
    """How many jobs Spark starts for a call."""
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def alternating_files(spark, folder, n):
    """Files that change the type of one column from each to the next, of three kinds."""
    kinds = [F.lit(2.0), F.lit("2"), F.lit(2).cast("int")]
    for k, value in enumerate(kinds):
        rows = raw_trips(spark, *[{"zone": z} for z in range(3)]).withColumn("passenger_count", value)
        rows.coalesce(1).write.parquet(str(folder / f"kind-{k}"))
    (folder / "all").mkdir()
    for k in range(n):
        source = next((folder / f"kind-{k % 3}").glob("part-*.parquet"))
        (folder / "all" / f"part-{k:05d}.parquet").write_bytes(source.read_bytes())
    return str(folder / "all")


def test_jobs_go_with_types_not_with_files(spark, tmp_path):
    few, many = (tmp_path / name for name in ("few", "many"))
    few.mkdir(), many.mkdir()
    # Spark lists more than 32 files of a group in a job; both folders have more.
    small, large = alternating_files(spark, few, 120), alternating_files(spark, many, 1000)
    assert jobs_of(spark, lambda: read_trips(spark, large)) == jobs_of(spark, lambda: read_trips(spark, small)) < 12
    df = read_trips(spark, large)
    assert plan_of(df).count("Location: ") == 3
    assert df.count() == 3000 and {r.passenger_count for r in df.select("passenger_count").distinct().collect()} == {2}


def test_footers_tell_rows_and_bytes(spark, tmp_path):
    path = alternating_files(spark, tmp_path, 5)
    found = footers(spark, path).collect()
    sizes = {f.name: f.stat().st_size for f in (tmp_path / "all").glob("part-*.parquet")}
    assert {r.file_path.rsplit("/", 1)[1]: r.bytes for r in found} == sizes
    assert [r.row_count for r in found] == [3] * 5 and all(0 < r.column_bytes < r.bytes for r in found)
    summary = profile(footers(spark, path)).first()
    assert summary.asDict() == {
        "file_count": 5, "total_bytes": sum(sizes.values()), "largest_bytes": max(sizes.values()), "row_count": 15, "signatures": 3
    }


def test_stores_that_tasks_cannot_open(spark, tmp_path, monkeypatch):
    """Spark's own comparison of footers takes over, with the same result."""
    path = alternating_files(spark, tmp_path, 5)
    expected = sorted(read_trips(spark, path).collect())
    monkeypatch.setattr("wayfare.sources.trips.by_signature", lambda s, p: [(None, [f for _, own in by_signature(s, p) for f in own])])
    assert sorted(read_trips(spark, path).collect()) == expected and len(expected) == 15
    assert profile(footers(spark, path).withColumn("row_count", F.lit(None))).first().file_count == 5
