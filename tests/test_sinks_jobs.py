import datetime as dt
import os
import subprocess
import sys

import pytest
from conftest import ROOT
from helpers import at, raw_trips, trips
from pyspark.sql import functions as F

from wayfare.operators.summaries import daily_summary, zone_window_stats
from wayfare.plans import batch, serving
from wayfare.session import build_session, new_workdir, shared_dir
from wayfare.sinks import jdbc
from wayfare.sinks.parquet import drop_old_months, write_by_date, write_by_month, write_partitioned, write_plain
from wayfare.sinks.report import preview, write_counted

DAYS = [{"pickup": at(f"2024-01-0{d}T10:00:00")} for d in (5, 5, 6, 7)]


def test_append_doubles_and_replace_does_not(spark, tmp_path):
    days = daily_summary(trips(spark, *DAYS))
    for mode, rows in (("append", 6), ("replace", 3)):
        path = str(tmp_path / mode)
        write_by_date(days, path, mode)
        write_by_date(days, path, mode)
        assert spark.read.parquet(path).count() == rows


def test_replace_touches_only_the_dates_present(spark, tmp_path):
    path = str(tmp_path / "t")
    write_by_date(daily_summary(trips(spark, *DAYS)), path, "replace")
    write_by_date(daily_summary(trips(spark, DAYS[2], DAYS[2], DAYS[2])), path, "replace")
    stored = {r.date.day: r.total_trips for r in spark.read.parquet(path).collect()}
    assert stored == {5: 2, 6: 3, 7: 1}
    assert "date=2024-01-06" in {p.name for p in (tmp_path / "t").iterdir()}


def test_a_hot_date_is_split_over_files(spark, tmp_path):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "2024-01-05").otherwise(
            F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0"))
        ).cast("date").alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        write_by_date(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "t" / "date=2024-01-05").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100_000


def test_month_folders_and_compression(spark, tmp_path):
    df = zone_window_stats(trips(spark, *DAYS, {"pickup": at("2024-02-01T00:00:00")}))
    write_by_month(df, str(tmp_path / "w"))
    assert {p.name for p in (tmp_path / "w").iterdir() if p.is_dir()} == {"month=2024-01", "month=2024-02"}
    write_plain(df, str(tmp_path / "p"))
    assert list((tmp_path / "p").glob("*.snappy.parquet"))


def test_records_per_file(spark, tmp_path):
    df = spark.range(100).withColumn("date", F.lit("2024-01-05").cast("date"))
    write_partitioned(df, str(tmp_path / "t"), max_records_per_file=10)
    assert len(list((tmp_path / "t" / "date=2024-01-05").glob("*.parquet"))) >= 10


def test_clustered_input_is_not_shuffled(spark, tmp_path):
    days = [spark.range(50).withColumn("date", F.lit(f"2024-01-0{d}").cast("date")).coalesce(1) for d in (5, 6)]
    write_partitioned(days[0].unionByName(days[1]), str(tmp_path / "t"), clustered=True)
    for day in ("date=2024-01-05", "date=2024-01-06"):
        assert len(list((tmp_path / "t" / day).glob("*.parquet"))) == 1


def test_rows_are_counted_while_writing(spark, tmp_path):
    days = daily_summary(trips(spark, *DAYS))
    assert write_counted(days, lambda df: write_plain(df, str(tmp_path / "t"))) == 3
    preview(days, 2)


class RecordingWriter:
    """Stands in for a DataFrame at the JDBC border: no database takes part in the tests."""

    columns = ["date", "total_trips"]

    def __init__(self):
        self.calls = []

    def repartition(self, number):
        self.calls.append(number)
        return self

    @property
    def write(self):
        return self

    def jdbc(self, url, table, mode, properties):
        self.calls.append((url, table, mode, properties))


def test_jdbc_append_policy():
    df, target = RecordingWriter(), jdbc.JdbcTarget("jdbc:x", {"user": "u"})
    jdbc.append(df, "daily_summary", target)
    connections, (url, table, mode, properties) = df.calls
    assert connections == 4 and (url, table, mode) == ("jdbc:x", "daily_summary", "append")
    assert properties == {"user": "u", "batchsize": "10000", "reWriteBatchedInserts": "true"}


def test_jdbc_upsert_stages_then_merges():
    df, run = RecordingWriter(), []
    target = jdbc.JdbcTarget("jdbc:x", batch_size=100)
    jdbc.upsert(df, "daily_summary", target, ["date"], ["total_trips"], run.append)
    assert df.calls[1][1:3] == ("daily_summary_staging", "overwrite")
    assert df.calls[1][3]["truncate"] == "true" and df.calls[1][3]["batchsize"] == "100"
    assert run == [
        "INSERT INTO daily_summary (date, total_trips) SELECT date, total_trips "
        "FROM daily_summary_staging ON CONFLICT (date) DO UPDATE SET total_trips = EXCLUDED.total_trips"
    ]
    again = RecordingWriter()
    jdbc.upsert_writer("daily_summary", target, ["date"], ["total_trips"], run.append)(again, 7)
    assert again.calls == df.calls and run[0] == run[1]
    own = RecordingWriter()
    jdbc.upsert_writer("t", target, ["date"], ["total_trips"], run.append, "t_staging_live")(own, 1)
    assert own.calls[1][1] == "t_staging_live" and "FROM t_staging_live" in run[2]
    assert jdbc.upsert_statement("t", "s", ["k"], ["k"], []).endswith("ON CONFLICT (k) DO NOTHING")


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_trips(spark, *DAYS).write.parquet(path)
    return path


@pytest.mark.parametrize("table", sorted(batch.SUMMARIES))
def test_jobs_can_be_repeated(spark, tmp_path, landed, table):
    out = str(tmp_path / table)
    first = batch.run(spark, table, [landed], out)
    assert first == batch.run(spark, table, [landed], out) == spark.read.parquet(out).count() > 0


def test_job_for_one_day(spark, tmp_path, landed):
    out = str(tmp_path / "daily")
    batch.run(spark, "daily_summary", [landed], out)
    assert batch.run(spark, "daily_summary", [landed], out, "2024-01-05") == 1
    assert spark.read.parquet(out).count() == 3
    assert batch.run(spark, "hourly_zone_stats", [landed], str(tmp_path / "h"), "2024-01-05", merge_schemas=True) == 1


def test_job_without_input_rows_writes_nothing(spark, tmp_path, landed):
    out = tmp_path / "daily"
    assert batch.run(spark, "daily_summary", [landed], str(out), "2020-01-01") == 0
    assert not list(out.rglob("*.parquet"))


def test_routes_of_one_day_leave_the_other_days(spark, tmp_path, landed):
    out = str(tmp_path / "routes")
    batch.run(spark, "route_analysis", [landed], out)
    before = sorted(batch.read_stored(spark, "route_analysis", out).collect())
    batch.run(spark, "route_analysis", [landed], out, "2024-01-05")
    assert sorted(batch.read_stored(spark, "route_analysis", out).collect()) == before


def test_invalid_trips_are_set_apart_and_ranks_chosen(spark, tmp_path, landed):
    out, rejects = str(tmp_path / "hours"), str(tmp_path / "rejects")
    assert batch.run(spark, "daily_summary", [landed], str(tmp_path / "d"), rejects=rejects) >= 0
    assert "reject_reason" in spark.read.parquet(rejects).columns
    batch.run(spark, "top_active_zones", [landed], out, top=1)
    assert spark.read.parquet(out).agg({"zone_rank": "max"}).first()[0] == 1


def test_old_months_are_dropped(spark, tmp_path):
    path = str(tmp_path / "months")
    spark.sql(
        "SELECT explode(sequence(DATE'2023-11-05', DATE'2024-02-05', INTERVAL 1 MONTH)) AS d"
    ).selectExpr("CAST(d AS TIMESTAMP_NTZ) AS window_start", "1 AS n").transform(
        lambda df: write_by_month(df, path) or df
    )
    assert drop_old_months(spark, path, "2024-01") == 2
    assert spark.read.parquet(path).count() == 2
    assert drop_old_months(spark, path, "2024-01") == 0


def test_job_days():
    today = dt.date(2024, 3, 1)
    assert batch.parse_day(None, False, today) == dt.date(2024, 2, 29)
    assert batch.parse_day("2024-01-05", False, today) == dt.date(2024, 1, 5)
    assert batch.parse_day(None, True, today) is None


def test_stored_tables_answer_sql(spark, tmp_path, landed):
    base = str(tmp_path / "tables")
    for table in batch.SUMMARIES:
        batch.run(spark, table, [landed], f"{base}/{table}")
    serving.register_tables(spark, base)
    assert spark.sql("SELECT sum(total_trips) FROM daily_summary").first()[0] == 4
    assert spark.sql("SELECT max(zone_rank) FROM top_active_zones").first()[0] == 1
    serving.register_recent_view(spark, "2024-01-07 10:00:00")
    got = spark.sql("SELECT * FROM v_realtime_last_24h LIMIT 10").collect()
    assert [r.window_start.day for r in got] == [7, 6]
    serving.register_recent_view(spark)
    assert spark.sql("SELECT count(*) FROM v_realtime_last_24h").first()[0] == 0


class FakeSession:
    """A session seen through its settings only."""

    def __init__(self, master, named=None):
        self.master, self.named, self.dir = master, named, None
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    one, two = new_workdir(spark, "x"), new_workdir(spark, "x")
    assert one != two and one.startswith(shared_dir(spark) + "/")
    assert shared_dir(FakeSession("yarn", "hdfs://shared/")) == "hdfs://shared"


def test_only_local_sessions_fall_back_to_a_local_folder():
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.dir


def test_jobs_share_the_running_session(spark):
    assert build_session("another job").sparkContext is spark.sparkContext


def test_batch_job_from_the_command_line(landed, tmp_path):
    out = tmp_path / "daily"
    command = [sys.executable, "-m", "wayfare.plans.batch", "daily_summary"]
    options = "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2"
    done = subprocess.run(
        [*command, "2024-01-05", "--input", landed, "--output", str(out)],
        cwd=ROOT,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": f"{options} pyspark-shell"},
        capture_output=True,
        text=True,
        check=True,
    )
    assert "daily_summary: 1 rows written for 2024-01-05" in done.stdout
    assert [p.name for p in out.iterdir() if p.is_dir()] == ["date=2024-01-05"]


def stored(spark, path, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*columns).collect())


def later(spark, tmp_path, name, *rows):
    path = str(tmp_path / name)
    raw_trips(spark, *rows).write.parquet(path)
    return path


@pytest.mark.parametrize("table, columns", [("daily_summary", ("date", "total_trips")), ("real_time_zones", ("window_start", "zone_id", "trip_count"))])
def test_runs_that_insert_only_what_is_absent(spark, tmp_path, landed, table, columns):
    out = str(tmp_path / table)
    batch.run(spark, table, [landed], out)
    before = stored(spark, out, *columns)
    new = later(spark, tmp_path, "new", DAYS[0], DAYS[0], {"pickup": at("2024-03-01 10:00:00")})
    batch.run(spark, table, [new], out, merge="insert-absent")
    after = stored(spark, out, *columns)
    assert set(before) < set(after) and len(after) == len(before) + 1
    batch.run(spark, table, [new], out, merge="insert-absent")
    assert stored(spark, out, *columns) == after


def test_runs_that_replace_some_columns(spark, tmp_path, landed):
    out = str(tmp_path / "daily")
    batch.run(spark, "daily_summary", [landed], out)
    before = {r.date: r for r in spark.read.parquet(out).collect()}
    day = DAYS[0]["pickup"].date()
    new = later(spark, tmp_path, "new", {"pickup": DAYS[0]["pickup"], "total": 1000.0})
    batch.run(spark, "daily_summary", [new], out, merge="partial", replace=["total_revenue"])
    after = {r.date: r for r in spark.read.parquet(out).collect()}
    assert after[day].total_revenue == 1000.0 and after[day].total_trips == before[day].total_trips
    assert {d: r for d, r in after.items() if d != day} == {d: r for d, r in before.items() if d != day}
    for replace in ([], ["nothing"], ["date"]):
        with pytest.raises(ValueError, match="columns to replace"):
            batch.run(spark, "daily_summary", [new], out, merge="partial", replace=replace)


def test_rows_are_stamped_with_the_time_of_the_run(spark, tmp_path, landed):
    out = str(tmp_path / "hours")
    begun = dt.datetime.now() - dt.timedelta(days=1)
    batch.run(spark, "hourly_zone_stats", [landed], out, created_at=True)
    times = {r.created_at for r in spark.read.parquet(out).collect()}
    assert len(times) == 1 and times.pop() > begun


def test_routes_of_a_day_are_not_appended_over_jdbc(spark, landed):
    with pytest.raises(ValueError, match="no date in its key"):
        batch.run(spark, "route_analysis", [landed], day="2024-01-05", target=jdbc.JdbcTarget("jdbc:x"))


@pytest.mark.parametrize("table", ["daily_summary", "real_time_global"])
def test_old_dates_are_removed_after_a_run(spark, tmp_path, landed, table):
    out = str(tmp_path / table)
    batch.run(spark, table, [landed], out)
    dates = sorted({d["pickup"].date() for d in DAYS})
    assert batch.drop_old_dates(spark, table, out, dates[-1] + dt.timedelta(days=7), 7) == len(dates) - 1
    column = batch.PARTITIONS.get(table, "date")
    assert [r[0] for r in spark.read.parquet(out).select(column).distinct().collect()] == [dates[-1]]
