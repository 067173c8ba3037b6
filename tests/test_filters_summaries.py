import datetime as dt
from collections import defaultdict

import pytest
from helpers import NOON, at, plan_of, trips
from pyspark.sql import functions as F

from wayfare.functions.numbers import as_decimals
from wayfare.functions.times import daypart, is_weekend
from wayfare.operators import ranking, summaries
from wayfare.operators.filters import (
    in_months,
    known_zone,
    last_hours,
    retained,
    split_invalid,
    until,
    with_reject_reason,
)
from wayfare.sources.replay import replay_schedule, select_period
from wayfare.sources.sample import read_sample_trips
from wayfare.tables import DECIMAL_TYPES, TABLES


def test_null_policies_differ_on_one_missing_fare(spark):
    df = trips(spark, {"fare": 10.0}, {"fare": None})
    assert summaries.zone_window_stats(df).first().avg_fare == 5.0
    assert summaries.zone_window_stats(df, nulls="skip").first().avg_fare == 10.0
    assert summaries.daily_summary(df).first().avg_fare == 10.0


def test_unknown_zones(spark):
    df = trips(spark, {"zone": None}, {"zone": 5}).unionByName(
        trips(spark, {"zone": 6}).withColumn("pickup_zone", F.lit(""))
    )
    assert [r.zone_id for r in summaries.zone_window_stats(df).collect()] == ["5"]
    assert known_zone(df).count() == 1
    assert {r.zone_id for r in summaries.hourly_zone_stats(df).collect()} == {None, "5", ""}


def test_extremes_are_over_the_total(spark):
    rows = [{"total": t, "fare": 1000.0} for t in (-5.0, 0.0, None, 7.0, 9.0)]
    row = summaries.daily_summary(trips(spark, *rows)).first()
    assert (row.min_fare, row.max_fare, row.total_revenue, row.total_trips) == (7.0, 9.0, 11.0, 5)
    row = summaries.daily_summary(trips(spark, {"total": -5.0}, {"total": 0.0})).first()
    assert (row.min_fare, row.max_fare) == (None, 0.0)


def test_daily_counts_payment_codes(spark):
    df = trips(spark, *[{"payment": p} for p in (1, 1, 2, 3, None)])
    row = summaries.daily_summary(df).first()
    assert (row.credit_card_trips, row.cash_trips) == (2, 1)


def test_day_belongs_to_the_pickup(spark):
    row = summaries.daily_summary(
        trips(spark, {"pickup": at("2024-01-05T23:59:59.999"), "dropoff": at("2024-01-06T00:30:00")})
    ).first()
    assert row.date == dt.date(2024, 1, 5)


def test_window_edges(spark):
    df = trips(
        spark,
        *[{"pickup": at(f"2024-01-05T12:{m}")} for m in ("00:00.000", "00:59.999", "01:00.000")],
    )
    rows = summaries.zone_window_stats(df).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.trip_count) for r in rows] == [
        (NOON, NOON + dt.timedelta(minutes=1), 2),
        (NOON + dt.timedelta(minutes=1), NOON + dt.timedelta(minutes=2), 1),
    ]


def test_zone_windows_add_up_to_global_windows(spark, sf_dir):
    df = read_sample_trips(spark, sf_dir, coarse_zones=True)
    per_zone = summaries.zone_window_stats(df, "1 hour")
    summed = per_zone.groupBy("window_start").agg(
        F.sum("trip_count").alias("n"), F.round(F.sum("total_revenue"), 4).alias("revenue")
    )
    whole = summaries.global_window_stats(df, "1 hour").select(
        "window_start", F.col("total_trips").alias("n"), F.round("total_revenue", 4).alias("revenue")
    )
    assert sorted(summed.collect()) == sorted(whole.collect())


def test_minute_parts_widen_to_the_direct_result(spark, sf_dir):
    df = read_sample_trips(spark, sf_dir, coarse_zones=True)
    for nulls in ("zero", "skip"):
        parts = summaries.zone_window_partials(df, "1 minute", nulls=nulls)
        for width in ("5 minutes", "1 hour", "1 day"):
            merged = summaries.widen_windows(parts, width, nulls)
            direct = summaries.zone_window_stats(df, width, nulls=nulls)
            assert sorted(map(repr, merged.collect())) == sorted(map(repr, direct.collect()))


def test_daily_summary_by_brute_force(spark, sf_dir):
    df = read_sample_trips(spark, sf_dir)
    days = defaultdict(list)
    for r in df.collect():
        days[r.tpep_pickup_datetime.date()].append(r)
    for got in summaries.daily_summary(df).collect():
        rows = days.pop(got.date)
        known = [r.passenger_count for r in rows if r.passenger_count is not None]
        assert got.total_trips == len(rows)
        assert got.total_revenue == pytest.approx(sum(r.total_amount for r in rows))
        assert got.avg_passengers == sum(known) / len(known)
        assert got.avg_duration_minutes == pytest.approx(sum(r.duration_minutes for r in rows) / len(rows))
        assert got.max_fare == max(r.total_amount for r in rows)
        assert got.min_fare == min(r.total_amount for r in rows if r.total_amount > 0)
        assert got.cash_trips == sum(r.payment_type == 2 for r in rows)
    assert not days


def test_outputs_have_the_columns_of_their_tables(spark, sf_dir):
    from wayfare.plans.batch import SUMMARIES

    df = read_sample_trips(spark, sf_dir)
    for name, summary in SUMMARIES.items():
        got = [(f.name, f.dataType) for f in summary(df).schema.fields]
        assert sorted(got, key=str) == sorted(((f.name, f.dataType) for f in TABLES[name].schema.fields), key=str)
        empty = summary(df.limit(0))
        assert empty.schema == summary(df).schema and empty.count() == 0


def test_self_routes_are_an_option(spark):
    df = trips(spark, {"zone": 1, "to": 1}, {"zone": 1, "to": 2}, {"zone": None, "to": 2})
    assert summaries.route_analysis(df).count() == 3
    kept = summaries.route_analysis(df, self_routes=False)
    assert {(r.pickup_zone, r.dropoff_zone) for r in kept.collect()} == {("1", "2"), (None, "2")}


def test_rules_report_the_first_broken_one(spark):
    cases = {
        None: {},
        "missing_pickup_time": {"pickup": None, "dropoff": NOON, "fare": -1.0},
        "missing_dropoff_time": {"dropoff": None},
        "dropoff_before_pickup": {"dropoff": NOON - dt.timedelta(seconds=1), "distance": 0.0},
        "distance_not_positive": {"distance": 0.0},
        "fare_not_positive": {"fare": None},
        "total_not_positive": {"total": -1.0},
        "passengers_out_of_range": {"passengers": 7},
        "pickup_zone_out_of_range": {"zone": 266},
        "dropoff_zone_out_of_range": {"to": 0},
    }
    df = trips(spark, *cases.values())
    assert [r.reject_reason for r in with_reject_reason(df).collect()] == list(cases)
    valid, rejects = split_invalid(df)
    assert (valid.count(), rejects.count()) == (1, len(cases) - 1)
    assert "reject_reason" not in valid.columns
    assert split_invalid(df, zone_range=None)[0].count() == 3


def test_recent_and_retained(spark):
    hours = (0, 23, 24, 25, 24 * 7, 24 * 7 + 1)
    df = spark.createDataFrame([(h, NOON - dt.timedelta(hours=h)) for h in hours], "h int, window_start timestamp_ntz")
    assert [r.h for r in last_hours(df, NOON, 24).collect()] == [0, 23, 24]
    assert [r.h for r in retained(df, str(NOON)).collect()] == [0, 23, 24, 25, 168]
    assert [r.h for r in until(df, "window_start", NOON).collect()] == [23, 24, 25, 168, 169]


def test_months(spark):
    moments = ["2023-12-31T23:59:59.999999", "2024-01-01T00:00:00", "2024-01-31T23:59:59", "2024-02-01T00:00:00"]
    df = trips(spark, *[{"pickup": at(t)} for t in moments])
    assert in_months(df, ["2024-01"]).count() == 2
    assert in_months(df, ["2023-12", "2024-02"]).count() == 2
    assert in_months(df, []).count() == 4
    assert select_period(df, ["2024-01"], "2024-01-15 00:00:00").count() == 1


def test_replay_is_due_after_scaled_time(spark):
    df = trips(spark, {}, {"pickup": NOON + dt.timedelta(days=1)})
    due = [r.due_seconds for r in replay_schedule(df, 1000).orderBy("due_seconds").collect()]
    assert due == [0.0, 86.4]
    plan = plan_of(replay_schedule(df))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_dayparts(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    parts = {r[0]: r[1] for r in df.select("h", daypart(F.col("h"))).collect()}
    assert [h for h in parts if parts[h] == "peak"] == [8, 9, 17, 18, 19]
    assert [h for h in parts if parts[h] == "night"] == [1, 2, 3, 4, 5]
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-07')) AS d")
    assert [r[0] for r in days.select(is_weekend(F.col("d"))).collect()] == [False] * 5 + [True] * 2


def test_daypart_profile_weights_by_trips(spark):
    hourly = spark.createDataFrame(
        [
            (dt.date(2024, 1, 5), 8, "A", 1, 10.0, 10.0, 1.0, 5.0, 1.0),
            (dt.date(2024, 1, 5), 9, "A", 3, 60.0, 20.0, 1.0, 5.0, 1.0),
            (dt.date(2024, 1, 6), 8, "A", 2, 8.0, None, None, None, None),
        ],
        TABLES["hourly_zone_stats"].schema,
    )
    rows = {r.is_weekend: r for r in summaries.daypart_profile(hourly).collect()}
    assert (rows[False].trip_count, rows[False].total_revenue, rows[False].avg_fare) == (4, 70.0, 17.5)
    assert (rows[True].trip_count, rows[True].avg_fare) == (2, None)


WINDOWS = "zone_id string, window_start timestamp_ntz, trip_count bigint, total_revenue double"


def test_ties_rank_the_lower_zone_first(spark):
    df = spark.createDataFrame([("B", NOON, 3, 1.0), ("A", NOON, 3, 2.0), ("C", NOON, 9, 0.0)], WINDOWS)
    ranked = ranking.top_active_zones(df, 2).orderBy("zone_rank").collect()
    assert [(r.zone_rank, r.zone_id) for r in ranked] == [(1, "C"), (2, "A")]
    assert [r.zone_id for r in ranking.top_zones(df, 2).collect()] == ["C", "A"]
    assert [r.zone_id for r in ranking.newest_first(df).collect()] == ["C", "A", "B"]
    assert [r.zone_id for r in ranking.latest_windows(df, 1).collect()] == ["C"]
    assert [r.zone_id for r in ranking.busiest_windows(df, 2).collect()] == ["C", "A"]


def test_ranking_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([("B", NOON, 3, 1.0)], WINDOWS)
    plan = plan_of(ranking.top_active_zones(df, 5))
    assert plan.count("WindowGroupLimit") >= 2
    assert "TakeOrderedAndProject" in plan_of(ranking.latest_windows(df, 10))


def test_orders(spark, sf_dir):
    df = read_sample_trips(spark, sf_dir, coarse_zones=True)
    days = [r.date for r in ranking.by_date(summaries.daily_summary(df)).collect()]
    assert days == sorted(days)
    hourly = summaries.hourly_zone_stats(df).filter("zone_id IS NOT NULL")
    got = [(r.date, r.hour, -r.trip_count, r.zone_id) for r in ranking.by_hour(hourly).collect()]
    assert got == sorted(got)


def test_revenue_series_and_rebucket(spark):
    five = dt.timedelta(minutes=5)
    df = spark.createDataFrame(
        [("A", NOON, 1, 0.1), ("B", NOON, 2, 0.2), ("A", NOON + dt.timedelta(minutes=4), 4, 1.0), ("A", NOON + five, 8, 1.0)],
        WINDOWS,
    )
    series = {r.window_start: r.total_revenue for r in summaries.revenue_series(df).collect()}
    assert series[NOON] == 0.3
    buckets = sorted((r.window_start, r.window_end, r.trip_count) for r in summaries.rebucket(df).collect())
    assert buckets == [(NOON, NOON + five, 7), (NOON + five, NOON + 2 * five, 8)]


def test_decimal_columns_round_half_up(spark):
    df = spark.createDataFrame([(12.345, 2.675, -12.345)], "total_revenue double, avg_fare double, avg_distance double")
    row = as_decimals(df, DECIMAL_TYPES["daily_summary"]).first()
    assert [str(v) for v in row] == ["12.35", "2.68", "-12.35"]
