import datetime as dt

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from wayfare.operators.inventory import table_counts, table_inventory
from wayfare.operators.merge import (
    merge_insert_absent,
    merge_partial,
    merge_replace,
    one_per_key,
)
from wayfare.operators.migration import add_missing_columns, fill_defaults, stamped
from wayfare.operators.quality import constraint_report, duplicate_keys
from wayfare.tables import DAILY_SUMMARY, HOURLY_ZONE_STATS

COLUMNS = "k string, n bigint, a double, w string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("old", 1, 1.0, "t"), ("both", 2, 2.0, "t"), (None, 3, 3.0, "t")], COLUMNS)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([("both", 20, 20.0, "b"), ("new", 30, 30.0, "b"), (None, 40, 40.0, "b")], COLUMNS)


def rows(df):
    return {r.k: tuple(r)[1:] for r in df.collect()}


def test_insert_absent_leaves_the_target_alone(target, batch):
    merged = merge_insert_absent(target, batch, ["k"])
    assert rows(merged) == {
        "old": (1, 1.0, "t"),
        "both": (2, 2.0, "t"),
        None: (3, 3.0, "t"),
        "new": (30, 30.0, "b"),
    }


def test_full_replace(target, batch):
    assert rows(merge_replace(target, batch, ["k"])) == {
        "old": (1, 1.0, "t"),
        "both": (20, 20.0, "b"),
        None: (40, 40.0, "b"),
        "new": (30, 30.0, "b"),
    }


def test_full_replace_can_keep_columns(target, batch):
    merged = rows(merge_replace(target, batch, ["k"], keep=["w"]))
    assert merged["both"] == (20, 20.0, "t") and merged["new"] == (30, 30.0, "b")


def test_partial_replace_changes_only_listed_columns(target, batch):
    assert rows(merge_partial(target, batch, ["k"], ["n"])) == {
        "old": (1, 1.0, "t"),
        "both": (20, 2.0, "t"),
        None: (40, 3.0, "t"),
        "new": (30, 30.0, "b"),
    }


def test_partial_replace_takes_nulls_from_the_batch(spark, target):
    batch = spark.createDataFrame([("both", None, None, None)], COLUMNS)
    assert rows(merge_partial(target, batch, ["k"], ["n"]))["both"] == (None, 2.0, "t")


@pytest.mark.parametrize("mode", ["insert", "replace", "partial"])
def test_merging_twice_equals_merging_once(target, batch, mode):
    merge = {
        "insert": lambda t: merge_insert_absent(t, batch, ["k"]),
        "replace": lambda t: merge_replace(t, batch, ["k"]),
        "partial": lambda t: merge_partial(t, batch, ["k"], ["n"]),
    }[mode]
    once = merge(target)
    twice = merge(once)
    assert rows(twice) == rows(once) and twice.count() == once.count()


def test_last_and_first_of_repeated_keys(spark):
    df = spark.createDataFrame([("A", 1, 3), ("A", 2, 5), ("B", 1, 7), ("A", 2, 4)], "k string, seq int, n int")
    assert {r.k: r.n for r in one_per_key(df, ["k"], "seq").collect()} == {"A": 5, "B": 7}
    assert {r.k: r.n for r in one_per_key(df, ["k"], "seq", last=False).collect()} == {"A": 3, "B": 7}
    assert one_per_key(df, ["k"], "seq").columns == df.columns


def test_repeated_keys_collapse_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    plan = plan_of(one_per_key(df, ["k"], "id"))
    assert "partial_max" in plan


def test_merges_hold_no_forced_broadcast(target, batch):
    for df in (merge_replace(target, batch, ["k"]), merge_partial(target, batch, ["k"], ["n"])):
        assert "NestedLoop" not in plan_of(df) and "Cartesian" not in plan_of(df)


def test_constraint_report(spark):
    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame(
        [(day, 24, "A"), (day, 1, None), (day, 2, "B"), (day, 2, "B"), (day, 3, "z" * 51), (None, None, "C")],
        "date date, hour int, zone_id string",
    )
    report = {r.rule: r.violations for r in constraint_report(df, HOURLY_ZONE_STATS).collect()}
    assert report == {
        "unique_key": 1,
        "date_not_null": 1,
        "hour_not_null": 1,
        "zone_id_not_null": 1,
        "hour_between_0_and_23": 1,
        "zone_id_at_most_50_characters": 1,
    }
    empty = constraint_report(df.limit(0), HOURLY_ZONE_STATS).collect()
    assert {r.violations for r in empty} == {0} and len(empty) == 6


def test_constraint_report_scans_once(spark, tmp_path):
    path = str(tmp_path / "stats")
    schema = "date date, hour int, zone_id string, trip_count bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    plan = plan_of(constraint_report(spark.read.parquet(path), HOURLY_ZONE_STATS))
    assert plan.count("Location: ") == 1 and "trip_count" not in plan


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert duplicate_keys(df, ["k"]).collect() == [(1, 2)]


def test_migration_adds_missing_columns_with_zero(spark):
    old = spark.createDataFrame([(dt.date(2024, 1, 5), 3, None)], "date date, total_trips int, avg_fare double")
    new = add_missing_columns(old, DAILY_SUMMARY)
    assert new.schema.names == DAILY_SUMMARY.schema.names
    assert [f.dataType for f in new.schema] == [f.dataType for f in DAILY_SUMMARY.schema]
    row = new.first()
    assert (row.total_trips, row.avg_fare, row.cash_trips, row.max_fare) == (3, None, 0, 0.0)
    assert fill_defaults(new, DAILY_SUMMARY).first().avg_fare == 0.0
    assert add_missing_columns(new, DAILY_SUMMARY).collect() == new.collect()
    assert stamped(new).first().created_at is not None


def test_inventory(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 7),)], "date date")
    empty = days.limit(0)
    got = table_inventory({"b": (days, "date"), "a": (days, None), "e": (empty, "date")})
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("a", 2, "N/A", "N/A"),
        ("b", 2, "2024-01-05", "2024-01-07"),
        ("e", 0, None, None),
    ]
    assert table_counts({"b": days, "a": empty}).collect() == [("a", 0), ("b", 2)]
