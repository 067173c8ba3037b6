"""Maintained roll-ups against full recomputation; what a late load touches."""

import datetime as dt

import pytest
from helpers import NOON, plan_of, trips
from pyspark.sql import functions as F

from wayfare.operators.summaries import zone_window_stats
from wayfare.plans import rollups


def day(k, **given):
    return {"pickup": NOON + dt.timedelta(days=k, minutes=given.pop("minute", 0)), **given}


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


def equals_recomputation(spark, base, loads):
    everything = loads[0]
    for other in loads[1:]:
        everything = everything.unionByName(other)
    for table, width in ((rollups.HOURS, "1 hour"), (rollups.DAYS, "1 day")):
        assert rows_of(rollups.windows(spark, base, table)) == rows_of(zone_window_stats(everything, width))


def files(base, table):
    return {f: f.stat().st_mtime_ns for f in (base / table).glob("*/part-*.parquet")}


@pytest.fixture
def base(tmp_path):
    return tmp_path / "rollups"


def test_a_late_load_touches_its_own_date(spark, base):
    first = trips(spark, *[day(k, zone=z, total=0.1 * z, minute=7 * z) for k in range(4) for z in (1, 2, 2, 3)])
    rollups.add_load(first, str(base), "a")
    assert len(rollups.refresh(spark, str(base))) == 4
    equals_recomputation(spark, str(base), [first])
    before = {t: files(base, t) for t in (rollups.HOURS, rollups.DAYS)}

    late = trips(spark, day(2, zone=2, total=0.7), day(2, zone=9, minute=90))
    rollups.add_load(late, str(base), "b")
    assert rollups.refresh(spark, str(base)) == ["2024-01-07"]
    equals_recomputation(spark, str(base), [first, late])
    for table, old in before.items():
        kept = {f for f, time in files(base, table).items() if old.get(f) == time}
        assert {f.parent.name for f in old.keys() - kept} == {"window_date=2024-01-07"}
    assert rollups.refresh(spark, str(base)) == []


def test_a_load_that_comes_again_replaces_itself(spark, base):
    first = trips(spark, day(0), day(1, zone=3), day(5, zone=4))
    rollups.add_load(first, str(base), "a")
    rollups.refresh(spark, str(base))
    other = trips(spark, day(0, zone=8))
    rollups.add_load(other, str(base), "b")
    rollups.refresh(spark, str(base))
    again = trips(spark, day(1, zone=3, total=99.0))  # without its trips of two dates
    rollups.add_load(again, str(base), "a")
    assert rollups.refresh(spark, str(base)) == ["2024-01-05", "2024-01-06", "2024-01-10"]
    equals_recomputation(spark, str(base), [again, other])


def test_a_refresh_that_broke_off_is_repeated(spark, base, monkeypatch):
    first = trips(spark, day(0), day(1))
    rollups.add_load(first, str(base), "a")
    write = rollups._write_dates

    def fail(rows, path, *partitions):
        if path.endswith((rollups.DAYS, rollups.RECORD)):
            raise RuntimeError("lost")
        write(rows, path, *partitions)

    with monkeypatch.context() as patch:
        patch.setattr(rollups, "_write_dates", fail)
        with pytest.raises(RuntimeError):
            rollups.refresh(spark, str(base))
    assert rollups.refresh(spark, str(base)) == ["2024-01-05", "2024-01-06"]
    equals_recomputation(spark, str(base), [first])


def test_only_dirty_parts_are_read(spark, base):
    rollups.add_load(trips(spark, *[day(k) for k in range(6)]), str(base), "a")
    plan = plan_of(rollups._dates_of(spark, f"{base}/{rollups.MINUTES}", ["2024-01-07"]))
    assert "PartitionFilters: [" in plan and "window_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rollups.dirty_dates(spark, str(base)) == [f"2024-01-{d:02d}" for d in range(5, 11)]


def test_unknown_zones_and_empty_loads(spark, base):
    rollups.add_load(trips(spark, day(0, zone=None), day(0)), str(base), "a")
    rollups.add_load(trips(spark, day(0)).where(F.lit(False)), str(base), "b")
    assert rollups.refresh(spark, str(base)) == ["2024-01-05"]
    assert rollups.windows(spark, str(base), rollups.DAYS).first().trip_count == 1
