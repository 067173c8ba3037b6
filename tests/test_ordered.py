"""First rows of ordered tables against a sort of everything, and the files that they read."""

import random

import pytest

from wayfare.sinks.ordered import first_rows, write_ordered

SCHEMA = "zone_id string, start int, trips long"
NEWEST, BUSIEST, OLDEST = ["-start", "-trips", "zone_id"], ["-trips", "-start", "zone_id"], ["start", "zone_id"]


def plain(rows, order, k):
    def key(row):
        out = []
        for c in order:
            value = row[["zone_id", "start", "trips"].index(c.removeprefix("-"))]
            out.append((value is None, -value if c.startswith("-") and value is not None else value or 0))
        return out

    return sorted(rows, key=key)[:k]


@pytest.mark.parametrize("order", [NEWEST, BUSIEST, OLDEST])
def test_first_rows_equal_a_sort(spark, tmp_path, order):
    """Ties in the first column, nulls, a value that a third of all rows have, more rows than there are."""
    rng = random.Random(1)
    rows = [(f"z{k}", rng.choice([7, 7, None, *range(50)]), rng.randrange(30)) for k in range(400)]
    path = str(tmp_path / "t")
    write_ordered(spark.createDataFrame(rows, SCHEMA), path, order, files=12)
    for k in (0, 1, 5, 37, 300, 399, 400, 1000):
        assert [tuple(r) for r in first_rows(spark, path, order, k).collect()] == plain(rows, order, k)


def test_few_files_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).selectExpr("CAST(id % 7 AS STRING) AS zone_id", "CAST(id AS INT) AS start", "id * 37 % 1000 AS trips")
    write_ordered(rows, path, NEWEST, files=20)
    first = first_rows(spark, path, NEWEST, 10)
    assert len(first.inputFiles()) == 1 and first.first().start == 19_999
    assert len(first_rows(spark, path, NEWEST, 1500).inputFiles()) <= 3
    # An order that the files do not follow is right as well, and reads more.
    assert first_rows(spark, path, BUSIEST, 5).collect() == rows.orderBy("trips", ascending=False).where("trips = 999").orderBy("start", ascending=False).limit(5).collect()


def test_replaced_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    some = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], SCHEMA)
    write_ordered(some, path, NEWEST)
    write_ordered(some.where("start = 1"), path, NEWEST)
    assert [r.zone_id for r in first_rows(spark, path, NEWEST, 5).collect()] == ["a"]
    write_ordered(some.where("start = 9"), path, NEWEST)
    assert first_rows(spark, path, NEWEST, 5).collect() == []
