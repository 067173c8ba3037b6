"""Uniqueness at append against a full check, and what an append reads."""

import datetime as dt
import random

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from wayfare.operators import uniqueness as u
from wayfare.operators.quality import duplicate_keys

KEYS = ["date", "zone_id", "hour"]
SCHEMA = "date date, zone_id string, hour int, n long"


def some(spark, rng, rows, days=4):
    data = [
        (dt.date(2024, 1, 1 + rng.randrange(days)), rng.choice(["a", "b", None, "c"]), rng.choice([None, *range(24)]), k)
        for k in range(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def full_check(old, new):
    both = old.select(*KEYS).unionByName(new.select(*KEYS))
    return duplicate_keys(both, KEYS)


@pytest.mark.parametrize("bits", [64, 1 << 12, u.BITS])
def test_violations_equal_the_full_check(spark, tmp_path, bits):
    """Also with a filter so small that it knows nearly every key."""
    rng = random.Random(bits)
    path = str(tmp_path / "t")
    old = some(spark, rng, 300).dropDuplicates(KEYS).persist()
    new = some(spark, rng, 60, days=6).persist()
    u.append_unique(old, path, KEYS, bits=bits)
    got = u.violations(new, path, KEYS, "date", bits)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, full_check(old, new).collect()))
    assert got.count() > 5
    with pytest.raises(ValueError, match="would not be unique"):
        u.append_unique(new, path, KEYS, bits=bits)
    assert spark.read.parquet(f"{path}/rows").count() == old.count()


def test_a_clean_append_reads_no_data_file(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(5000).selectExpr("DATE'2024-01-01' AS date", "CAST(id AS STRING) AS zone_id", "1 AS hour", "id AS n")
    u.append_unique(rows, path, KEYS)
    read = []
    stored = u._stored
    monkeypatch.setattr(u, "_stored", lambda s, p: read.append(p.rsplit("/", 1)[1]) or stored(s, p))
    u.append_unique(rows.withColumn("hour", F.lit(2)), path, KEYS)
    assert read == ["filters"]
    assert spark.read.parquet(f"{path}/rows").count() == 10_000
    read.clear()
    assert u.violations(rows.limit(1), path, KEYS, "date").count() == 1
    assert read == ["filters", "rows"]


def test_only_partitions_of_known_keys_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rng = random.Random(1)
    old = some(spark, rng, 200).dropDuplicates(KEYS)
    u.append_unique(old, path, KEYS)
    one = spark.read.parquet(f"{path}/rows").where("date = DATE'2024-01-02'").limit(3)
    plan = plan_of(u.violations(one, path, KEYS, "date"))
    assert "2024-01-02" in plan.split("PartitionFilters: [", 1)[1].split("]")[0] or "PartitionFilters: [isnotnull(date" in plan


def test_a_lost_append_and_an_empty_one(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = some(spark, random.Random(2), 50).dropDuplicates(KEYS).persist()
    u.bloom_words(rows, KEYS, "date").write.partitionBy("date").parquet(f"{path}/filters")  # broke off here
    u.append_unique(rows, path, KEYS)
    u.append_unique(rows.where("n < 0"), path, KEYS)
    assert spark.read.parquet(f"{path}/rows").count() == rows.count()
