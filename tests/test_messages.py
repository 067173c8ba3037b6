import json

import pytest
from helpers import at, plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wayfare.operators.summaries import zone_window_stats
from wayfare.sources.messages import (
    fail_on_rejects,
    kafka_options,
    parse_messages,
    rejected,
    usable,
    with_publish_fields,
)


def parse(spark, *texts):
    return parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))


def one(spark, **fields):
    return usable(parse(spark, json.dumps(fields))).first()


def test_all_fields(spark):
    row = one(
        spark,
        tpep_pickup_datetime="2024-01-05T12:00:00.123456",
        tpep_dropoff_datetime="2024-01-05T12:10:00",
        passenger_count=3,
        trip_distance=2.5,
        pickup_longitude=-73.985428,
        pickup_latitude=40.748817,
        dropoff_longitude=-73.98,
        dropoff_latitude=40.75,
        payment_type=1,
        fare_amount=10.5,
        total_amount=13,
        tip_amount=2.5,
        pickup_zone="zone_12_40",
        dropoff_zone="zone_1_2",
        duration_minutes=10.0,
        producer_timestamp="2024-01-05T12:11:00",
        unknown={"nested": [1, 2]},
    )
    assert row.tpep_pickup_datetime == at("2024-01-05T12:00:00.123456")
    assert row.producer_timestamp == at("2024-01-05T12:11:00")
    assert (row.passenger_count, row.trip_distance, row.total_amount) == (3, 2.5, 13.0)
    assert (row.pickup_longitude, row.pickup_latitude) == (-73.985428, 40.748817)
    assert (row.pickup_zone, row.dropoff_zone, row.duration_minutes) == ("zone_12_40", "zone_1_2", 10.0)
    assert row.is_credit and not row.is_cash


def test_time_aliases(spark):
    row = one(spark, pickup_datetime="2024-01-05T12:00:00", dropoff_datetime="2024-01-05T12:05:00")
    assert row.tpep_pickup_datetime == at("2024-01-05T12:00:00")
    assert row.tpep_dropoff_datetime == at("2024-01-05T12:05:00")


def test_missing_fields_are_null_and_bad_times_too(spark):
    row = one(spark, pickup_zone="A", tpep_pickup_datetime="yesterday")
    assert row.fare_amount is None and row.passenger_count is None
    assert row.tpep_pickup_datetime is None


@pytest.mark.parametrize(
    "payload,credit,cash",
    [
        ("1", True, False),
        ("2", False, True),
        ('"CREDIT"', True, False),
        ('"Credit"', True, False),
        ('"cash"', False, True),
        ('"1"', False, False),
        ("2.0", False, False),
        ("1e0", False, False),
        ("3", False, False),
        ("99999999999", False, False),
        ("true", False, False),
        ("null", False, False),
        ('{"code":1}', False, False),
        ('"credit card"', False, False),
    ],
)
def test_payment_payloads(spark, payload, credit, cash):
    row = usable(parse(spark, f'{{"payment_type":{payload}}}')).first()
    assert (row.is_credit, row.is_cash) == (credit, cash)


def test_missing_payment_is_neither(spark):
    row = one(spark, pickup_zone="A")
    assert (row.is_credit, row.is_cash) == (False, False)


@pytest.mark.parametrize(
    "text,reason",
    [
        ('{"pickup_zone":"A"', "malformed_json"),
        ("not json", "malformed_json"),
        ("[1]", "malformed_json"),
        ("null", "malformed_json"),
        ("5", "malformed_json"),
        ("{'pickup_zone':'A'}", "malformed_json"),
        ('{"fare_amount":NaN}', "malformed_json"),
        ("", "empty_message"),
        ("  ", "empty_message"),
        (None, "empty_message"),
        ('{"fare_amount":"ten"}', "bad_number"),
        ('{"passenger_count":true}', "bad_number"),
        ('{"passenger_count":3000000000}', "bad_number"),
        ('{"trip_distance":{"km":3}}', "bad_number"),
    ],
)
def test_rejects_carry_text_and_reason(spark, text, reason):
    parsed = parse(spark, text, '{"pickup_zone":"B"}')
    assert rejected(parsed).collect() == [(text, reason)]
    assert [r.pickup_zone for r in usable(parsed).collect()] == ["B"]


def test_numbers_in_quotes_and_empty_numbers(spark):
    row = one(spark, fare_amount="12.5", passenger_count="2", tip_amount="")
    assert (row.fare_amount, row.passenger_count, row.tip_amount) == (12.5, 2, None)
    assert one(spark, passenger_count=2.9).passenger_count == 2


def test_strict_mode_fails(spark):
    good = parse(spark, '{"pickup_zone":"A"}')
    assert fail_on_rejects(good).count() == 1
    with pytest.raises(PySparkException):
        fail_on_rejects(parse(spark, "{", '{"pickup_zone":"A"}')).collect()


def test_text_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.createDataFrame([('{"pickup_zone":"A"}',)], "value string").write.parquet(path)
    stats = zone_window_stats(usable(parse_messages(spark.read.parquet(path))))
    physical = plan_of(stats)
    assert physical.count("from_json(") == 1
    assert "Python" not in physical


def test_publish_fields(spark):
    df = with_publish_fields(spark.createDataFrame([("A",)], "pickup_zone string"))
    row = df.first()
    assert row.partition_key == "A" and row.producer_timestamp is not None
    assert "Exchange" not in plan_of(df)


def test_kafka_options():
    options = kafka_options("host:9092", "trips", "zones")
    assert options["subscribe"] == "trips" and options["startingOffsets"] == "latest"
    assert options["kafka.bootstrap.servers"] == "host:9092"


def test_rounding(spark):
    from wayfare.functions.numbers import rounded, zero_if_null

    df = spark.createDataFrame([(1.005, -73.98542849, None)], "fare_amount double, pickup_longitude double, tip_amount double")
    assert tuple(rounded(df).first()) == (1.01, -73.985428, None)
    assert zero_if_null(df).first().tip_amount == 0.0


@pytest.mark.parametrize(
    "lat,lon,zone",
    [
        (40.5, -74.3, "zone_0_0"),
        (40.509999, -74.290001, "zone_0_0"),
        (40.51, -74.29, "zone_1_1"),
        (40.57, -74.01, "zone_7_29"),
        (40.999999, -73.700001, "zone_49_59"),
        (41.0, -74.0, None),
        (40.6, -73.7, None),
        (40.499999, -74.0, None),
        (None, -74.0, None),
        (float("nan"), -74.0, None),
        (1e300, -74.0, None),
    ],
)
def test_grid_cells(spark, lat, lon, zone):
    from wayfare.functions.zones import grid_zone

    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.select(grid_zone(F.col("lat"), F.col("lon"))).first()[0] == zone
