"""Hand-made trips. Missing fields are null unless a default is given."""

import datetime as dt

from wayfare.sources.trips import enrich
from wayfare.tables import TRIP_SCHEMA

NOON = dt.datetime(2024, 1, 5, 12, 0, 0)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def raw_trip(**given):
    pickup = given.pop("pickup", NOON)
    values = {
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": given.pop("dropoff", pickup and pickup + dt.timedelta(minutes=10)),
        "passenger_count": given.pop("passengers", 1),
        "trip_distance": given.pop("distance", 2.0),
        "PULocationID": given.pop("zone", 7),
        "DOLocationID": given.pop("to", 8),
        "payment_type": given.pop("payment", 1),
        "fare_amount": given.pop("fare", 10.0),
        "total_amount": given.pop("total", 12.0),
        "tip_amount": given.pop("tip", 2.0),
    }
    assert not given, given
    return tuple(values[c] for c in TRIP_SCHEMA.names)


def raw_trips(spark, *rows):
    return spark.createDataFrame([raw_trip(**r) for r in rows], TRIP_SCHEMA)


def trips(spark, *rows):
    return enrich(raw_trips(spark, *rows))


def plan_of(df) -> str:
    """Text of the physical plan, as EXPLAIN gives it."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
