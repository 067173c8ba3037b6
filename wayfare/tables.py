"""Input schemas and the serving tables: columns, keys, defaults and checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """A serving table. Keys may not be null; measures default to zero."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    required: tuple[str, ...]
    checks: dict[str, str] = field(default_factory=dict)  # rule name -> SQL predicate
    max_lengths: dict[str, int] = field(default_factory=dict)

    @property
    def measures(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.required]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(**columns: str) -> T.StructType:
    """Schema from column names and type names; needs no session, unlike DDL text."""
    return T.StructType([T.StructField(c, _TYPES[t]) for c, t in columns.items()])


# Column names and types of the historical trip files. Timestamps are
# zone-less in batch tables, so no result depends on the session zone.
TRIP_SCHEMA = struct(
    tpep_pickup_datetime="timestamp_ntz",
    tpep_dropoff_datetime="timestamp_ntz",
    passenger_count="bigint",
    trip_distance="double",
    PULocationID="bigint",
    DOLocationID="bigint",
    payment_type="bigint",
    fare_amount="double",
    total_amount="double",
    tip_amount="double",
)


# Partition column of landed raw trips: the date of the pickup.
LANDING_DATE = "pickup_date"

REAL_TIME_ZONES = Table(
    name="real_time_zones",
    schema=struct(
        zone_id="string",
        window_start="timestamp_ntz",
        window_end="timestamp_ntz",
        trip_count="bigint",
        total_revenue="double",
        avg_fare="double",
        avg_distance="double",
        avg_passengers="double",
        payment_cash_count="bigint",
        payment_credit_count="bigint",
    ),
    keys=("zone_id", "window_start"),
    required=("zone_id", "window_start", "window_end"),
    max_lengths={"zone_id": 50},
)

DAILY_SUMMARY = Table(
    name="daily_summary",
    schema=struct(
        date="date",
        total_trips="bigint",
        total_revenue="double",
        avg_fare="double",
        avg_distance="double",
        avg_duration_minutes="double",
        avg_passengers="double",
        credit_card_trips="bigint",
        cash_trips="bigint",
        avg_tip="double",
        max_fare="double",
        min_fare="double",
    ),
    keys=("date",),
    required=("date",),
)

HOURLY_ZONE_STATS = Table(
    name="hourly_zone_stats",
    schema=struct(
        date="date",
        hour="int",
        zone_id="string",
        trip_count="bigint",
        total_revenue="double",
        avg_fare="double",
        avg_distance="double",
        avg_duration="double",
        avg_passengers="double",
    ),
    keys=("date", "hour", "zone_id"),
    required=("date", "hour", "zone_id"),
    checks={"hour_between_0_and_23": "hour >= 0 AND hour <= 23"},
    max_lengths={"zone_id": 50},
)

ROUTE_ANALYSIS = Table(
    name="route_analysis",
    schema=struct(
        pickup_zone="string",
        dropoff_zone="string",
        route_count="bigint",
        avg_fare="double",
        avg_distance="double",
        avg_duration_minutes="double",
        total_revenue="double",
    ),
    keys=("pickup_zone", "dropoff_zone"),
    required=("pickup_zone", "dropoff_zone"),
    max_lengths={"pickup_zone": 50, "dropoff_zone": 50},
)

REAL_TIME_GLOBAL = Table(
    name="real_time_global",
    schema=struct(
        window_start="timestamp_ntz",
        window_end="timestamp_ntz",
        total_trips="bigint",
        total_revenue="double",
        avg_fare="double",
        avg_trip_distance="double",
        avg_passengers="double",
    ),
    keys=("window_start",),
    required=("window_start",),
)

TOP_ACTIVE_ZONES = Table(
    name="top_active_zones",
    schema=struct(
        update_time="timestamp_ntz",
        zone_id="string",
        zone_rank="int",
        trip_count="bigint",
        total_revenue="double",
    ),
    keys=("update_time", "zone_id"),
    required=("update_time", "zone_id"),
    max_lengths={"zone_id": 10},
)

TABLES = {
    t.name: t
    for t in (
        REAL_TIME_ZONES,
        DAILY_SUMMARY,
        HOURLY_ZONE_STATS,
        ROUTE_ANALYSIS,
        REAL_TIME_GLOBAL,
        TOP_ACTIVE_ZONES,
    )
}

# The narrower DECIMAL column types of the alternative table layout.
DECIMAL_TYPES = {
    "real_time_zones": {
        "total_revenue": "decimal(10,2)",
        "avg_fare": "decimal(8,2)",
        "avg_distance": "decimal(8,2)",
        "avg_passengers": "decimal(4,2)",
    },
    "real_time_global": {
        "total_revenue": "decimal(12,2)",
        "avg_fare": "decimal(8,2)",
        "avg_trip_distance": "decimal(8,2)",
        "avg_passengers": "decimal(4,2)",
    },
    "top_active_zones": {"total_revenue": "decimal(10,2)"},
    "daily_summary": {
        "total_revenue": "decimal(12,2)",
        "avg_fare": "decimal(8,2)",
        "avg_distance": "decimal(8,2)",
        "avg_duration_minutes": "decimal(8,2)",
        "avg_passengers": "decimal(4,2)",
    },
    "hourly_zone_stats": {
        "total_revenue": "decimal(10,2)",
        "avg_fare": "decimal(8,2)",
        "avg_distance": "decimal(8,2)",
    },
    "route_analysis": {
        "avg_fare": "decimal(8,2)",
        "avg_distance": "decimal(8,2)",
        "avg_duration_minutes": "decimal(8,2)",
        "total_revenue": "decimal(12,2)",
    },
}
