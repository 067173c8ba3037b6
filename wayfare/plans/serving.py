"""Stored serving tables as SQL views.

``register_tables`` makes ``SELECT ... FROM real_time_zones`` and the like work on the
session; ``register_recent_view`` adds the view of the last 24 hours.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from wayfare.operators.filters import last_hours
from wayfare.operators.ranking import newest_first
from wayfare.operators.summaries import routes_from_parts
from wayfare.tables import TABLES

RECENT_VIEW = "v_realtime_last_24h"
_STORED_DATE = T.StructField("window_date", T.DateType())


def register_tables(spark: SparkSession, base: str, names: Iterable[str] = TABLES) -> None:
    """Temp views over ``<base>/<table>``, with the schema of the table."""
    for name in names:
        if name == "route_analysis":  # stored in parts for each date
            parts = spark.read.parquet(f"{base}/{name}")
            routes_from_parts(parts).createOrReplaceTempView(name)
            continue
        schema = TABLES[name].schema
        if "window_start" in schema.names or "update_time" in schema.names:
            schema = T.StructType([*schema.fields, _STORED_DATE])
        spark.read.schema(schema).parquet(f"{base}/{name}").createOrReplaceTempView(name)


def register_recent_view(spark: SparkSession, as_of: dt.datetime | str | None = None) -> None:
    """The windows of the 24 hours before ``as_of``, by default of each query's own time.

    Newest and busiest first, so that a LIMIT takes the latest rows; Spark drops the sort
    under an aggregate. A condition on the stored date goes along, so only the folders of
    the last days are read.
    """
    stored = spark.table("real_time_zones")
    if as_of is None:  # Spark puts the time in when a query on the view starts
        recent = stored.filter(
            "window_date >= date_sub(current_date(), 1)"
            " AND window_start >= localtimestamp() - INTERVAL 24 HOURS"
        )
    else:
        moment = dt.datetime.fromisoformat(str(as_of))
        first_date = (moment - dt.timedelta(hours=24)).date()
        recent = last_hours(stored.filter(f"window_date >= DATE '{first_date}'"), moment, 24)
    newest_first(recent.drop("window_date")).createOrReplaceTempView(RECENT_VIEW)
