"""Bringing a DataFrame to the columns of a serving table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.tables import Table


def _zero(field: T.StructField) -> str:
    zero = "0" if isinstance(field.dataType, T.NumericType) else "NULL"
    return f"CAST({zero} AS {field.dataType.simpleString()})"


def add_missing_columns(df: DataFrame, table: Table) -> DataFrame:
    """Columns the table has and the data lacks, filled with zero; table column order."""
    columns = []
    for f in table.schema.fields:
        given = f"CAST({f.name} AS {f.dataType.simpleString()})"
        columns.append(f"{given if f.name in df.columns else _zero(f)} AS {f.name}")
    return df.selectExpr(*columns)


def fill_defaults(df: DataFrame, table: Table) -> DataFrame:
    """Null measures become zero."""
    return df.selectExpr(
        *[
            f"coalesce({c}, {_zero(table.schema[c])}) AS {c}" if c in table.measures else f"`{c}`"
            for c in df.columns
        ]
    )


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())
