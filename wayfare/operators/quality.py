"""Key uniqueness and column constraints, reported instead of enforced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.tables import Table


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def row_rules(table: Table) -> dict[str, str]:
    """Rule name -> condition under which a row violates it."""
    rules = {f"{c}_not_null": f"{c} IS NULL" for c in table.required}
    rules |= {name: f"NOT ({check})" for name, check in table.checks.items()}
    rules |= {f"{c}_at_most_{n}_characters": f"length({c}) > {n}" for c, n in table.max_lengths.items()}
    return rules


def constraint_report(df: DataFrame, table: Table) -> DataFrame:
    """Violations per rule, zeros included, in one pass over the data.

    Rows are counted per key first; both the row rules and the key rule come out of that.
    A check that evaluates to null passes, as in SQL.
    """
    rules = row_rules(table)
    per_key = df.groupBy(*table.keys).agg(
        F.expr("count(1) AS _rows"),
        *[F.expr(f"count_if({broken}) AS {name}") for name, broken in rules.items()],
    )
    totals = per_key.agg(
        F.expr("count_if(_rows > 1) AS unique_key"),
        *[F.expr(f"coalesce(sum({name}), 0L) AS {name}") for name in rules],
    )
    pairs = [f"struct('{name}' AS rule, {name} AS violations)" for name in ("unique_key", *rules)]
    return totals.selectExpr(f"inline(array({', '.join(pairs)}))")
