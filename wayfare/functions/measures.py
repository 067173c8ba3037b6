"""Measures that aggregate in mergeable parts.

A measure is a set of partial aggregates (sums, counts, extremes) and an expression that
turns them into its value. The parts of a fine grain can be stored and merged into any
coarser grain, and the same parts are what Spark combines map-side before a shuffle, so
one hot key costs one row per task.

Doubles are added as whole numbers: a value is split into its whole part and two groups of six
decimal digits, and each is summed. Whole numbers give the same total in every order of rows and
partitions, where doubles do not. Whole parts below 2^20 and the digits are summed as BIGINT, which
stays inside generated code and has room for 8 * 10^12 rows of a group; larger ones as decimals of 38
digits. Twelve digits after the point are kept, at any size of the value. Only what is not finite, or
above 2^92, is added as a plain double on the side.

Expressions are SQL text: one call to the JVM each, however long they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Factor under which a value is added, where that makes it a whole number: seconds for minutes.
PLAIN = 1
MINUTE_UNITS = 60

SMALL = "1048576D"  # 2^20
HIGH = "1099511627776"  # 2^40
LARGEST = "4951760157141521099596496896D"  # 2^92


@dataclass(frozen=True)
class Part:
    name: str
    build: str  # aggregate over rows
    merge: str = "sum"  # aggregate function over stored parts


@dataclass(frozen=True)
class Measure:
    name: str
    parts: tuple[Part, ...]
    value: str  # over the part columns


ROWS = Part("part_rows", "count(1)")


def _sum_parts(label: str, value: str, units: int) -> tuple[Part, ...]:
    value = f"CAST({value} AS DOUBLE)" + (f" * {units}" if units != 1 else "")
    high = f"CAST({value} / {HIGH}D AS BIGINT)"
    low = f"({value} - {high} * {HIGH}D)"
    whole = f"floor({low})"
    millionths = f"(({low} - {whole}) * 1e6D)"
    micro = f"floor({millionths})"
    pico = f"CAST(rint(({millionths} - {micro}) * 1e6D) AS BIGINT)"
    big = f"CAST({high} AS DECIMAL(16, 0)) * {HIGH} + CAST({whole} AS DECIMAL(14, 0))"
    fits = f"abs({value}) < {LARGEST}"
    is_small = f"abs({value}) < {SMALL}"
    return (
        Part(f"part_{label}_whole", f"sum(CASE WHEN {is_small} THEN {whole} END)"),
        Part(f"part_{label}_big", f"sum(CASE WHEN {fits} AND NOT ({is_small}) THEN {big} END)"),
        Part(f"part_{label}_micro", f"sum(CASE WHEN {fits} THEN {micro} END)"),
        Part(f"part_{label}_pico", f"sum(CASE WHEN {fits} THEN {pico} END)"),
        Part(f"part_{label}_rest", f"sum(CASE WHEN NOT ({fits}) THEN {value} END)"),
    )


def _sum_value(label: str, units: int) -> str:
    part = f"part_{label}"
    exact = f"coalesce({part}_whole, 0L) + {part}_micro * 0.000001 + {part}_pico * 0.000000000001"
    total = f"(CAST({exact} AS DOUBLE) + coalesce(CAST({part}_big AS DOUBLE), 0D))"
    total = f"coalesce({total} + {part}_rest, {total}, {part}_rest)"
    return f"({total} / {units}D)" if units != 1 else total


def rows(name: str) -> Measure:
    """Number of rows."""
    return Measure(name, (ROWS,), ROWS.name)


def matches(name: str, condition: str) -> Measure:
    """Number of rows for which the condition is true."""
    part = Part(f"part_{name}", f"count_if({condition})")
    return Measure(name, (part,), part.name)


def total(name: str, column: str, units: int = PLAIN, nulls: str = "skip") -> Measure:
    """Sum of a column; with ``nulls="zero"`` a group without values sums to zero."""
    value = _sum_value(column, units)
    if nulls == "zero":
        value = f"coalesce({value}, 0D)"
    return Measure(name, _sum_parts(column, column, units), value)


def mean(name: str, column: str, units: int = PLAIN, nulls: str = "skip") -> Measure:
    """Mean of a column.

    ``nulls="skip"`` divides by the number of values and is null without any;
    ``nulls="zero"`` counts a missing value as zero and divides by the number of rows.
    """
    sums, value = _sum_parts(column, column, units), _sum_value(column, units)
    if nulls == "zero":
        by_rows = f"CASE WHEN {ROWS.name} > 0 THEN coalesce({value}, 0D) / {ROWS.name} ELSE 0D END"
        return Measure(name, (*sums, ROWS), by_rows)
    if nulls != "skip":
        raise ValueError(f"unknown null policy: {nulls}")
    count = Part(f"part_{column}_count", f"count({column})")
    by_values = f"CASE WHEN {count.name} > 0 THEN {value} / {count.name} END"
    return Measure(name, (*sums, count), by_values)


def weighted_mean(name: str, column: str, weight: str, units: int = PLAIN) -> Measure:
    """Mean of stored means, each counting as often as the rows behind it."""
    label = f"{column}_by_{weight}"
    sums = _sum_parts(label, f"{column} * {weight}", units)
    weights = Part(f"part_{label}_weight", f"sum(CASE WHEN {column} IS NOT NULL THEN {weight} END)")
    value = f"CASE WHEN {weights.name} > 0 THEN {_sum_value(label, units)} / {weights.name} END"
    return Measure(name, (*sums, weights), value)


def summed(name: str, column: str) -> Measure:
    """Sum of a whole-number column."""
    part = Part(f"part_{column}_sum", f"sum({column})")
    return Measure(name, (part,), part.name)


def largest(name: str, column: str) -> Measure:
    part = Part(f"part_{column}_max", f"max({column})", "max")
    return Measure(name, (part,), part.name)


def smallest_positive(name: str, column: str) -> Measure:
    """Minimum over the values above zero; null when there is none."""
    build = f"min(CASE WHEN {column} > 0 THEN {column} END)"
    part = Part(f"part_{column}_min_positive", build, "min")
    return Measure(name, (part,), part.name)


def _parts(measures: Sequence[Measure]) -> list[Part]:
    return list({p.name: p for m in measures for p in m.parts}.values())


def partials(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row of parts per key, ready to be stored and merged later.

    Keys are SQL expressions, named with AS where they are not plain columns.
    """
    parts = [F.expr(f"{p.build} AS {p.name}") for p in _parts(measures)]
    return df.groupBy(*[F.expr(k) for k in keys]).agg(*parts)


def combine(parts: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Merge stored parts into a coarser grain."""
    merged = [F.expr(f"{p.merge}({p.name}) AS {p.name}") for p in _parts(measures)]
    return parts.groupBy(*[F.expr(k) for k in keys]).agg(*merged)


def finish(parts: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Turn parts into the values of the measures."""
    return parts.selectExpr(*keys, *[f"{m.value} AS {m.name}" for m in measures])
