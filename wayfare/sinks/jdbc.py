"""Writing summaries to a relational table over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Connection and write policy. ``connections`` bounds the number of writer tasks."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    batch_size: int = 10_000
    connections: int = 4

    def write_properties(self) -> dict[str, str]:
        return {
            **self.properties,
            "batchsize": str(self.batch_size),
            "reWriteBatchedInserts": "true",
        }


def _few_writers(df: DataFrame, target: JdbcTarget) -> DataFrame:
    # Not coalesce, which would pull the aggregation before it into as few tasks.
    return df.repartition(target.connections)


def append(df: DataFrame, table: str, target: JdbcTarget) -> None:
    """Insert all rows; a key that exists already is an error of the database."""
    _few_writers(df, target).write.jdbc(
        target.url, table, mode="append", properties=target.write_properties()
    )


def upsert_statement(
    table: str, staging: str, columns: Sequence[str], keys: Sequence[str], replace: Sequence[str]
) -> str:
    """SQL that moves staged rows into a table and replaces the listed columns on conflict."""
    names = ", ".join(columns)
    action = ", ".join(f"{c} = EXCLUDED.{c}" for c in replace)
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO "
        + (f"UPDATE SET {action}" if replace else "NOTHING")
    )


def upsert(
    df: DataFrame,
    table: str,
    target: JdbcTarget,
    keys: Sequence[str],
    replace: Sequence[str],
    execute: Callable[[str], None],
    staging: str | None = None,
) -> None:
    """Stage the rows in ``<table>_staging``, or a table named for the stream, then merge them
    in one statement.

    The staging table is emptied first, so a batch that is written again ends in the same
    state. ``execute`` runs the statement with the caller's database client; rows never
    pass through the driver.
    """
    staging = staging or f"{table}_staging"
    properties = {**target.write_properties(), "truncate": "true"}
    _few_writers(df, target).write.jdbc(
        target.url, staging, mode="overwrite", properties=properties
    )
    execute(upsert_statement(table, staging, df.columns, keys, replace))


def upsert_writer(
    table: str,
    target: JdbcTarget,
    keys: Sequence[str],
    replace: Sequence[str],
    execute: Callable[[str], None],
    staging: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts what a micro-batch emitted."""

    def save(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, table, target, keys, replace, execute, staging)

    return save


def run_statement(spark: SparkSession, target: JdbcTarget) -> Callable[[str], None]:
    """Runs a statement with the JDBC driver that the writers use, in a connection of its own."""

    def execute(statement: str) -> None:
        properties = spark._jvm.java.util.Properties()
        for name, value in target.properties.items():
            properties.setProperty(name, value)
        connection = spark._jvm.java.sql.DriverManager.getConnection(target.url, properties)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    return execute
