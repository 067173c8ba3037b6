"""Compare a registered query with its SQL equivalent, exactly."""

import glob
import os

import duckdb

TABLE_GLOB = "*.parquet"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, TABLE_GLOB)):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _type(arrow_type) -> str:
    text = str(arrow_type)
    return "timestamp[us]" if text.startswith("timestamp") else text


def difference(spark_df, db, sql: str) -> str | None:
    """What differs between the two results, or None when they are equal."""
    left = spark_df.toArrow()
    right = db.sql(sql).to_arrow_table()
    if sorted(left.column_names) != sorted(right.column_names):
        return f"columns {sorted(left.column_names)} vs {sorted(right.column_names)}"
    names = sorted(left.column_names)
    types = {n: (_type(left.schema.field(n).type), _type(right.schema.field(n).type)) for n in names}
    wrong = {n: t for n, t in types.items() if t[0] != t[1]}
    if wrong:
        return f"types {wrong}"
    if left.num_rows != right.num_rows:
        return f"rows {left.num_rows} vs {right.num_rows}"

    def rows(table):
        return sorted(map(repr, zip(*(table.column(n).to_pylist() for n in names))))

    a, b = rows(left), rows(right)
    unequal = [(x, y) for x, y in zip(a, b) if x != y]
    if unequal:
        return f"{names}: {len(unequal)} rows differ, first {unequal[0]}"
    return None
