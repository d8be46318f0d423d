"""Compare a query's rows with DuckDB's, whatever the order."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, float):
        return repr(round(value, 6))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def rows_of(table) -> list[tuple[str, ...]]:
    columns = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in columns]
    return sorted(tuple(map(normal, row)) for row in zip(*data))


def compare(result: DataFrame, connection, sql: str) -> str | None:
    """A description of the first difference, or None."""
    ours = result.toArrow()
    theirs = connection.execute(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"
    types = {n: (str(ours.schema.field(n).type), str(theirs.schema.field(n).type)) for n in ours.column_names}
    odd = {n: t for n, t in types.items() if t[0].replace("large_", "") != t[1].replace("large_", "")}
    if odd:
        return f"types differ: {odd}"
    left, right = rows_of(ours), rows_of(theirs)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{sorted(ours.column_names)}: {a} != {b}"
    return None
