"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(rows, names: list[str]) -> list[tuple]:
    """Rows as plain tuples, columns by name, in a fixed order."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)
