"""Runs a query and its SQL on the same tables and compares the results."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)):
        return ("n", "nan" if isinstance(value, float) and math.isnan(value) else repr(float(value)))
    return ("z", "") if value is None else ("s", str(value))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def compare(spark, connection, folder, query, sql) -> str | None:
    """None when equal, else a description of the difference."""
    df = query(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows; {mine[:3]} vs {theirs[:3]}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(mine)} rows differ, first: {different[0]}"
    return None
