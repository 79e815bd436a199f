"""Side-by-side comparison of a registered query with its SQL twin."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else format(value + 0.0, ".9g")
    return str(value)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if columns and rows agree; otherwise a short description of what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(columns)}"]
    order = sorted(columns)
    expected = sorted(tuple(_norm(row[columns.index(c)]) for c in order) for row in result.fetchall())
    actual = sorted(tuple(_norm(row[c]) for c in order) for row in spark_df.collect())
    problems = []
    if not expected:
        problems.append("no rows")
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows against {len(expected)}")
    if actual != expected:
        missing = sorted(set(expected) - set(actual))[:2]
        extra = sorted(set(actual) - set(expected))[:2]
        problems.append(f"columns {order}: only in Spark {extra}, only in SQL {missing}")
    return problems
