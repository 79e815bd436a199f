"""Small hand-made frames."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from gridlap.schemas import DDL


def t(text: str) -> datetime:
    return datetime.fromisoformat(text if len(text) > 10 else f"{text} 00:00:00")


def counter(spark: SparkSession, *rows) -> DataFrame:
    """Rows of (round_id, time, round_number, is_valid_round)."""
    return spark.createDataFrame([(r, t(at), n, v) for r, at, n, v in rows], DDL["round_counter"])


def cycles(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame([(i, date.fromisoformat(d)) for i, d in rows], DDL["cycle"])


def sensors(spark: SparkSession, *rows) -> DataFrame:
    return spark.createDataFrame(list(rows), DDL["robot_observable"])


def readings(spark: SparkSession, rows, file_id="f", round_id="pc", robot="rb", observable="temperature", kind="ambient_condition"):
    """Rows of (time, x, y, value) or (time, x, y, value, file_id)."""
    data = [
        (r[4] if len(r) > 4 else file_id, round_id, robot, observable, observable, kind, 3, 3, t(r[0]) if r[0] else None, r[1], r[2], 0, r[3])
        for r in rows
    ]
    return spark.createDataFrame(data, DDL["reading"])


def cells(spark: SparkSession, rows, round_id="pc", observable="temperature", kind="ambient_condition"):
    """Rows of (x, y, round_number, value, time, day_of_production)."""
    data = [(x, y, 0, n, v, t(at), round_id, d, observable, kind) for x, y, n, v, at, d in rows]
    return spark.createDataFrame(data, DDL["cell"])


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples; floats to nine digits, since the last bits depend on the order of addition."""
    rows = [tuple(_plain(v) for v in r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple(str(v) for v in r))
