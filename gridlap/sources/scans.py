"""Scans over stored cells and roll-ups. Filters on cycle, observable and time reach the files; columns are pruned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to_precision


def _of(round_id: str, observable_name: str | None = None) -> Column:
    wanted = F.col("round_id") == round_id
    return wanted if observable_name is None else wanted & (F.col("observable_name") == observable_name)


def cells_since(cells: DataFrame, round_id: str, observable_name: str, time) -> DataFrame:
    return cells.filter(_of(round_id, observable_name) & (F.col("time") > F.lit(time).cast("timestamp_ntz")))


def round_cells(cells: DataFrame, round_id: str, observable_name: str, round_number: int) -> DataFrame:
    wanted = _of(round_id, observable_name) & (F.col("round_number") == round_number) & (F.col("day_of_production") >= 0)
    return cells.filter(wanted).select("value", "time", "x", "y", "z", "round_id", "round_number", "observable_name")


def latest_cells(cells: DataFrame, round_id: str, observable_name: str, time) -> DataFrame:
    rows = cells_since(cells, round_id, observable_name, time).filter(F.col("day_of_production") >= 0)
    return rows.select("value", "time", "x", "y", "z", "round_id", "observable_name")


def placed_rows(over_time: DataFrame, round_id: str, observable_name: str, unit: str) -> DataFrame:
    """Roll-up rows with a coordinate, with the column that names their unit."""
    placed = over_time.filter(_of(round_id, observable_name) & (F.col("x") >= 0) & (F.col("y") >= 0))
    return placed.select("value", "time", "x", "y", "z", unit)


def unit_times(over_space: DataFrame, round_id: str, observable_name: str, unit: str) -> DataFrame:
    return over_space.filter(_of(round_id, observable_name)).select(unit, "time").distinct()


def with_precision(rows: DataFrame, observables: DataFrame, column: str = "value") -> DataFrame:
    """Round ``column`` to the digits set for each observable; rows without a setting stay as they are."""
    digits = observables.select(
        F.col("code_name").alias("observable_name"), F.col("observable_precision").alias("_precision")
    )
    rounded = F.when(F.col("_precision").isNull(), F.col(column)).otherwise(
        round_to_precision(F.col(column), F.col("_precision"))
    )
    return rows.join(digits, "observable_name", "left").withColumn(column, rounded).drop("_precision")
