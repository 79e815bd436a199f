"""Grid cells: mergeable partial aggregates of readings, and the values read from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..schemas import AMBIENT, ANOMALY, CELL_COLUMNS, CELL_KEY
from .laps import LapIndex
from .quality import check_files

# Per observable type: (sum of values, number of values) -> cell value.
_CELL_VALUES: dict[str, Callable[[Column, Column], Column]] = {}


def register_type(obs_type: str, value: Callable[[Column, Column], Column]) -> None:
    """Set how the cells of an observable type are valued."""
    _CELL_VALUES[obs_type] = value


register_type(AMBIENT, lambda total, n: F.try_divide(total, n))
register_type(ANOMALY, lambda total, n: F.coalesce(total, F.lit(0.0)))

_SUMS = ["value_sum", "value_count", "rows", "time_days", "time_seconds", "time_micros"]


def _reading_sums() -> list[Column]:
    parts = tp.time_parts(F.col("time"))
    return [
        F.sum("value").alias("value_sum"),
        F.count("value").alias("value_count"),
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(expr).alias(name) for name, expr in parts.items()],
        F.min("time").alias("first_time"),
    ]


def cell_partials(readings: DataFrame, files: DataFrame, index: LapIndex) -> DataFrame:
    """Sums per cell of accepted files.

    Readings are summed per (file, lap, square) before anything is shuffled by file: the as-of join is a map-side lookup, the
    file verdicts then join the sums, not the readings. A file, cycle or square that holds most of the readings arrives as a few
    rows per task.
    """
    placed = readings.filter("time IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    matched = index.match(placed)
    summed = matched.groupBy("file_id", "x", "y", "z", "round_number", "is_valid_round").agg(*_reading_sums())
    accepted = files.filter(F.col("verdict").isNull()).select(
        "file_id", "round_id", "observable_name", "obs_type", "file_round_number", "day_of_production"
    )
    joined = summed.join(accepted, "file_id", "inner")
    kept = joined.filter(F.col("file_round_number").isNotNull() | (F.col("is_valid_round") == 1))
    first = tp.order_key(F.col("first_time"), F.coalesce("day_of_production", F.lit(0)))
    return (
        kept.withColumn("round_number", F.coalesce("file_round_number", "round_number"))
        .withColumn("first_key", first)
        .groupBy(*CELL_KEY)
        .agg(*[F.sum(c).alias(c) for c in _SUMS], F.min("first_key").alias("first_key"))
    )


def merge_partials(*partials: DataFrame) -> DataFrame:
    """Stored and new partials as one: sums add up, so the result equals one pass over all readings."""
    merged = partials[0].select(*CELL_KEY, *_SUMS, "first_key")
    for p in partials[1:]:
        merged = merged.unionByName(p.select(*CELL_KEY, *_SUMS, "first_key"))
    return merged.groupBy(*CELL_KEY).agg(*[F.sum(c).alias(c) for c in _SUMS], F.min("first_key").alias("first_key"))


def finalise_cells(partials: DataFrame) -> DataFrame:
    """Cell rows from partials that are unique per cell.

    Value by type (mean or sum), time = mean time of the readings cut to the second, day of production of the earliest reading.
    """
    value = None
    for obs_type, formula in _CELL_VALUES.items():
        branch = formula(F.col("value_sum"), F.col("value_count"))
        matches = F.col("obs_type") == obs_type
        value = F.when(matches, branch) if value is None else value.when(matches, branch)
    time = tp.mean_time(F.col("time_days"), F.col("time_seconds"), F.col("time_micros"), F.col("rows"))
    return (
        partials.withColumn("value", value)
        .withColumn("time", time)
        .withColumn("day_of_production", tp.key_tie(F.col("first_key")))
        .select(*CELL_COLUMNS)
    )


def cells_of(readings: DataFrame, counter: DataFrame, cycles: DataFrame, robot_observable: DataFrame) -> DataFrame:
    """Cells of a batch of readings in one go."""
    index = LapIndex.build(counter)
    files = check_files(readings, index, cycles, robot_observable)
    return finalise_cells(cell_partials(readings, files, index))
