"""Dense matrices of the roll-ups: one per unit, in long form, and packed as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.numbers import clamp_negative, round_half_even
from ..schemas import AMBIENT, SERIES_KEY
from .marks import KEY
from .quality import with_day_of_production

# Label formats.
DATE_LABEL = "dd-MM-yy"
DATE_TIME_LABEL = "dd-MM HH:mm"
HOURS_PER_DAY = 24


def with_dims(rows: DataFrame, dims: DataFrame) -> DataFrame:
    """Attach the largest x and y index of the cycle's grid (``dims``: round_id, x_dim, y_dim)."""
    return rows.join(dims.select("round_id", "x_dim", "y_dim"), "round_id")


def plot_cells(over_time: DataFrame, dims: DataFrame, unit: list[str], zero_is_missing: bool = False) -> DataFrame:
    """Newest value per square and unit, ready to plot: negatives become 0, three digits.

    Cycles and observables with a place outside the grid are left out whole (see ``alerts.coordinate_alerts``).
    """
    rows = with_dims(over_time.filter((F.col("x") >= 0) & (F.col("y") >= 0)), dims)
    outside = rows.filter((F.col("x") > F.col("x_dim")) | (F.col("y") > F.col("y_dim"))).select(*KEY).distinct()
    value = F.nullif(F.col("value"), F.lit(0.0)) if zero_is_missing else F.col("value")
    return (
        rows.join(outside, KEY, "left_anti")
        .withColumn("key", tp.order_key(F.col("time"), F.col("z")))
        .groupBy(*SERIES_KEY, *unit, "x_dim", "y_dim", "x", "y")
        .agg(F.max_by("value", "key").alias("value"))
        .withColumn("value", round_half_even(clamp_negative(value), 3))
    )


def _dense(rows: DataFrame, keys: list[str], height: Column, width: Column, row: Column, column: Column) -> DataFrame:
    """Matrix per group with NULL where no row exists.

    The rows of a group are distinct squares, so a group never exceeds ``height * width``. Every square is added once more as
    missing; after sorting, the first entry of each square is its value if there is one.
    """
    index = F.when(row.isNotNull(), row * width + column)
    entry = F.struct(index.alias("i"), F.lit(0).alias("missing"), F.col("value"))
    grouped = rows.withColumns({"_h": height, "_w": width, "_e": F.when(index.isNotNull(), entry)})
    grouped = grouped.groupBy(*keys, "_h", "_w").agg(F.collect_list("_e").alias("_entries"))
    blanks = "transform(sequence(0, _h * _w - 1), n -> named_struct('i', n, 'missing', 1, 'value', CAST(NULL AS DOUBLE)))"
    return (
        grouped.withColumn("_all", F.expr(f"array_sort(concat(_entries, {blanks}))"))
        .withColumn("_first", F.expr("filter(_all, (e, n) -> n = 0 OR _all[n - 1].i <> e.i)"))
        .withColumn("matrix", F.expr("transform(sequence(0, _h - 1), r -> slice(_first.value, r * _w + 1, _w))"))
        .drop("_h", "_w", "_entries", "_all", "_first")
    )


def unit_matrices(cells: DataFrame, units: DataFrame, unit: list[str], dims: DataFrame) -> DataFrame:
    """One matrix per row of ``units`` (SERIES_KEY + unit columns + time), blank where nothing was plotted."""
    keys = [*SERIES_KEY, *unit]
    plotted = cells.select(*keys, "x", "y", "value")
    rows = with_dims(units.select(*keys, "time"), dims).join(plotted, keys, "left")
    height, width = F.col("x_dim") + 1, F.col("y_dim") + 1
    return _dense(rows, [*keys, "time"], height, width, F.col("x"), F.col("y"))


def matrix_cells(matrices: DataFrame) -> DataFrame:
    """Long form of ``matrix``: one row per square, missing ones included."""
    keep = [c for c in matrices.columns if c != "matrix"]
    rows = matrices.select(*keep, F.posexplode("matrix").alias("x", "_row"))
    return rows.select(*keep, "x", F.posexplode("_row").alias("y", "value"))


# Units ---------------------------------------------------------------------------------------------------------------------


def latest_matrices(latest_over_time: DataFrame, dims: DataFrame, cycles: DataFrame) -> DataFrame:
    cells = plot_cells(latest_over_time, dims, [])
    plotted = latest_over_time.filter((F.col("x") >= 0) & (F.col("y") >= 0))
    units = plotted.groupBy(*SERIES_KEY).agg(F.max("time").alias("time")).join(
        cells.select(*KEY).distinct(), KEY, "left_semi"
    )
    rows = with_day_of_production(unit_matrices(cells, units, [], dims), cycles, "time")
    return rows.withColumn("label", F.date_format("time", DATE_LABEL)).withColumnRenamed("day_of_production", "day")


def round_matrices(round_over_time: DataFrame, round_over_space: DataFrame, dims: DataFrame, cycles: DataFrame) -> DataFrame:
    cells = plot_cells(round_over_time, dims, ["round_number"])
    units = round_over_space.join(cells.select(*KEY).distinct(), KEY, "left_semi")
    rows = with_day_of_production(unit_matrices(cells, units, ["round_number"], dims), cycles, "time")
    label = F.concat(
        F.lit("Round "), F.col("round_number").cast("string"), F.lit(" ("), F.date_format("time", DATE_TIME_LABEL), F.lit(")")
    )
    return rows.withColumn("label", label).withColumnRenamed("day_of_production", "day")


def day_matrices(day_over_time: DataFrame, day_over_space: DataFrame, dims: DataFrame) -> DataFrame:
    cells = plot_cells(day_over_time, dims, ["day"])
    units = day_over_space.join(cells.select(*KEY).distinct(), KEY, "left_semi")
    rows = unit_matrices(cells, units, ["day"], dims)
    label = F.concat(F.lit("Day "), F.col("day").cast("string"), F.lit(" ("), F.date_format("time", DATE_LABEL), F.lit(")"))
    return rows.withColumn("label", label)


def tod_matrices(tod_over_time: DataFrame, dims: DataFrame) -> DataFrame:
    """Quadrant windows with at least one plotted place; a value of 0 counts as missing here."""
    cells = plot_cells(tod_over_time, dims, ["window_start"], zero_is_missing=True)
    days = tod_over_time.filter((F.col("x") >= 0) & (F.col("y") >= 0)).groupBy(*SERIES_KEY, "window_start").agg(
        F.max("time").alias("time"), F.max("day").alias("day")
    )
    units = days.join(cells.select(*KEY).distinct(), KEY, "left_semi")
    rows = unit_matrices(cells, units, ["window_start"], dims).join(
        units.select(*SERIES_KEY, "window_start", "day"), [*SERIES_KEY, "window_start"]
    )
    return rows.withColumn("label", F.date_format("time", DATE_TIME_LABEL))


def hourly_matrices(hourly: DataFrame, last: DataFrame) -> DataFrame:
    """Hour of the day by day of production, up to the newest stored day (``last``: :func:`marks.last_rows`)."""
    shown = F.when(F.col("obs_type") == AMBIENT, F.col("mean")).otherwise(F.col("total"))
    rows = hourly.join(last.select(*KEY, "last_day"), KEY).withColumn("hour", F.hour("time"))
    rows = rows.filter(F.col("day").between(F.lit(0), F.col("last_day")))
    values = rows.groupBy(*SERIES_KEY, "last_day", "hour", "day").agg(F.max_by(shown, "time").alias("value"))
    values = values.withColumn("value", clamp_negative(F.col("value")))
    width = F.col("last_day") + 1
    return _dense(values, [*SERIES_KEY, "last_day"], F.lit(HOURS_PER_DAY), width, F.col("hour"), F.col("day"))


# Documents -----------------------------------------------------------------------------------------------------------------


def matrix_documents(matrices: DataFrame, event: str, date: Column) -> DataFrame:
    """``{"data": {label: matrix, ...}, "date": [...]}`` in time order; a label that occurs twice shows its newest matrix.

    A document holds the matrices of one cycle and observable, each bounded by the grid.
    """
    units = matrices.withColumn("_date", date).groupBy("round_id", "observable_name", "label").agg(
        F.max(F.struct("time", "_date", "matrix")).alias("u")
    )
    packed = units.groupBy("round_id", "observable_name").agg(
        F.array_sort(F.collect_list(F.struct("u.time", "label", "u._date", "u.matrix"))).alias("p")
    )
    data = F.map_from_arrays(F.col("p.label"), F.col("p.matrix"))
    return packed.select(
        F.to_json(F.struct(data.alias("data"), F.col("p._date").alias("date"))).alias("data"),
        F.lit(event).alias("event_type"),
        F.lit("heatmap").alias("type_of_plot"),
        "round_id",
        "observable_name",
    )


def hourly_documents(matrices: DataFrame) -> DataFrame:
    labels = F.transform(F.sequence(F.lit(0), F.col("last_day")), lambda d: F.concat(F.lit("Day "), d.cast("string")))
    return matrices.select(
        F.to_json(F.struct(F.col("matrix").alias("data"), labels.alias("date"))).alias("data"),
        F.lit("hourly_overview").alias("event_type"),
        F.lit("heatmap").alias("type_of_plot"),
        "round_id",
        "observable_name",
    )
