"""Time series of the roll-ups, as points and as one JSON document per cycle and observable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..schemas import AMBIENT, SERIES_KEY

# Label formats.
HOUR_LABEL = "yyyy-MM-dd HH:00:00"
MINUTE_LABEL = "yyyy-MM-dd HH:mm:00"
DAY_LABEL = "yyyy-MM-dd 00:00:00"
DATE_LABEL = "yyyy-MM-dd"
DATE_HOUR_LABEL = "yyyy-MM-dd HH"


def _shown() -> Column:
    return F.when(F.col("obs_type") == AMBIENT, F.col("mean")).otherwise(F.col("total"))


def _points(over_space: DataFrame, event: str, time: str, label: str, unit: Column) -> DataFrame:
    """One point per time; where units share a time, the first unit's value shows."""
    rows = over_space.select(*SERIES_KEY, F.col(time).alias("time"), _shown().alias("value"), unit.alias("unit"))
    return (
        rows.groupBy(*SERIES_KEY, "time")
        .agg(F.min_by("value", "unit").alias("value"))
        .select(*SERIES_KEY, F.lit(event).alias("event_type"), "time", F.date_format("time", label).alias("date"), "value")
    )


def latest_series(latest_over_space: DataFrame) -> DataFrame:
    return _points(latest_over_space, "latest", "latest_time", HOUR_LABEL, F.lit(0))


def round_series(round_over_space: DataFrame) -> DataFrame:
    return _points(round_over_space, "round", "time", MINUTE_LABEL, F.col("round_number"))


def day_series(day_over_space: DataFrame) -> DataFrame:
    return _points(day_over_space, "new_day", "time", DAY_LABEL, F.col("day"))


def tod_series(tod_over_space: DataFrame) -> DataFrame:
    return _points(tod_over_space, "time_of_day", "time", MINUTE_LABEL, F.col("time_of_day"))


def hour_series(hourly: DataFrame) -> DataFrame:
    label = F.date_format("time", DATE_HOUR_LABEL)
    return hourly.select(*SERIES_KEY, F.lit("hour").alias("event_type"), "time", label.alias("date"), _shown().alias("value"))


CALENDAR_UNITS = {
    "day": lambda: F.dayofyear("time"),
    "week": lambda: tp.week_of_year(F.col("time")),
    "month": lambda: F.month("time"),
}
UNIT_VALUES = {
    "first": lambda: F.min_by("value", "time"),
    "mean": lambda: F.avg("value"),
    "sum": lambda: F.sum("value"),
}


def calendar_series(hourly: DataFrame, unit: str, value: str = "first") -> DataFrame:
    """Hourly values by day, week (from Sunday) or month of the year.

    ``value='first'`` shows the unit's first hour; 'mean' and 'sum' use them all. Units of different years stay apart.
    """
    rows = hourly.withColumn("value", _shown())
    keys = [*SERIES_KEY, F.year("time").alias("year"), CALENDAR_UNITS[unit]().alias("unit")]
    units = rows.groupBy(*keys).agg(UNIT_VALUES[value]().alias("value"), F.min("time").alias("time"))
    label = F.date_format("time", DATE_LABEL)
    return units.select(*SERIES_KEY, F.lit(unit).alias("event_type"), "time", label.alias("date"), "value")


def series_documents(points: DataFrame) -> DataFrame:
    """``{"data": [...], "date": [...]}`` in time order, one row per cycle, observable and event type.

    A document holds one point per unit of one cycle; the points are roll-up rows, not readings.
    """
    ordered = F.array_sort(F.collect_list(F.struct("time", "date", "value")))
    return (
        points.groupBy("round_id", "observable_name", "event_type")
        .agg(ordered.alias("p"))
        .select(
            F.to_json(F.struct(F.col("p.value").alias("data"), F.col("p.date").alias("date"))).alias("data"),
            "event_type",
            F.lit("graph").alias("type_of_plot"),
            "round_id",
            "observable_name",
        )
    )
