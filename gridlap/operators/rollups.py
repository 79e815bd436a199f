"""Roll-ups of cells: latest state, lap, day, time of day and hour; per place and over the whole area.

``*_over_time`` keep one row per place, ``*_over_space`` one row per unit. Every aggregate combines on the map side and stays in
the hash aggregate. Functions that leave out the running unit take ``last``, the output of
:func:`gridlap.operators.marks.last_rows` (one row per cycle and observable; stage it where cells are large), and an optional
``marks`` frame ``(round_id, observable_name, mark)`` with the last unit done.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.numbers import round_half_up
from ..schemas import AMBIENT, ANOMALY, NEVER, SERIES_KEY
from .marks import KEY

PLACE = ["x", "y", "z"]


def _is(obs_type: str) -> Column:
    return F.col("obs_type") == obs_type


def space_aggregates(rows: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """Mean (ambient) or total (anomaly) and sample deviation over the places of a unit; ``keys`` include ``obs_type``."""
    return rows.groupBy(*keys).agg(
        F.when(_is(AMBIENT), F.avg("value")).alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.when(_is(ANOMALY), F.coalesce(F.sum("value"), F.lit(0.0))).alias("total"),
        *extra,
    )


def _with_marks(rows: DataFrame, marks: DataFrame | None, kind: str) -> DataFrame:
    if marks is None:
        return rows.withColumn("mark", F.lit(None).cast(kind))
    return rows.join(marks.select(*KEY, "mark"), KEY, "left")


def _since_start(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("day_of_production") >= 0)


# Latest state --------------------------------------------------------------------------------------------------------------


def newer_cells(cells: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Cells after the last processed time, with that time as ``mark`` (NULL on the first run)."""
    rows = _with_marks(_since_start(cells), marks, "timestamp_ntz")
    return rows.filter(F.col("time") > F.coalesce("mark", tp.ntz(NEVER)))


def newest_of(rows: DataFrame) -> DataFrame:
    """Newest row of every place, with its lap; of rows with one time the later lap counts."""
    key = tp.order_key(F.col("time"), F.col("round_number"))
    return (
        rows.withColumn("key", key)
        .groupBy(*SERIES_KEY, *PLACE)
        .agg(F.max_by("value", "key").alias("value"), tp.key_time(F.max("key")).alias("time"), tp.key_tie(F.max("key")).alias("round_number"))
        .select("value", "time", *PLACE, *SERIES_KEY, "round_number")
    )


def latest_places(cells: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    return newest_of(newer_cells(cells, marks))


def latest_over_time(cells: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Newest value of every place."""
    return latest_places(cells, marks).drop("round_number")


def latest_over_space(cells: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Statistics over the cells that are new since ``marks``."""
    return space_aggregates(
        newer_cells(cells, marks), SERIES_KEY, F.max("time").alias("latest_time"), F.max("mark").alias("old_time")
    )


# Laps ----------------------------------------------------------------------------------------------------------------------


def closed_round_cells(cells: DataFrame, last: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Cells of laps from the last one done up to, without, the running one."""
    rows = _with_marks(_since_start(cells).join(last.select(*KEY, "last_round_number"), KEY), marks, "int")
    number = F.col("round_number")
    return rows.filter((number >= F.coalesce("mark", F.lit(0))) & (number < F.col("last_round_number")))


def round_over_time(cells: DataFrame, last: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Cells are unique per lap and place, so the per-place lap table is a selection of them."""
    rows = closed_round_cells(cells, last, marks)
    return rows.select("value", "time", *PLACE, "round_id", "round_number", "observable_name", "obs_type")


def round_times(counter: DataFrame) -> DataFrame:
    """Latest valid counter time of each lap."""
    valid = counter.filter(F.col("is_valid_round") == 1)
    return valid.groupBy("round_id", "round_number").agg(F.max("time").alias("lap_time"))


def round_over_space(rounds: DataFrame, counter: DataFrame) -> DataFrame:
    """One row per lap of :func:`round_over_time`; its time is the lap's, or midway between the first and last cell."""
    units = space_aggregates(
        rounds, [*SERIES_KEY, "round_number"], F.min("time").alias("lo"), F.max("time").alias("hi")
    ).join(round_times(counter), ["round_id", "round_number"], "left")
    midway = tp.from_seconds(F.floor((tp.seconds(F.col("lo")) + tp.seconds(F.col("hi"))) / 2))
    time = F.coalesce("lap_time", midway).alias("time")
    return units.select("mean", "sd", "total", time, "round_number", *SERIES_KEY)


# Days ----------------------------------------------------------------------------------------------------------------------


def closed_day_cells(cells: DataFrame, last: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    rows = _with_marks(_since_start(cells).join(last.select(*KEY, "last_day"), KEY), marks, "int")
    day = F.col("day_of_production")
    first = F.greatest(F.coalesce("mark", F.lit(0)), F.lit(0))
    return rows.filter((day >= first) & (day < F.col("last_day")))


def _unit_value() -> Column:
    """Rounded mean (ambient) or maximum (anomaly) of the cells of a place."""
    mean = round_half_up(F.try_divide(F.sum("value"), F.count("value")), 2)
    return F.when(_is(AMBIENT), mean).otherwise(F.max("value"))


def day_over_time(cells: DataFrame, last: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """One value per square and day of production, stamped with noon; readings without a coordinate are left out."""
    rows = closed_day_cells(cells, last, marks).filter(F.col("x") != -1)
    return (
        rows.groupBy(*SERIES_KEY, F.col("day_of_production").alias("day"), "x", "y")
        .agg(_unit_value().alias("value"), tp.noon(F.min("time")).alias("time"), F.min("z").alias("z"))
        .select("value", "time", *PLACE, "round_id", "day", "observable_name", "obs_type")
    )


def day_over_space(days: DataFrame) -> DataFrame:
    units = space_aggregates(days, [*SERIES_KEY, "day"], F.max("time").alias("time"))
    return units.select("mean", "sd", "total", "time", "day", *SERIES_KEY)


# Time of day ---------------------------------------------------------------------------------------------------------------


def closed_quadrant_cells(cells: DataFrame, last: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Cells of quadrant windows after the last one done and before the one that holds the newest cell."""
    rows = _with_marks(_since_start(cells).join(last.select(*KEY, "last_time"), KEY), marks, "timestamp_ntz")
    rows = rows.withColumn("window_start", tp.window_start(F.col("time")))
    start = F.col("window_start")
    fresh = F.col("mark").isNull() | (start > tp.window_start(F.col("mark")))
    return rows.filter(fresh & (start < tp.window_start(F.col("last_time"))))


def tod_over_time(cells: DataFrame, last: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """One value per square and quadrant window, stamped with the middle of the window."""
    rows = closed_quadrant_cells(cells, last, marks).filter(F.col("x") != -1)
    units = rows.groupBy(*SERIES_KEY, "window_start", "x", "y").agg(
        _unit_value().alias("value"), F.min("z").alias("z"), F.max("day_of_production").alias("day")
    )
    start = F.col("window_start")
    return units.select(
        "value",
        tp.window_midpoint(start).alias("time"),
        *PLACE,
        "round_id",
        "day",
        tp.quadrant(start).alias("time_of_day"),
        "observable_name",
        "obs_type",
        "window_start",
    )


def tod_over_space(quadrants: DataFrame) -> DataFrame:
    units = space_aggregates(
        quadrants, [*SERIES_KEY, "window_start", "time_of_day"], F.max("time").alias("time"), F.max("day").alias("day")
    )
    return units.select("mean", "sd", "total", "time", "day", "time_of_day", *SERIES_KEY, "window_start")


def last_closed_quadrant(cells: DataFrame, last: DataFrame) -> DataFrame:
    """Middle of the last window a time-of-day roll-up of ``cells`` would contain, as ``mark``."""
    closed = closed_quadrant_cells(cells, last).filter(F.col("x") != -1)
    return closed.groupBy(*KEY).agg(tp.window_midpoint(F.max("window_start")).alias("mark"))


def quadrant_windows(spans: DataFrame) -> DataFrame:
    """All windows after the one that holds ``start`` and before the one that holds ``newest``, as rows.

    ``spans`` has ``start`` and ``newest``; the windows of each row are numbered in time order.
    """
    midnights = F.sequence(tp.trunc("DAY", F.col("start")), tp.trunc("DAY", F.col("newest")), tp.hours(24))
    starts = F.flatten(
        F.transform(midnights, lambda d: F.array(*[d + tp.hours(h) for h in tp.QUADRANT_STARTS.values()]))
    )
    after, before = tp.window_start(F.col("start")), tp.window_start(F.col("newest"))
    wanted = F.filter(starts, lambda s: (s > after) & (s < before))
    return spans.select("*", F.posexplode(wanted).alias("n", "window_start")).withColumns(
        {"window_end": tp.window_end(F.col("window_start")), "quadrant": tp.quadrant(F.col("window_start"))}
    )


# Hours ---------------------------------------------------------------------------------------------------------------------


def hourly_overview(cells: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """One row per hour, the running hour included; hours are recomputed whole from the last one done."""
    rows = _with_marks(_since_start(cells), marks, "timestamp_ntz").withColumn("hour", tp.trunc("HOUR", F.col("time")))
    rows = rows.filter(F.col("hour") >= F.coalesce(tp.trunc("HOUR", F.col("mark")), tp.ntz("1970-01-01 00:00:00")))
    return (
        rows.groupBy(*SERIES_KEY, "hour")
        .agg(
            round_half_up(F.avg("value"), 2).alias("mean"),
            F.when(_is(AMBIENT), round_half_up(F.stddev_pop("value"), 2)).alias("sd"),
            F.when(_is(ANOMALY), round_half_up(F.sum("value"), 2)).alias("total"),
            F.max("round_number").alias("round_number"),
            F.max("day_of_production").alias("day"),
        )
        .select("mean", "sd", "total", F.col("hour").alias("time"), "round_number", "day", *SERIES_KEY)
    )
