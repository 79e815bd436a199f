"""First and last stored rows, and how far each roll-up has been computed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp

KEY = ["round_id", "observable_name"]
# What is kept per cycle and observable between batches, each with its value before the batch that changed it last.
STATE = ["last_round_number", "last_day", "last_time", "newest_window", "closed_window"]


def last_rows(cells: DataFrame) -> DataFrame:
    """Lap, day and time of the newest cell per cycle and observable; one aggregate, no sort."""
    time = F.col("time")
    return cells.groupBy(*KEY).agg(
        tp.key_tie(F.max(tp.order_key(time, F.col("round_number")))).alias("last_round_number"),
        tp.key_tie(F.max(tp.order_key(time, F.col("day_of_production")))).alias("last_day"),
        F.max("time").alias("last_time"),
    )


def first_rows(cells: DataFrame) -> DataFrame:
    """Lap, day and time of the oldest cell per cycle and observable."""
    time = F.col("time")
    return cells.groupBy(*KEY).agg(
        tp.key_tie(F.min(tp.order_key(time, F.col("round_number")))).alias("first_round_number"),
        tp.key_tie(F.min(tp.order_key(time, F.col("day_of_production")))).alias("first_day"),
        F.min("time").alias("first_time"),
    )


def last_latest(latest_over_space: DataFrame) -> DataFrame:
    return latest_over_space.groupBy(*KEY).agg(F.max("latest_time").alias("mark"))


def last_round(round_over_space: DataFrame) -> DataFrame:
    newest = F.max(tp.order_key(F.col("time"), F.col("round_number")))
    return round_over_space.groupBy(*KEY).agg(tp.key_tie(newest).alias("mark"))


def last_day(day_over_space: DataFrame) -> DataFrame:
    newest = F.max(tp.order_key(F.col("time"), F.col("day")))
    return day_over_space.groupBy(*KEY).agg(tp.key_tie(newest).alias("mark"))


def last_time_of_day(tod_over_space: DataFrame) -> DataFrame:
    return tod_over_space.groupBy(*KEY).agg(F.max("time").alias("mark"))


def last_hour(hourly_overview: DataFrame) -> DataFrame:
    return hourly_overview.groupBy(*KEY).agg(F.max("time").alias("mark"))


# State between batches -----------------------------------------------------------------------------------------------------


def state_before(stored: DataFrame, batch_id: int) -> DataFrame:
    """Newest cell and newest quadrants per cycle and observable as they stood before a batch, also where the batch is run again."""
    again = F.col("marked_by") >= batch_id
    columns = [F.when(again, F.col(f"was_{c}")).otherwise(F.col(c)).alias(c) for c in STATE]
    return stored.select(*KEY, *columns).filter("last_time IS NOT NULL")


def _windows(cells: DataFrame) -> DataFrame:
    placed = cells.filter("x != -1 AND day_of_production >= 0")
    return placed.select(*KEY, tp.window_start(F.col("time")).alias("window")).distinct()


def cell_state(cells: DataFrame, earlier_windows: DataFrame | None = None) -> DataFrame:
    """STATE of cells; ``earlier_windows`` are quadrants (KEY, window) known to hold other cells."""
    windows = _windows(cells) if earlier_windows is None else _windows(cells).unionByName(earlier_windows)
    return _with_windows(last_rows(cells), windows)


def _with_windows(last: DataFrame, windows: DataFrame) -> DataFrame:
    closed = F.col("window") < tp.window_start(F.col("last_time"))
    found = (
        windows.join(last.select(*KEY, "last_time"), KEY)
        .groupBy(*KEY)
        .agg(F.max("window").alias("newest_window"), F.max(F.when(closed, F.col("window"))).alias("closed_window"))
    )
    return last.join(found, KEY, "left").select(*KEY, *STATE)


def state_after(before: DataFrame, touched: DataFrame, is_touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State after a batch that replaced the cells of some slices, and the keys it cannot tell without the other slices.

    ``touched`` are all cells of these slices now, ``is_touched`` the keys of ``before`` whose newest cell lay in them. Such a key is open if
    its newest cell went away or is older than it was.
    """
    fresh = last_rows(touched)
    lost = before.join(is_touched.select(*KEY), KEY, "left_semi")
    now = fresh.select(*KEY, F.col("last_time").alias("_now"))
    unknown = lost.join(now, KEY, "left").filter("_now IS NULL OR _now < last_time").select(*KEY)
    kept = before.join(is_touched.select(*KEY), KEY, "left_anti").select(*KEY, "last_time", "last_round_number", "last_day")
    newest = (
        fresh.select(*KEY, "last_time", "last_round_number", "last_day")
        .unionByName(kept)
        .groupBy(*KEY)
        .agg(F.max(F.struct("last_time", "last_round_number", "last_day")).alias("m"))
        .select(*KEY, "m.*")
    )
    earlier = before.select(*KEY, F.explode(F.array_compact(F.array("newest_window", "closed_window"))).alias("window"))
    return _with_windows(newest, _windows(touched).unionByName(earlier).distinct()), unknown


def marked(before: DataFrame, after: DataFrame, batch_id: int) -> DataFrame:
    """Stored form: the state after a batch beside that before it; a key without cells keeps a row without a state."""
    was = before.select(*KEY, *[F.col(c).alias(f"was_{c}") for c in STATE])
    return after.join(was, KEY, "full").withColumn("marked_by", F.lit(batch_id).cast("bigint"))


def last_quadrant(state: DataFrame) -> DataFrame:
    """Middle of the last closed quadrant of a state, as ``mark``."""
    return state.filter("closed_window IS NOT NULL").select(*KEY, tp.window_midpoint(F.col("closed_window")).alias("mark"))
