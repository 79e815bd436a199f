"""Retraction of cells that belong to invalid starts of a lap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of a discarded-lap alert.
NO_ID = "0000000"
DISCARDED_SUBJECT = "Discarded robot round"
DISCARDED_EVENT = "robot round discarded"
NOT_DECIDABLE_SUBJECT = "No valid start of robot round"


def lap_bounds(counter: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    """Per lap with several starts: the last valid time, the first invalid start before it and the first one after it.

    ``laps`` (round_id, round_number) limits the work to the laps that were just closed.
    """
    if laps is not None:
        counter = counter.join(laps.select("round_id", "round_number").distinct(), ["round_id", "round_number"], "left_semi")
    key = ["round_id", "round_number"]
    valid = counter.groupBy(*key).agg(
        F.count(F.lit(1)).alias("starts"), F.max(F.when(F.col("is_valid_round") == 1, F.col("time"))).alias("valid_time")
    )
    invalid = counter.filter(F.col("is_valid_round") == 0).join(valid.filter("starts >= 2"), key)
    return invalid.groupBy(*key).agg(
        F.max("valid_time").alias("valid_time"),
        F.min(F.when(F.col("time") <= F.col("valid_time"), F.col("time"))).alias("first_before"),
        F.min(F.when(F.col("time") > F.col("valid_time"), F.col("time"))).alias("first_after"),
    )


def drop_invalid(cells: DataFrame, counter: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    """Cells outside the invalid stretches of their lap. A lap without any valid start keeps its cells."""
    bounds = lap_bounds(counter, laps).filter("valid_time IS NOT NULL")
    before = (F.col("time") >= F.col("first_before")) & (F.col("time") < F.col("valid_time"))
    after = F.col("time") >= F.col("first_after")
    dropped = F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))
    return cells.join(bounds, ["round_id", "round_number"], "left").filter(~dropped).select(*cells.columns)


def invalid_starts(counter: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    """The invalid starts that lead to a deletion: all before the last valid start, and the first one after it."""
    bounds = lap_bounds(counter, laps)
    rows = counter.filter(F.col("is_valid_round") == 0).join(bounds, ["round_id", "round_number"])
    handled = (F.col("time") <= F.col("valid_time")) | (F.col("time") == F.col("first_after")) | F.col("valid_time").isNull()
    return rows.filter(handled).select("round_id", "round_number", "time", "valid_time")


def invalid_alerts(counter: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    """One alert row per handled start, keyed by a hash of what it is about."""
    shown = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    number = F.col("round_number").cast("string")
    known = F.col("valid_time").isNotNull()
    message = F.concat(
        F.lit("Round with id "), "round_id", F.lit(", at time - "), shown, F.lit(" and number "), number,
        F.when(known, " has been discarded.").otherwise(" has no valid start and was kept."),
    )
    return invalid_starts(counter, laps).select(
        F.sha2(F.concat_ws("|", F.lit("round_invalidation"), "round_id", number, shown), 256).alias("id"),
        F.col("round_id").alias("robot_id"),
        F.lit(NO_ID).alias("alert_id"),
        F.lit("none").alias("notification_method_id"),
        F.lit(NO_ID).alias("user_id"),
        "time",
        F.when(known, DISCARDED_SUBJECT).otherwise(NOT_DECIDABLE_SUBJECT).alias("subject"),
        message.alias("message"),
        F.lit("high").alias("level"),
        F.lit(NO_ID).alias("created_by"),
        F.lit(DISCARDED_EVENT).alias("event_type"),
    )
