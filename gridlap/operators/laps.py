"""As-of assignment of readings to laps, per reading and per file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..session import stage

# Why a file is turned away.
NOT_IN_RANGE = "round_not_in_range"
NOT_VALID = "round_not_valid"


def lap_intervals(counter: DataFrame) -> DataFrame:
    """Half-open intervals ``[lo, hi)`` in which each counter row is the latest one, cut at midnight.

    The cut gives the as-of join an equality on ``(round_id, day)``: a reading meets the laps of its own day only, and no window
    here spans more than the counter rows of one day or one row per day. The last interval of a cycle is open (``hi`` is NULL)
    and stands under the cycle's last counter day. Of several rows at one instant the highest lap number counts.
    """
    points = (
        counter.filter("time IS NOT NULL AND round_id IS NOT NULL")
        .groupBy("round_id", "time")
        .agg(F.max(F.struct("round_number", "is_valid_round")).alias("lap"))
        .withColumn("day", F.to_date("time"))
    )
    in_day = Window.partitionBy("round_id", "day")
    points = points.withColumns(
        {"hi": F.lead("time").over(in_day.orderBy("time")), "first_of_day": F.min("time").over(in_day)}
    )
    by_day = Window.partitionBy("round_id").orderBy("day")
    tails = points.filter("hi IS NULL").withColumns(
        {"next_day": F.lead("day").over(by_day), "next_lo": F.lead("first_of_day").over(by_day)}
    )
    # A day's last lap runs to midnight, then through every day up to the next counter row.
    carried = tails.select(
        "round_id",
        "time",
        "lap",
        "next_day",
        "next_lo",
        F.col("day").alias("lap_day"),
        F.explode(F.sequence("day", F.coalesce("next_day", "day"))).alias("day"),
    ).selectExpr(
        "round_id",
        "day",
        "IF(day = lap_day, time, CAST(day AS TIMESTAMP_NTZ)) AS lo",
        "CASE WHEN next_day IS NULL THEN NULL WHEN day < next_day THEN CAST(date_add(day, 1) AS TIMESTAMP_NTZ) ELSE next_lo END AS hi",
        "time",
        "lap",
    )
    within = points.filter("hi IS NOT NULL").select("round_id", "day", F.col("time").alias("lo"), "hi", "time", "lap")
    return within.unionByName(carried).filter("hi IS NULL OR lo < hi").selectExpr(
        "round_id", "day", "lo", "hi", "time AS lap_time", "lap.round_number AS round_number", "lap.is_valid_round AS is_valid_round"
    )


@dataclass
class LapIndex:
    """The lookup side of the as-of join.

    It is staged once per batch. The planner then sees its true size and broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that the join sorts and merges on ``(round_id, day)`` and adaptive execution
    splits days that hold too many readings.
    """

    intervals: DataFrame
    last_days: DataFrame

    @classmethod
    def build(cls, counter: DataFrame) -> LapIndex:
        intervals = stage(lap_intervals(counter), "lap-intervals")
        last_days = intervals.filter("hi IS NULL").select("round_id", F.col("day").alias("last_counter_day"))
        return cls(intervals, last_days)

    def match(self, rows: DataFrame, time: str = "time", by_minute: bool = True, prefix: str = "") -> DataFrame:
        """Left as-of join: adds ``round_number``, ``is_valid_round`` and ``lap_time``, NULL before the first counter row.

        ``by_minute`` drops the seconds on both sides: a counter row claims its whole minute and the last one of a minute wins.
        """
        added = [f"{prefix}{name}" for name in ("round_number", "is_valid_round", "lap_time")]

        def cut(column: Column) -> Column:
            return tp.trunc("MINUTE", column) if by_minute else column

        # Both sides are cut before the join, so that its condition only compares columns.
        laps = self.intervals.select(
            "round_id",
            F.col("day").alias("_day"),
            cut(F.col("lo")).alias("_lo"),
            cut(F.col("hi")).alias("_hi"),
            F.col("round_number").alias(added[0]),
            F.col("is_valid_round").alias(added[1]),
            F.col("lap_time").alias(added[2]),
        )
        bucketed = rows.join(self.last_days, "round_id", "left").withColumns(
            {"_day": F.least(F.to_date(time), "last_counter_day"), "_at": cut(F.col(time))}
        )
        at, lo, hi = F.col("l._at"), F.col("r._lo"), F.col("r._hi")
        same_day = (F.col("l.round_id") == F.col("r.round_id")) & (F.col("l._day") == F.col("r._day"))
        joined = bucketed.alias("l").join(laps.alias("r"), same_day & (at >= lo) & (hi.isNull() | (at < hi)), "left")
        return joined.select(*[f"l.{c}" for c in rows.columns], *[f"r.{c}" for c in added])


def file_laps(files: DataFrame, index: LapIndex) -> DataFrame:
    """One lap for a whole file where its first and last reading fall into the same lap number.

    ``files`` carries ``first_time`` and ``last_time``. Adds ``file_round_number`` (NULL: decide per reading) and ``lap_verdict``.
    Bounds use exact times. Only the flag at the end of the file decides whether a shared lap is valid.
    """
    bounded = index.match(files, "first_time", by_minute=False, prefix="first_")
    bounded = index.match(bounded, "last_time", by_minute=False, prefix="last_")
    return bounded.selectExpr(
        *files.columns,
        "IF(first_round_number = last_round_number, last_round_number, NULL) AS file_round_number",
        f"CASE WHEN first_lap_time IS NULL OR last_lap_time IS NULL THEN '{NOT_IN_RANGE}' "
        f"WHEN first_round_number = last_round_number AND last_is_valid_round = 0 THEN '{NOT_VALID}' END AS lap_verdict",
    )


def assign_laps(readings: DataFrame, files: DataFrame, index: LapIndex) -> DataFrame:
    """Per-reading lap under the per-file rule; readings of rejected files and of invalid laps are dropped.

    ``files`` is the output of :func:`gridlap.operators.quality.check_files`.
    """
    accepted = files.filter("verdict IS NULL").select("file_id", "file_round_number", "day_of_production")
    per_reading = index.match(readings.filter("time IS NOT NULL"))
    return (
        per_reading.join(accepted, "file_id", "inner")
        .filter("file_round_number IS NOT NULL OR is_valid_round = 1")
        .withColumn("round_number", F.coalesce("file_round_number", "round_number"))
        .drop("file_round_number", "is_valid_round", "lap_time")
    )
