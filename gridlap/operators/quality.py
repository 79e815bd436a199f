"""File checks: allow-list, suspicious data, lap range, and the day of production."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .laps import LapIndex, file_laps

# Thresholds of the suspicious-data test and the names of the verdicts.
MIN_ROWS = 2
MIN_VALUE_SD = 0.01
MIN_SPAN_SECONDS = 600
BAD_FILE = "bad_file"
NOT_AVAILABLE = "observable_not_available"
SUSPICIOUS = "suspicious_data"

FILE_COLUMNS = ["file_id", "round_id", "robot_id", "observable_name", "observable_id", "obs_type"]


def file_stats(readings: DataFrame) -> DataFrame:
    """One row per file; every aggregate combines on the map side, so a dominant file costs no more than another.

    Where the source marks lines that did not parse (``is_bad``) they are counted apart.
    """
    span = F.unix_micros(F.max("time").cast("timestamp")) - F.unix_micros(F.min("time").cast("timestamp"))
    bad = F.col("is_bad") if "is_bad" in readings.columns else F.lit(False)
    return readings.groupBy(*FILE_COLUMNS).agg(
        F.count(F.when(~bad, 1)).alias("readings"),
        F.count(F.when(bad, 1)).alias("bad_lines"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.floor(span / 1_000_000).alias("span_seconds"),
        F.stddev_samp("value").alias("value_sd"),
        F.stddev_samp("x").alias("x_sd"),
        F.stddev_samp("y").alias("y_sd"),
    )


def with_absent_files(stats: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add the files of ``manifest`` that left no reading; one without any content counts as bad."""
    absent = manifest.join(stats.select("file_id"), "file_id", "left_anti").select(
        *FILE_COLUMNS, F.lit(0).cast("long").alias("readings"), F.col("is_empty").cast("long").alias("bad_lines")
    )
    return stats.unionByName(absent, allowMissingColumns=True)


def is_suspicious() -> Column:
    """Fewer than two readings, or hardly any change of value or position over at least ten minutes."""
    still = F.coalesce((F.col("x_sd") == 0) & (F.col("y_sd") == 0), F.lit(False))
    flat = F.coalesce(F.col("value_sd") < MIN_VALUE_SD, F.lit(False))
    return (F.col("readings") < MIN_ROWS) | ((flat | still) & (F.col("span_seconds") >= MIN_SPAN_SECONDS))


def _pairs(robot_observable: DataFrame) -> DataFrame:
    return robot_observable.select("robot_id", "observable_id").distinct()


def allowed(files: DataFrame, robot_observable: DataFrame) -> DataFrame:
    """Files of robots that carry the sensor."""
    return files.join(_pairs(robot_observable), ["robot_id", "observable_id"], "left_semi")


def not_allowed(files: DataFrame, robot_observable: DataFrame) -> DataFrame:
    return files.join(_pairs(robot_observable), ["robot_id", "observable_id"], "left_anti")


def with_day_of_production(rows: DataFrame, cycles: DataFrame, time: str) -> DataFrame:
    """Whole days between the cycle's start date and the date of ``time``; negative before the start."""
    starts = cycles.select(F.col("id").alias("round_id"), F.col("from").alias("_from"))
    return (
        rows.join(starts, "round_id", "left")
        .withColumn("day_of_production", F.datediff(F.to_date(time), "_from"))
        .drop("_from")
    )


def check_files(
    readings: DataFrame,
    index: LapIndex,
    cycles: DataFrame,
    robot_observable: DataFrame,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """File table with ``verdict`` (NULL: accepted), ``file_round_number`` and ``day_of_production``.

    The checks apply in this order: readable, sensor known for the robot, suspicious data, lap range, lap validity. A file is
    judged as a whole, on its statistics.
    """
    stats = file_stats(readings)
    if manifest is not None:
        stats = with_absent_files(stats, manifest)
    pairs = _pairs(robot_observable).withColumn("_known", F.lit(True))
    files = file_laps(stats.join(pairs, ["robot_id", "observable_id"], "left"), index)
    verdict = (
        F.when(F.col("bad_lines") > 0, BAD_FILE)
        .when(F.col("_known").isNull(), NOT_AVAILABLE)
        .when(is_suspicious(), SUSPICIOUS)
        .otherwise(F.col("lap_verdict"))
    )
    files = files.withColumn("verdict", verdict).drop("_known", "lap_verdict")
    return with_day_of_production(files, cycles, "last_time")
