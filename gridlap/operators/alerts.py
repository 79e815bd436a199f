"""Alert and audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .laps import NOT_IN_RANGE, NOT_VALID
from .quality import BAD_FILE, NOT_AVAILABLE, SUSPICIOUS

# Message texts and the one observable whose suspicious files are reported.
WRONG_COORDINATES = "wrong_coordinates"
EMPTY_OUTPUT = "empty_output"
REPEATED_FILE = "repeated_file"
SUBJECTS = {
    SUSPICIOUS: "Suspicious data error",
    BAD_FILE: "File is bad",
    WRONG_COORDINATES: "Wrong cordinates exception",
    NOT_IN_RANGE: "Round not in range and is discarded",
    NOT_VALID: "Round is not valid",
    NOT_AVAILABLE: "Observable is not available for this robot",
    EMPTY_OUTPUT: "There is no data for this output",
    REPEATED_FILE: "File was delivered before and is not counted again",
}
REPORTED_OBSERVABLE = "temperature"
ALERT_COLUMNS = ["kind", "round_id", "robot_id", "observable_name", "file_id", "subject", "body", "notify"]


def _alert(rows: DataFrame, kind: Column, body: Column, notify: Column) -> DataFrame:
    subjects = F.create_map(*[F.lit(v) for pair in SUBJECTS.items() for v in pair])
    for name in ("robot_id", "file_id"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return rows.select(
        kind.alias("kind"),
        "round_id",
        "robot_id",
        "observable_name",
        "file_id",
        F.try_element_at(subjects, kind).alias("subject"),
        body.alias("body"),
        notify.alias("notify"),
    )


def file_alerts(files: DataFrame) -> DataFrame:
    """One row per rejected file; ``notify`` says whether someone is to be told (suspicious data only for one observable)."""
    verdict = F.col("verdict")
    about = F.concat(F.lit(" for round id "), "round_id")
    body = (
        F.when(verdict == SUSPICIOUS, F.concat(F.lit("Robot with id "), "robot_id", F.lit(" is sending suspicious data"), about))
        .when(verdict == BAD_FILE, F.concat(F.lit("Robot with id "), "robot_id", F.lit(" has sent a bad file"), about))
        .otherwise(F.concat("observable_name", F.lit(" of robot with id "), "robot_id", F.lit(" was rejected"), about))
    )
    notify = (verdict == BAD_FILE) | ((verdict == SUSPICIOUS) & (F.col("observable_name") == REPORTED_OBSERVABLE))
    return _alert(files.filter(verdict.isNotNull()), verdict, body, notify)


def repeated_alerts(files: DataFrame) -> DataFrame:
    """One row per file (round_id, robot_id, observable_name, file_id) that was already taken in."""
    body = F.concat(F.lit("File "), "file_id", F.lit(" of round id "), "round_id", F.lit(" was delivered again"))
    return _alert(files, F.lit(REPEATED_FILE), body, F.lit(False))


def coordinate_alerts(rows: DataFrame) -> DataFrame:
    """One row per cycle and observable that has places outside its grid (``x_dim``, ``y_dim`` columns)."""
    outside = rows.filter((F.col("x") > F.col("x_dim")) | (F.col("y") > F.col("y_dim")))
    worst = outside.groupBy("round_id", "observable_name").agg(F.max("x").alias("x"), F.max("y").alias("y"))
    body = F.concat(
        F.lit("Round with id "), "round_id",
        F.lit(" has sent data with wrong cordinates and frontend data can't be plotted. X cordinates = "),
        F.col("x").cast("string"), F.lit(", Y cordinates = "), F.col("y").cast("string"),
    )
    return _alert(worst, F.lit(WRONG_COORDINATES), body, F.lit(True))


def empty_output_alerts(expected: DataFrame, outputs: DataFrame) -> DataFrame:
    """Expected display rows (round_id, observable_name, event_type, type_of_plot) that no data was found for."""
    key = ["round_id", "observable_name", "event_type", "type_of_plot"]
    missing = expected.select(*key).distinct().join(outputs.select(*key), key, "left_anti")
    body = F.concat(
        F.lit("There is no "), "event_type", F.lit(" data for "), "type_of_plot", F.lit(" of round_id="), "round_id",
        F.lit(", observable name = "), "observable_name",
    )
    return _alert(missing, F.lit(EMPTY_OUTPUT), body, F.lit(False))


def ingest_audit(files: DataFrame, received: Column) -> DataFrame:
    """One row per file that arrived, accepted or not, keyed by a hash of the file id."""
    return files.select(
        F.sha2(F.concat_ws("|", F.lit("measurement"), "file_id"), 256).alias("id"),
        "robot_id",
        "round_id",
        F.col("file_id").alias("url"),
        received.alias("from"),
        received.alias("to"),
        "observable_id",
        F.lit("0000000").alias("created_by"),
    )
