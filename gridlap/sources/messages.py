"""Sensor files and messages as text, parsed to readings.

A file is either CSV (with a header line that names its columns) or JSON lines; which one is decided per file. Lines that do not
fit are kept as rows with ``is_bad``, so that the file check can turn the whole file away with the same aggregate that computes
its statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import nan_to_null
from ..schemas import DDL
from ..session import stage

# Formats of the wire.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
CSV_COLUMNS = ["timestamp", "x", "y", "z", "value"]
FILE_FIELDS = ["round_id", "robot_id", "observable_name", "observable_id", "obs_type", "x_dim", "y_dim"]


def _unquoted(text: Column) -> Column:
    return F.regexp_replace(text, '^"|"$', "")


def reading_time(text: Column) -> Column:
    """Timestamp text, with or without literal quotes; NULL if it does not parse."""
    return F.try_to_timestamp(_unquoted(text), F.lit(TIME_FORMAT)).cast("timestamp_ntz")


def _number(text: Column) -> Column:
    return nan_to_null(text.try_cast("double"))


def _grid(value: Column) -> Column:
    """Coordinate to grid index: the fraction is cut off."""
    return nan_to_null(value).try_cast("int")


def _header_positions(rows: DataFrame) -> DataFrame:
    """Per file with a header: the place of each column in it. Only lines that name the time column are looked at."""
    named = rows.filter(F.col("line").contains(CSV_COLUMNS[0]) & ~F.col("line").startswith("{"))
    columns = F.transform(F.split("line", r"\s*,\s*"), _unquoted)
    found = named.select("file_id", columns.alias("_columns")).filter(F.array_contains("_columns", CSV_COLUMNS[0]))
    headers = found.groupBy("file_id").agg(F.max("_columns").alias("_columns"))
    places = [F.nullif(F.array_position("_columns", c).cast("int"), F.lit(0)).alias(f"_at_{c}") for c in CSV_COLUMNS]
    return headers.select("file_id", F.size("_columns").alias("_width"), *places)


# Why a line is kept apart.
NO_HEADER, MIXED, TOO_MANY, NO_NUMBER, NO_TIME, NO_PLACE = (
    "no header", "JSON in a CSV file", "too many fields", "value is not a number", "no time", "no place",
)


def parse_lines(lines: DataFrame, keep_bad: bool = False) -> DataFrame:
    """``(file_id, line, ...)`` to ``(file_id, ..., time, x, y, z, value, is_bad)``.

    CSV columns are found by the names in the file's header; their x and y are swapped, JSON's are not. With ``keep_bad`` bad lines stay
    with their text and why they are bad (``bad_line``, ``reason``); the text of other lines goes no further.
    """
    carried = [c for c in lines.columns if c != "line"]
    rows = lines.withColumn("line", F.trim("line")).filter(F.col("line") != "")
    headers = stage(_header_positions(rows), "headers")

    typed = rows.join(headers, "file_id", "left").withColumns(
        {"_is_json": F.col("line").startswith("{"), "_fields": F.split("line", r"\s*,\s*")}
    )
    # The test for a header runs only on lines that contain the column's name.
    names_time = F.col("line").contains(CSV_COLUMNS[0]) & F.col("_width").isNotNull() & ~F.col("_is_json")
    is_header = F.when(names_time, F.exists("_fields", lambda c: _unquoted(c) == CSV_COLUMNS[0])).otherwise(False)
    typed = typed.filter(~is_header)

    def field(name: str) -> Column:
        return F.get(F.col("_fields"), F.col(f"_at_{name}") - 1)

    json = typed.filter("_is_json").withColumn("_j", F.from_json("line", DDL["json_reading"]))
    csv = typed.filter("NOT _is_json").withColumn("_value", field("value"))
    places = [_grid(F.get("_j.coordinates", F.lit(i))).alias(c) for i, c in enumerate("xyz")]
    from_json = json.select(
        *carried, "_width", reading_time(F.col("_j.timestamp")).alias("time"), *places,
        nan_to_null(F.col("_j.data")).alias("value"), F.when(F.col("_width").isNotNull(), MIXED).alias("_misfit"), "line",
    )
    no_number = (F.coalesce("_value", F.lit("")) != "") & F.col("_value").try_cast("double").isNull()
    from_csv = csv.select(
        *carried, "_width", reading_time(field("timestamp")).alias("time"), _grid(_number(field("y"))).alias("x"),
        _grid(_number(field("x"))).alias("y"), _grid(_number(field("z"))).alias("z"), _number(F.col("_value")).alias("value"),
        F.when(F.col("_width").isNull(), NO_HEADER).when(F.size("_fields") > F.col("_width"), TOO_MANY).when(no_number, NO_NUMBER).alias("_misfit"), "line",
    )
    no_place = F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull()
    reason = F.coalesce("_misfit", F.when(F.col("time").isNull(), NO_TIME).when(no_place, NO_PLACE))
    parsed = from_csv.unionByName(from_json).withColumn("reason", reason).withColumn("is_bad", F.col("reason").isNotNull())
    kept = [F.when(F.col("is_bad"), F.col("line")).alias("bad_line"), "reason"] if keep_bad else []
    return parsed.select(*carried, "time", "x", "y", "z", "value", "is_bad", *kept)


def quarantined(parsed: DataFrame) -> DataFrame:
    """The bad lines of ``parse_lines(..., keep_bad=True)`` with their file and, where known, their number in it."""
    number = F.col("line_number") if "line_number" in parsed.columns else F.lit(None).cast("int").alias("line_number")
    return parsed.filter("is_bad").select("file_id", "round_id", "robot_id", "observable_name", number, F.col("bad_line").alias("line"), "reason")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files under ``path`` with the file's path; large files are split across tasks."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file_id"), F.col("value").alias("line"))


def read_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Readings of a folder of sensor files. ``manifest`` names cycle, robot, sensor and grid of each ``file_id``."""
    return parse_lines(read_lines(spark, path).join(manifest.select("file_id", *FILE_FIELDS), "file_id"))


def with_empty_flag(manifest: DataFrame, lines: DataFrame) -> DataFrame:
    """Mark the files of ``manifest`` that left no line behind (``is_empty``), for :func:`quality.check_files`."""
    seen = lines.select("file_id").distinct().withColumn("is_empty", F.lit(False))
    return manifest.join(seen, "file_id", "left").withColumn("is_empty", F.coalesce("is_empty", F.lit(True)))


def read_csv_readings(spark: SparkSession, path: str) -> DataFrame:
    """Fixed-order CSV files through the CSV reader; short, long or unparsable lines carry ``is_bad``."""
    schema = ", ".join(f"{c} string" for c in CSV_COLUMNS) + ", _corrupt string"
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .csv(path)
    )
    rows = raw.select(
        F.col("_metadata.file_path").alias("file_id"),
        reading_time(F.col("timestamp")).alias("time"),
        _grid(_number(F.col("y"))).alias("x"),
        _grid(_number(F.col("x"))).alias("y"),
        _grid(_number(F.col("z"))).alias("z"),
        _number(F.col("value")).alias("value"),
        "_corrupt",
    )
    missing = F.col("time").isNull() | F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull()
    return rows.withColumn("is_bad", F.col("_corrupt").isNotNull() | missing).drop("_corrupt")


def read_json_readings(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files through the JSON reader."""
    raw = spark.read.schema(DDL["json_reading"]).json(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("file_id"),
        reading_time(F.col("timestamp")).alias("time"),
        *[_grid(F.get("coordinates", F.lit(i))).alias(c) for i, c in enumerate("xyz")],
        nan_to_null(F.col("data")).alias("value"),
    )
    missing = F.col("time").isNull() | F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull()
    return rows.withColumn("is_bad", missing)


def parse_envelopes(messages: DataFrame, column: str = "value") -> DataFrame:
    """Queue messages (JSON text) to one row per file; the content may be one string or a list of lines."""
    m = messages.select(F.from_json(F.col(column).cast("string"), DDL["envelope"]).alias("m")).select("m.*")
    listed = F.array_join(F.from_json("file_content", "array<string>"), "")
    content = F.when(F.col("file_content").startswith("["), F.coalesce(listed, "file_content")).otherwise(F.col("file_content"))
    return m.select(
        F.col("dataFile").alias("file_id"),
        F.col("roundId").alias("round_id"),
        F.col("robotId").alias("robot_id"),
        F.col("observableName").alias("observable_name"),
        F.col("observableId").alias("observable_id"),
        F.col("type").alias("obs_type"),
        F.col("dimension.dimX").alias("x_dim"),
        F.col("dimension.dimY").alias("y_dim"),
        content.alias("content"),
    )


def envelope_readings(envelopes: DataFrame, keep_bad: bool = False) -> DataFrame:
    """Readings inside the messages of :func:`parse_envelopes`; a message delivered twice counts once. ``keep_bad``: as in :func:`parse_lines`, with
    the number of each line in its file."""
    files = envelopes.dropDuplicates(["file_id"])
    texts = F.split("content", r"\r?\n")
    if keep_bad:
        lines = files.select("file_id", *FILE_FIELDS, F.posexplode(texts).alias("line_number", "line"))
        return parse_lines(lines.withColumn("line_number", F.col("line_number") + 1), keep_bad)
    return parse_lines(files.select("file_id", *FILE_FIELDS, F.explode(texts).alias("line")))


def envelope_manifest(envelopes: DataFrame) -> DataFrame:
    """File table of the messages, with ``is_empty`` for those without any content."""
    empty = F.trim(F.regexp_replace(F.coalesce("content", F.lit("")), r"[\r\n]", "")) == ""
    return envelopes.dropDuplicates(["file_id"]).select("file_id", *FILE_FIELDS, empty.alias("is_empty"))


def parse_event_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """Trigger messages (JSON text) to trigger rows."""
    m = messages.select(F.from_json(F.col(column).cast("string"), DDL["event_message"]).alias("m")).select("m.*")
    return m.select(
        "event_type",
        F.col("roundId").alias("round_id"),
        F.col("robotId").alias("robot_id"),
        F.col("observableName").alias("observable_name"),
        "x_dim",
        "y_dim",
        F.col("type").alias("obs_type"),
    )


def trigger_messages(triggers: DataFrame) -> DataFrame:
    """Trigger rows as ``(key, value)`` messages: the routing key and the JSON body."""
    body = F.struct(
        "event_type",
        F.col("round_id").alias("roundId"),
        F.col("robot_id").alias("robotId"),
        F.col("observable_name").alias("observableName"),
        "x_dim",
        "y_dim",
        F.col("obs_type").alias("type"),
    )
    return triggers.select(F.col("routing_key").alias("key"), F.to_json(body).alias("value"))
