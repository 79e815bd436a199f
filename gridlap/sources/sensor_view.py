"""Sensor readings and control tables derived from a generic ``events`` table (event_id, ts, user_id, event_type, value, props)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..schemas import AMBIENT, ANOMALY
from ..session import stage

# Fixed values of the view.
OBSERVABLE_OF_EVENT = {"view": "temperature", "click": "humidity", "purchase": "airspeed", "signup": "good_droppings"}
OTHER_OBSERVABLE = "bad_droppings"
ANOMALIES = ["good_droppings", "bad_droppings"]
X_DIM, Y_DIM = 3, 3
LAP_HOURS = 8
AIRSPEED_SCALE = 100.0
MISSING_SENSOR = ("rb2", "airspeed")


@dataclass
class SensorView:
    readings: DataFrame
    counter: DataFrame
    cycles: DataFrame
    robot_observable: DataFrame
    spans: DataFrame


def sensor_readings(events: DataFrame) -> DataFrame:
    name = F.lit(OTHER_OBSERVABLE)
    for event_type, observable in OBSERVABLE_OF_EVENT.items():
        name = F.when(F.col("event_type") == event_type, observable).otherwise(name)
    cycle = (F.col("user_id") % 3).cast("string")
    return (
        events.select(
            F.concat(F.lit("pc"), cycle).alias("round_id"),
            F.concat(F.lit("rb"), cycle).alias("robot_id"),
            name.alias("observable_name"),
            F.col("ts").cast("timestamp_ntz").alias("time"),
            (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 5 - 1).alias("x"),
            (F.col("user_id") % 4).cast("int").alias("y"),
            F.lit(0).alias("z"),
            "value",
        )
        .withColumn("value", F.when(F.col("observable_name") == "airspeed", F.col("value") / AIRSPEED_SCALE).otherwise(F.col("value")))
        .withColumn("observable_id", F.col("observable_name"))
        .withColumn("obs_type", F.when(F.col("observable_name").isin(ANOMALIES), ANOMALY).otherwise(AMBIENT))
        .withColumn("x_dim", F.lit(X_DIM))
        .withColumn("y_dim", F.lit(Y_DIM))
        .withColumn("file_id", F.concat_ws("|", "round_id", "observable_name", F.to_date("time").cast("string")))
    )


def cycle_spans(readings: DataFrame) -> DataFrame:
    """First and last reading per cycle, robot and sensor; the control tables follow from these few rows."""
    return readings.groupBy("round_id", "robot_id", "observable_id").agg(F.min("time").alias("lo"), F.max("time").alias("hi"))


def lap_counter(spans: DataFrame) -> DataFrame:
    """A lap every eight hours over each cycle's span; every seventh is invalid, every fifth was started a second time."""
    span = spans.groupBy("round_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    starts = F.sequence(tp.trunc("DAY", F.col("lo")), F.col("hi"), tp.hours(LAP_HOURS))
    laps = span.select("round_id", F.posexplode(starts).alias("i", "start"))
    lap = F.struct(
        F.col("start").alias("time"),
        (F.col("i") + 1).cast("int").alias("round_number"),
        F.when(F.col("i") % 7 == 3, 0).otherwise(1).alias("is_valid_round"),
    )
    restart = F.struct(
        (F.col("start") + tp.hours(2)).alias("time"),
        (F.col("i") + 1).cast("int").alias("round_number"),
        F.lit(0).alias("is_valid_round"),
    )
    started = F.when(F.col("i") % 5 == 4, F.array(lap, restart)).otherwise(F.array(lap))
    return laps.select("round_id", F.explode(started).alias("lap")).select("round_id", "lap.*")


def production_cycles(spans: DataFrame) -> DataFrame:
    """Cycles start two days after their first reading, so that two days lie before day 0."""
    return spans.groupBy(F.col("round_id").alias("id")).agg(F.date_add(F.to_date(F.min("lo")), 2).alias("from"))


def robot_sensors(spans: DataFrame) -> DataFrame:
    robot, sensor = MISSING_SENSOR
    pairs = spans.select("robot_id", "observable_id").distinct()
    return pairs.filter(~((F.col("robot_id") == robot) & (F.col("observable_id") == sensor)))


def sensor_view(spark: SparkSession, sf_dir: str) -> SensorView:
    readings = sensor_readings(spark.read.parquet(f"{sf_dir}/events.parquet"))
    spans = stage(cycle_spans(readings), "cycle-spans")
    return SensorView(readings, lap_counter(spans), production_cycles(spans), robot_sensors(spans), spans)
