"""The sensor view of one data folder with the intermediate frames the queries share, each built when first asked for."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..operators import marks, rollups
from ..operators.cells import cell_partials, finalise_cells
from ..operators.laps import LapIndex
from ..operators.quality import check_files
from ..session import configure, stage
from ..sources.sensor_view import X_DIM, Y_DIM, SensorView, sensor_view


class Sample:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def view(self) -> SensorView:
        return sensor_view(self.spark, self.sf_dir)

    @cached_property
    def index(self) -> LapIndex:
        return LapIndex.build(self.view.counter)

    @cached_property
    def files(self) -> DataFrame:
        return check_files(self.view.readings, self.index, self.view.cycles, self.view.robot_observable)

    @cached_property
    def short_files(self) -> DataFrame:
        """The same readings in files of four hours, many of which lie within one lap."""
        part = F.floor(F.hour("time") / 4).cast("string")
        return self.view.readings.withColumn("file_id", F.concat_ws("|", "file_id", part))

    @cached_property
    def short_verdicts(self) -> DataFrame:
        return check_files(self.short_files, self.index, self.view.cycles, self.view.robot_observable)

    @cached_property
    def cells(self) -> DataFrame:
        return finalise_cells(cell_partials(self.view.readings, self.files, self.index))

    @cached_property
    def stored_cells(self) -> DataFrame:
        """Cells as a table, for plans that scan them more than once."""
        return stage(self.cells, "cells")

    @cached_property
    def last(self) -> DataFrame:
        return stage(marks.last_rows(self.stored_cells), "last-rows")

    @cached_property
    def dims(self) -> DataFrame:
        cycles = self.view.cycles.select(F.col("id").alias("round_id"))
        return cycles.select("round_id", F.lit(X_DIM).alias("x_dim"), F.lit(Y_DIM).alias("y_dim"))

    @cached_property
    def split(self) -> DataFrame:
        """Midnight in the middle of each cycle; what lies before it plays the part of earlier runs."""
        mid = tp.from_seconds(F.floor((tp.seconds(F.min("lo")) + tp.seconds(F.max("hi"))) / 2))
        return self.view.spans.groupBy("round_id").agg(tp.trunc("DAY", mid).alias("split"))

    def before(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.split, "round_id").filter(F.col("time") < F.col("split")).drop("split")

    def after(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.split, "round_id").filter(F.col("time") >= F.col("split")).drop("split")

    @cached_property
    def earlier_cells(self) -> DataFrame:
        return self.before(self.stored_cells)

    @cached_property
    def earlier_last(self) -> DataFrame:
        return stage(marks.last_rows(self.earlier_cells), "earlier-last-rows")

    # Roll-ups of all cells ---------------------------------------------------------------------------------------------

    @cached_property
    def rounds(self) -> DataFrame:
        return rollups.round_over_time(self.stored_cells, self.last)

    @cached_property
    def rounds_space(self) -> DataFrame:
        return rollups.round_over_space(self.rounds, self.view.counter)

    @cached_property
    def days(self) -> DataFrame:
        return rollups.day_over_time(self.stored_cells, self.last)

    @cached_property
    def quadrants(self) -> DataFrame:
        return rollups.tod_over_time(self.stored_cells, self.last)
