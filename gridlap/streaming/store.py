"""Stored tables as plain parquet folders on shared storage.

Two kinds of writes, both safe to repeat:

* **batch tables** (partials, alerts, audit, triggers) have one folder per micro-batch; writing a batch again replaces its folder.
* **sliced tables** (cells, roll-ups, display rows, state) are partitioned by cycle and slice; a write replaces exactly the slices it
  recomputed. Where it recomputed only some cycles' observables, it carries the other rows of these slices over.

Batch tables that are read back as a whole (``log``) are folded every few batches, so that a batch opens a bounded number of files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..operators.cells import merge_partials
from ..schemas import STORED_DDL
from ..session import stage
from .fence import Files

# How many units share a slice.
LAPS_PER_SLICE = 16
DAYS_PER_SLICE = 8
FOLD_AFTER = 16
FILE_BUCKETS = 32


def _date_slice(time: Column) -> Column:
    return F.unix_date(F.to_date(time))


def lap_slice(number: Column) -> Column:
    return F.floor(number / LAPS_PER_SLICE).cast("int")


def day_slice(day: Column) -> Column:
    return F.floor(day / DAYS_PER_SLICE).cast("int")


def quadrant_slice(time: Column) -> Column:
    return _date_slice(tp.window_start(time))


def hour_slice(time: Column) -> Column:
    return _date_slice(time)


# Slice of a stored row.
ROW_SLICES: dict[str, Callable[[], Column]] = {
    "cells": lambda: lap_slice(F.col("round_number")),
    "latest_over_time": lambda: F.lit(0),
    "latest_over_space": lambda: F.lit(0),
    "round_over_time": lambda: lap_slice(F.col("round_number")),
    "round_over_space": lambda: lap_slice(F.col("round_number")),
    "day_over_time": lambda: day_slice(F.col("day")),
    "day_over_space": lambda: day_slice(F.col("day")),
    "tod_over_time": lambda: _date_slice(F.col("window_start")),
    "tod_over_space": lambda: _date_slice(F.col("window_start")),
    "hourly_overview": lambda: hour_slice(F.col("time")),
    "frontend_data": lambda: F.lit(0),
    "unit_marks": lambda: F.lit(0),
    "latest_cells": lambda: F.lit(0),
    "cell_spans": lambda: F.col("lap_block"),
}
# Batch tables that later batches look back on.
LOGS = ["accepted_files", "counter_changes", "dim_changes"]
# Folders inside a batch, for tables that are looked up by part.
BATCH_PARTS = {"accepted_files": ["file_bucket"]}


def file_bucket(file_id: Column) -> Column:
    return F.pmod(F.xxhash64(file_id), F.lit(FILE_BUCKETS)).cast("int")


def _selective(keys: DataFrame) -> DataFrame:
    """The touched keys, with a comparison that always holds.

    Dynamic partition pruning is planned only where the small side of the join carries a predicate; with it, folders of other
    cycles and slices are not read.
    """
    return keys.filter(F.col("round_id") >= F.lit(""))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _load(self, table: str, extra: str, folders: list[str] | None = None) -> DataFrame:
        """Rows of a table, or of some of its folders."""
        # An explicit schema keeps partition values such as '007' as the strings they are.
        ddl = f"{STORED_DDL[table]}, {extra}" if extra else STORED_DDL[table]
        if folders == []:
            return self.spark.createDataFrame([], ddl)
        reader = self.spark.read.schema(ddl)
        try:
            if folders is None:
                return reader.parquet(self.path(table))
            return reader.option("basePath", self.path(table)).parquet(*[f"{self.path(table)}/{f}" for f in folders])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ddl)

    def _numbers(self, table: str, prefix: str) -> list[int]:
        """Numbers of the finished folders ``prefix=n`` of a table."""
        files = Files(self.spark)
        names = [n for n in files.names(self.path(table)) if n.startswith(f"{prefix}=")]
        return sorted(int(n.split("=")[1]) for n in names if files.exists(f"{self.path(table)}/{n}/_SUCCESS"))

    # Batch tables -------------------------------------------------------------------------------------------------------

    def put_batch(self, table: str, df: DataFrame, batch_id: int) -> None:
        """Write the rows of one micro-batch; a repeated batch replaces what its first attempt left."""
        target = f"{self.path(table)}/batch_id={batch_id}"
        if table == "partials":
            # Spread by place, so that a cycle with most of the readings is not written by one task.
            rows = df.withColumn("slice", lap_slice(F.col("round_number"))).repartition("round_id", "slice", "x", "y")
            rows.write.mode("overwrite").partitionBy("round_id", "slice").parquet(target)
        else:
            df.write.mode("overwrite").partitionBy(*BATCH_PARTS.get(table, [])).parquet(target)

    def batch(self, table: str, batch_id: int) -> DataFrame:
        """Rows of one micro-batch; only its folder is looked at."""
        return self._load(table, "batch_id bigint", [f"batch_id={batch_id}"])

    def batches_of(self, table: str, numbers: list[int]) -> DataFrame:
        """Rows of some micro-batches; a batch that wrote nothing yet has none."""
        done = set(self._numbers(table, "batch_id"))
        return self._load(table, "batch_id bigint", [f"batch_id={n}" for n in numbers if n in done])

    def log(self, table: str, before: int) -> DataFrame:
        """All rows of the batches before one, from the last fold and the batches since."""
        folds = [n for n in self._numbers(f"{table}_folds", "upto") if n < before]
        since = [n for n in self._numbers(table, "batch_id") if (folds[-1] if folds else -1) < n < before]
        rows = self._load(table, "batch_id bigint", [f"batch_id={n}" for n in since])
        if not folds:
            return rows
        kept = self.spark.read.schema(f"{STORED_DDL[table]}, batch_id bigint").parquet(f"{self.path(table)}_folds/upto={folds[-1]}")
        return rows.unionByName(kept)

    def fold(self, table: str, before: int) -> None:
        """Once enough batches have gathered since the last fold, write all rows before ``before`` as a new one.

        These batches are finished and never written again, so a fold is the same whoever writes it.
        """
        folds = [n for n in self._numbers(f"{table}_folds", "upto") if n < before]
        since = [n for n in self._numbers(table, "batch_id") if (folds[-1] if folds else -1) < n < before]
        if len(since) >= FOLD_AFTER:
            target = f"{self.path(table)}_folds/upto={since[-1]}"
            self.log(table, before).coalesce(1).write.mode("overwrite").partitionBy(*BATCH_PARTS.get(table, [])).parquet(target)

    def batches(self, table: str, before: int | None = None) -> DataFrame:
        df = self._load(table, "batch_id bigint")
        return df if before is None else df.filter(F.col("batch_id") < before)

    def sums(self, slices: DataFrame, upto: int) -> DataFrame:
        """Partial sums of some slices as the batches up to ``upto`` wrote them."""
        rows = self._load("partials", "batch_id bigint, slice int").filter(F.col("batch_id") <= upto)
        return rows.join(_selective(slices.select("round_id", "slice")), ["round_id", "slice"], "left_semi")

    def partials(self, slices: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """Partial sums, one row per cell; ``slices`` (round_id and optionally slice) prunes the folders that are read."""
        rows = self._load("partials", "batch_id bigint, slice int")
        if before is not None:
            rows = rows.filter(F.col("batch_id") < before)
        if slices is not None:
            key = [c for c in ("round_id", "slice") if c in slices.columns]
            rows = rows.join(_selective(slices.select(*key)), key, "left_semi")
        return merge_partials(rows)

    def compact(self, target: Store) -> None:
        """Fold all batches into one in a fresh store, with the sliced tables and what is remembered between batches.

        A stream started on ``target`` goes on behind the last batch. Alerts, audit and triggers stay where they are.
        """
        newest = self.batches("partials").agg(F.max("batch_id")).first()[0]
        if newest is None:
            return
        target.put_batch("partials", self.partials(), newest)
        for table in ROW_SLICES:
            rows = self._load(table, "slice int, is_empty boolean")
            rows.repartition("round_id", "slice").write.mode("overwrite").partitionBy("round_id", "slice").parquet(target.path(table))
        for table in LOGS:
            parts = BATCH_PARTS.get(table, [])
            self.log(table, newest + 1).write.mode("overwrite").partitionBy(*parts).parquet(f"{target.path(table)}_folds/upto={newest}")

    # Sliced tables ------------------------------------------------------------------------------------------------------

    def read(self, table: str, slices: DataFrame | None = None) -> DataFrame:
        """Rows of a sliced table, optionally only of some cycles (``round_id``) or slices (``round_id``, ``slice``); other folders are not read."""
        rows = self._load(table, "slice int, is_empty boolean").filter(~F.col("is_empty"))
        if slices is not None:
            key = [c for c in ("round_id", "slice") if c in slices.columns]
            rows = rows.join(_selective(slices.select(*key)), key, "left_semi")
        return rows.select(*_columns(table))

    def replace_slices(self, table: str, df: DataFrame, slices: DataFrame, only: DataFrame | None = None) -> None:
        """Replace ``slices`` (round_id, slice) by the rows of ``df`` that fall into them.

        With ``only`` (some key columns, such as round_id and observable_name) rows of other keys in these slices stay as they are. Every slice
        gets a marker row, so that one left without rows is replaced too.
        """
        df = df.select(*_columns(table))
        if only is not None:
            kept = self.read(table, slices).join(only, only.columns, "left_anti")
            df = stage(df.join(only, only.columns, "left_semi").unionByName(kept), f"carried-{table}")
        rows = df.withColumns({"slice": ROW_SLICES[table](), "is_empty": F.lit(False)}).join(slices, ["round_id", "slice"], "left_semi")
        markers = slices.select("round_id", "slice", F.lit(True).alias("is_empty"))
        (
            rows.unionByName(markers, allowMissingColumns=True)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("round_id", "slice")
            .parquet(self.path(table))
        )


def _columns(table: str) -> list[str]:
    return [part.split()[0].strip("`") for part in STORED_DDL[table].split(", ")]
