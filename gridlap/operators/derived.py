"""Derived observables: readiness, laps to compute, input join and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions.formulas import derived
from ..functions.numbers import nan_to_null
from ..schemas import CELL_COLUMNS, NEVER

MATCH = ["round_id", "round_number", "time", "x", "y"]


def newer_inputs(cells: DataFrame, name: str, stored: DataFrame | None = None) -> DataFrame:
    """Cells of the inputs of ``name`` after the cycle's last stored row of it."""
    inputs = cells.filter(F.col("observable_name").isin(*derived(name).inputs))
    if stored is None:
        return inputs
    done = stored.filter(F.col("observable_name") == name).groupBy("round_id").agg(F.max("time").alias("_done"))
    fresh = F.col("time") > F.coalesce("_done", tp.ntz(NEVER))
    return inputs.join(done, "round_id", "left").filter(fresh).drop("_done")


def ready_cycles(cells: DataFrame, name: str, stored: DataFrame | None = None) -> DataFrame:
    """Per cycle: is there a newer row of every input."""
    needed = derived(name).inputs
    found = [F.max(F.when(F.col("observable_name") == o, 1).otherwise(0)) for o in needed]
    return newer_inputs(cells, name, stored).groupBy("round_id").agg((reduce(lambda a, b: a + b, found) == len(needed)).alias("ready"))


def round_range(cells: DataFrame, name: str, counter: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """First and last lap to compute per cycle.

    With at least two valid counter rows after the last stored time they span the range; otherwise it runs from the last stored
    lap (0 if none) to the last valid lap of the counter.
    """
    cycles = cells.select("round_id").distinct()
    valid = counter.filter(F.col("is_valid_round") == 1).withColumn(
        "key", tp.order_key(F.col("time"), F.col("round_number"))
    )
    if stored is None:
        done = cycles.select("round_id", F.lit(None).cast("timestamp_ntz").alias("done"), F.lit(0).alias("done_round"))
    else:
        newest = F.max(tp.order_key(F.col("time"), F.col("round_number")))
        done = (
            stored.filter(F.col("observable_name") == name)
            .groupBy("round_id")
            .agg(F.max("time").alias("done"), tp.key_tie(newest).alias("done_round"))
        )
    fresh = F.col("time") > F.coalesce("done", tp.ntz(NEVER))
    laps = (
        valid.join(done, "round_id", "left")
        .groupBy("round_id")
        .agg(
            F.count(F.when(fresh, 1)).alias("fresh"),
            tp.key_tie(F.min(F.when(fresh, F.col("key")))).alias("first_fresh"),
            tp.key_tie(F.max("key")).alias("last_valid"),
            F.max(F.coalesce("done_round", F.lit(0))).alias("done_round"),
        )
    )
    many = F.col("fresh") >= 2
    return cycles.join(laps, "round_id").select(
        "round_id",
        F.when(many, F.col("first_fresh")).otherwise(F.col("done_round")).alias("first_round"),
        F.col("last_valid").alias("last_round"),
    )


def join_inputs(inputs: DataFrame, name: str) -> DataFrame:
    """Inner join of the inputs on lap, time and square; one column per input.

    Height, day and observable type come from the first input. The other inputs are reduced to one row per key first (lowest height), so a
    key never multiplies.
    """
    first, *others = derived(name).inputs
    joined = inputs.filter(F.col("observable_name") == first).select(
        *MATCH, "z", "day_of_production", "obs_type", F.col("value").alias(first)
    )
    for other in others:
        side = inputs.filter(F.col("observable_name") == other).groupBy(*MATCH).agg(F.min_by("value", "z").alias(other))
        joined = joined.join(side, MATCH)
    return joined


def derive(
    cells: DataFrame,
    name: str,
    counter: DataFrame | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Cells of the derived observable ``name`` for all laps at once; results that are not a number become 0.

    With ``counter`` only cycles that are ready and laps in :func:`round_range` are computed.
    """
    inputs = newer_inputs(cells, name, stored)
    if counter is not None:
        ready = ready_cycles(cells, name, stored).filter("ready").select("round_id")
        laps = round_range(cells, name, counter, stored).join(ready, "round_id", "left_semi")
        inputs = inputs.join(laps, "round_id").filter(F.col("round_number").between(F.col("first_round"), F.col("last_round")))
    joined = join_inputs(inputs, name)
    spec = derived(name)
    value = F.coalesce(nan_to_null(spec.formula({o: F.col(o) for o in spec.inputs})), F.lit(0.0))
    return joined.select("*", value.alias("value"), F.lit(name).alias("observable_name")).select(*CELL_COLUMNS)
