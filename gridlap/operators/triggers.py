"""Which follow-up jobs a batch calls for, as rows with a routing key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import timeparts as tp
from ..functions.formulas import derived, derived_from_all, derived_names
from .marks import KEY, last_rows

CONTEXT = ["robot_id", "x_dim", "y_dim", "obs_type"]
SENDER = [*KEY, "robot_id"]


def batch_context(rows: DataFrame) -> DataFrame:
    """Grid size and type per cycle, observable and robot of a batch, from its readings or, one row each, its files."""
    return rows.groupBy(*SENDER).agg(*[F.max(c).alias(c) for c in CONTEXT if c not in SENDER])


def derived_context(context: DataFrame) -> DataFrame:
    """Context of the derived observables that the observables of a batch lead to, directly or through others."""
    inputs = sorted({o for n in derived_names() for o in derived(n).inputs})
    names = F.create_map(*[F.lit(x) for o in inputs for x in (o, F.array(*[F.lit(n) for n in derived_from_all(o)]))])
    reached = F.explode(F.try_element_at(names, F.col("observable_name")))
    return batch_context(context.withColumn("observable_name", reached))


def new_units(batch_cells: DataFrame, stored: DataFrame, tod_marks: DataFrame) -> DataFrame:
    """Flags per cycle and observable: does the batch's last cell open a new lap, day, quadrant or hour.

    ``stored`` is :func:`marks.last_rows` of the cells before the batch, ``tod_marks`` the last time-of-day roll-up.
    """
    batch = last_rows(batch_cells).select(
        *KEY, F.col("last_round_number").alias("lap"), F.col("last_day").alias("day"), F.col("last_time").alias("time")
    )
    rows = batch.join(stored, KEY, "left").join(tod_marks.select(*KEY, "mark"), KEY, "left")
    elapsed = tp.seconds(F.col("time")) - tp.seconds(F.coalesce("last_time", tp.ntz(S.NEVER)))
    quadrant_changed = tp.quadrant(F.col("time")) != tp.quadrant(F.col("mark"))
    return rows.select(
        *KEY,
        "lap",
        "day",
        "time",
        (F.col("lap") != F.coalesce("last_round_number", F.lit(0))).alias("is_new_round"),
        (F.col("day") != F.coalesce("last_day", F.lit(0))).alias("is_new_day"),
        (F.col("mark").isNull() | quadrant_changed | (F.datediff("time", "mark") > 1)).alias("is_new_time_of_day"),
        (F.floor(elapsed / 3600) >= 1).alias("is_new_hourly_overview"),
    )


def _routed(events: DataFrame, routing: dict[str, str]) -> DataFrame:
    key = F.create_map(*[F.lit(v) for pair in routing.items() for v in pair])
    return events.withColumn("routing_key", F.try_element_at(key, F.col("event_type")))


def time_triggers(units: DataFrame, context: DataFrame, with_derived: bool = True) -> DataFrame:
    """Trigger rows per robot: LATEST always, the others by flag, and one per derived observable that takes this one as an input."""

    def event(kind: str, observable="observable_name"):
        name = F.col(observable) if observable == "observable_name" else F.lit(observable)
        return F.struct(F.lit(kind).alias("event_type"), name.alias("observable_name"))

    wanted = [
        event(S.LATEST),
        F.when(F.col("is_new_round"), event(S.NEW_ROUND)),
        F.when(F.col("is_new_day"), event(S.NEW_DAY)),
        F.when(F.col("is_new_time_of_day"), event(S.NEW_TIME_OF_DAY)),
        F.when(F.col("is_new_hourly_overview"), event(S.NEW_HOURLY_OVERVIEW)),
    ]
    if with_derived:
        for name in derived_names():
            is_input = F.col("observable_name").isin(*derived(name).inputs)
            wanted.append(F.when(is_input, event(S.DERIVED_OBSERVABLE, name)))
    exploded = (
        units.join(context, KEY)
        .select("round_id", *CONTEXT, F.explode(F.array_compact(F.array(*wanted))).alias("e"))
        .select("e.event_type", "round_id", "robot_id", "e.observable_name", "x_dim", "y_dim", "obs_type")
    )
    return _routed(exploded, S.EVENT_ROUTING)


def frontend_triggers(events: DataFrame) -> DataFrame:
    """Display triggers that follow the roll-ups of ``events``; derived observables have no display of their own kind."""
    shown = events.drop("routing_key").filter(F.col("event_type").isin(*S.FRONTEND_ROUTING))
    return _routed(shown, S.FRONTEND_ROUTING)
