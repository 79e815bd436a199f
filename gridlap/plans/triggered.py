"""Jobs that stored triggers call for: roll-ups by event triggers, display rows by the display triggers that follow from them.

All units (event kind, cycle, observable) of a batch of triggers are computed together, one job for each event kind. Where such a job fails, its units are halved
until those that fail stand alone; they are set aside with their error and the others are finished.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import alerts, triggers
from ..operators.heatmaps import with_dims
from ..operators.marks import KEY
from ..session import side_by_side, stage
from ..streaming.store import Store
from .frontend import OUTPUT_KINDS, event_outputs
from .jobs import JOBS
from .pipeline import Controls, refresh_event, stored_rollups

log = logging.getLogger(__name__)
Failed = list[tuple[DataFrame, str]]


def isolated(work: Callable[[DataFrame], None], units: DataFrame, depth: int = 0) -> Failed:
    """Runs ``work`` on units (KEY) and returns those it fails for, with the error.

    Units are halved by one more bit of their hash each time, so they are never listed on the driver. A unit that fails alone is tried once more,
    because its first failure may have been the cluster's.
    """
    try:
        work(units)
        return []
    except (PySparkException, Py4JJavaError) as e:
        error = str(e).strip().splitlines()[0][:500]
        log.warning("units failed at depth %d: %s", depth, error)
    size = units.count()
    if size <= 1:
        try:
            work(units)
            return []
        except (PySparkException, Py4JJavaError):
            return [(units, error)] if size else []
    bit = F.shiftright(F.xxhash64(*KEY), depth % 64).bitwiseAND(F.lit(1).cast("long"))
    halves = [stage(units.filter(bit == side), "half") for side in (0, 1)]
    return [failed for half in halves if not half.isEmpty() for failed in isolated(work, half, depth + 1)]


def _failed_rows(event: str, failed: Failed) -> list[DataFrame]:
    return [units.select(F.lit(event).alias("event_type"), *KEY, F.lit(error).alias("error")) for units, error in failed]


def _put_failed(store: Store, rows: list[DataFrame], number: int, stage_name: str) -> DataFrame:
    found = reduce(DataFrame.unionByName, rows, store.spark.createDataFrame([], S.STORED_DDL["failed_events"]))
    store.put_batch(f"failed_{stage_name}", found, number)
    return store.batch(f"failed_{stage_name}", number)


def run_events(store: Store, controls: Controls, rows: DataFrame, number: int) -> DataFrame:
    """Roll-ups named by trigger ``rows`` (with the batch_id that raised them), then the display triggers of those that were finished.

    Only the slices that these batches touched are recomputed, for the named cycles and observables alone. Returns the units set aside.
    Derived cells are written with the batch that brings their inputs, so a trigger of that kind has no roll-up of its own.
    """
    rows = stage(rows, "event-rows")
    batches = [r.batch_id for r in rows.select("batch_id").distinct().collect()]  # one for each file of the micro-batch
    touched = stage(store.batches_of("touched_units", batches).drop("batch_id").distinct(), "touched")

    def run(event: str) -> Failed:
        named = stage(rows.filter(F.col("event_type") == event).select(*KEY).distinct(), "named")
        if named.isEmpty():
            return []
        return isolated(partial(_roll_up, event), named)

    def _roll_up(event: str, named: DataFrame) -> None:
        units = stage(touched.join(named.select("round_id").distinct(), "round_id", "left_semi"), "units")
        refresh_event(store, controls, event, units, named)

    results = side_by_side(*[partial(run, event) for event in JOBS])
    known = [*JOBS, S.DERIVED_OBSERVABLE]
    strange = rows.filter(~F.col("event_type").isin(known)).select("event_type", *KEY, F.lit("unknown event kind").alias("error")).distinct()
    failed = _put_failed(store, [strange, *[r for event, f in zip(JOBS, results) for r in _failed_rows(event, f)]], number, "events")
    done = rows.drop("batch_id").distinct().join(failed.select("event_type", *KEY), ["event_type", *KEY], "left_anti")
    store.put_batch("frontend_triggers", triggers.frontend_triggers(done), number)
    return failed


def run_frontend(store: Store, controls: Controls, rows: DataFrame, number: int) -> DataFrame:
    """Display rows named by display trigger ``rows``; named outputs without data become alerts. Returns the units set aside."""
    rows = stage(rows.select("event_type", *KEY).distinct(), "frontend-rows")

    def run(event: str) -> tuple[Failed, DataFrame | None]:
        named = stage(rows.filter(F.col("event_type") == event).select(*KEY), "named")
        if named.isEmpty():
            return [], None
        return isolated(partial(_display, event), named), named

    def _display(event: str, named: DataFrame) -> None:
        documents = stage(_documents(store, controls, event, named), "documents")
        # The rows to replace: all kinds of output of this event, also those that have nothing to show now.
        replaced = named.withColumn("event_type", F.explode(F.array(*[F.lit(k) for k, _ in OUTPUT_KINDS[event]])))
        plots.append(documents.select("round_id", "observable_name", "event_type", "type_of_plot"))
        shown.append((documents, stage(replaced, "replaced")))

    shown: list[tuple[DataFrame, DataFrame]] = []
    plots: list[DataFrame] = []
    results = {event: run(event) for event in JOBS}
    if shown:
        documents, replaced = (reduce(DataFrame.unionByName, frames) for frames in zip(*shown))
        replaced = stage(replaced.distinct(), "replaced")
        cycles = stage(replaced.select("round_id", F.lit(0).alias("slice")).distinct(), "cycles")
        store.replace_slices("frontend_data", documents, cycles, replaced.select("round_id", "observable_name", "event_type"))
    failed = _put_failed(store, [r for event, (f, _) in results.items() for r in _failed_rows(event, f)], number, "displays")
    _put_output_alerts(store, controls, results, plots, failed, number)
    return failed


def _documents(store: Store, controls: Controls, event: str, named: DataFrame) -> DataFrame:
    tables = stored_rollups(store, controls, stage(named.select("round_id").distinct(), "cycles"))
    for name, table in vars(tables).items():
        if isinstance(table, DataFrame) and set(KEY) <= set(table.columns):
            setattr(tables, name, table.join(named, KEY, "left_semi"))
    return event_outputs(event, tables)


def _put_output_alerts(store: Store, controls: Controls, results: dict, plots: list[DataFrame], failed: DataFrame, number: int) -> None:
    """Alerts about outputs without data, and about places outside the grid of what has new latest values."""
    expected = []
    for event, (_, named) in results.items():
        if named is not None:
            kinds = F.array(*[F.struct(F.lit(k).alias("event_type"), F.lit(p).alias("type_of_plot")) for k, p in OUTPUT_KINDS[event]])
            fine = named.join(failed.filter(F.col("event_type") == event).select(*KEY), KEY, "left_anti")
            expected.append(fine.select(*KEY, F.explode(kinds).alias("k")).select(*KEY, "k.*"))
    found = store.spark.createDataFrame([], S.STORED_DDL["output_alerts"])
    if expected:
        none = store.spark.createDataFrame([], "round_id string, observable_name string, event_type string, type_of_plot string")
        found = found.unionByName(alerts.empty_output_alerts(reduce(DataFrame.unionByName, expected), reduce(DataFrame.unionByName, plots, none)))
    named = results[S.LATEST][1]
    if named is not None:
        latest = store.read("latest_over_time", named.select("round_id").distinct()).join(named, KEY, "left_semi")
        found = found.unionByName(alerts.coordinate_alerts(with_dims(latest, controls.dims)))
    store.put_batch("output_alerts", found, number)
