"""Registered queries that run batches against a store of their own, over the whole sensor view."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import timeparts as tp
from ..functions.formulas import derived_names
from ..operators import alerts, derived, marks, rollups, series, triggers
from ..operators.cells import finalise_cells
from ..session import stage, staging_dir
from ..sources import messages, scans
from ..streaming.store import Store
from .pipeline import Controls, finish_batch, ingest, ingest_readings
from .queries import query, rounded
from .sample import Sample
from .triggered import run_events

# Fixed value: the observable whose triggers are held back.
HELD_BACK = "humidity"


def _store(s: Sample) -> Store:
    return Store(s.spark, f"{staging_dir(s.spark).rstrip('/')}/gridlap/store-{uuid.uuid4().hex}")


def _controls(s: Sample, counter: DataFrame | None = None, sensors: DataFrame | None = None) -> Controls:
    counter = stage(s.view.counter if counter is None else counter, "counter")
    return Controls(counter, s.view.cycles, s.view.robot_observable if sensors is None else sensors, s.dims)


def _take(store: Store, readings: DataFrame, controls: Controls, number: int, rollups: bool = False) -> None:
    finish_batch(store, ingest_readings(store, stage(readings, "batch"), controls, number), controls, number, frontend=False, rollups=rollups)


@query
def triggered_outputs(s: Sample) -> DataFrame:
    """Two batches: all roll-ups after the first; after the second only what triggers name, and those of one observable are held back."""
    store, controls = _store(s), _controls(s)
    _take(store, s.before(s.view.readings), controls, 0, rollups=True)
    _take(store, s.after(s.view.readings), controls, 1)
    named = store.batch("triggers", 1).unionByName(store.batch("derived_triggers", 1)).filter(F.col("observable_name") != HELD_BACK)
    run_events(store, controls, named, 0)
    measured = ~F.col("observable_name").isin(derived_names())

    def rows(table: str, unit: str | None) -> DataFrame:
        number = F.col(unit) if unit else F.lit(None).cast("int")
        return store.read(table).filter(measured).select(F.lit(table).alias("kind"), *S.SERIES_KEY, number.alias("unit"), "time", "mean", "sd", "total")

    tables = {"round_over_space": "round_number", "day_over_space": "day", "tod_over_space": "time_of_day", "hourly_overview": None}
    return rounded(reduce(DataFrame.unionByName, [rows(t, u) for t, u in tables.items()]), "mean", "sd", "total")


@query
def triggered_places(s: Sample) -> DataFrame:
    """Newest value of every place after two batches, the second by triggers alone."""
    store, controls = _store(s), _controls(s)
    _take(store, s.before(s.view.readings), controls, 0, rollups=True)
    _take(store, s.after(s.view.readings), controls, 1)
    run_events(store, controls, store.batch("triggers", 1).filter(F.col("event_type") == S.LATEST), 0)
    return rounded(store.read("latest_over_time").filter(~F.col("observable_name").isin(derived_names())), "value")


@query
def late_invalidation(s: Sample) -> DataFrame:
    """Cells stored while the counter lacked the second starts of laps; a batch without readings brings these in and retracts what they void."""
    store = _store(s)
    key = ["round_id", "round_number"]
    starts = s.view.counter.join(s.view.counter.groupBy(*key).agg(F.min("time").alias("_first")), key)
    early = starts.filter(F.col("time") == F.col("_first")).select(*s.view.counter.columns)
    _take(store, s.view.readings, _controls(s, counter=early), 0)
    _take(store, s.view.readings.limit(0), _controls(s), 1)
    return rounded(store.read("cells"), "value")


@query
def stored_marks(s: Sample) -> DataFrame:
    """Newest cell, newest and last closed quadrant per cycle and observable, carried over two batches."""
    store, controls = _store(s), _controls(s)
    _take(store, s.before(s.view.readings), controls, 0)
    _take(store, s.after(s.view.readings), controls, 1)
    return store.read("unit_marks").filter(~F.col("observable_name").isin(derived_names())).select(*marks.KEY, *marks.STATE)


def _json_line() -> Column:
    place = F.array(*[F.col(c).cast("double") for c in "xyz"])
    time = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.to_json(F.struct(place.alias("coordinates"), time.alias("timestamp"), F.col("value").alias("data"), F.lit("").alias("unit")))


def _files(s: Sample) -> DataFrame:
    """The readings as files of JSON lines, one row each, in the form messages are parsed to."""
    lines = s.view.readings.withColumn("line", F.struct("time", "x", "y", "value", _json_line().alias("text")))
    keys = ["file_id", *messages.FILE_FIELDS]
    content = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda r: r["text"]), "\n")
    return lines.groupBy(*keys).agg(content.alias("content"))


@query
def cells_repeated_files(s: Sample) -> DataFrame:
    """All files are delivered twice. The first time one sensor is not allowed yet: its files count at their second delivery, the others at their first."""
    store, files = _store(s), stage(_files(s), "files")
    closed = s.view.robot_observable.filter(F.col("observable_id") != HELD_BACK)
    ingest(store, files, _controls(s, sensors=closed), 0)
    ingest(store, files, _controls(s), 1)
    return rounded(finalise_cells(store.partials()), "value")


@query
def quarantine_rows(s: Sample) -> DataFrame:
    """Lines of files in which every fifth reading is spoiled in one of four ways, kept apart with their number and why."""
    files = s.view.readings.select("file_id", *messages.FILE_FIELDS, "time", "x", "y", "value", F.unix_micros(F.col("time").cast("timestamp")).alias("_t"))
    seconds = F.floor(F.col("_t") / 1_000_000)
    wire = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    number = F.col("value").cast("decimal(20,4)").cast("string")
    spoiled = (
        F.when(seconds % 20 == 0, F.concat_ws(",", wire, "x", "y", F.lit("0"), F.lit("n/a")))
        .when(seconds % 20 == 5, F.concat_ws(",", F.lit("yesterday"), "x", "y", F.lit("0"), number))
        .when(seconds % 20 == 10, F.concat_ws(",", wire, F.lit("left"), "y", F.lit("0"), number))
        .when(seconds % 20 == 15, F.concat_ws(",", wire, "x", "y", F.lit("0"), number, F.lit("more")))
        .otherwise(F.concat_ws(",", wire, "x", "y", F.lit("0"), number))
    )
    rows = F.array_sort(F.collect_list(F.struct("_t", "x", "y", "value", spoiled.alias("line"))))
    content = F.array_join(F.concat(F.array(F.lit("timestamp,x,y,z,value")), F.transform(rows, lambda r: r["line"])), "\n")
    envelopes = files.groupBy("file_id", *messages.FILE_FIELDS).agg(content.alias("content"))
    return messages.quarantined(messages.envelope_readings(stage(envelopes, "files"), keep_bad=True))


@query
def derived_trigger_rows(s: Sample) -> DataFrame:
    """Triggers that derived observables raise from their own newest cells; cells are stamped with their day, so that sensors meet."""
    aligned = s.stored_cells.withColumn("time", tp.trunc("DAY", F.col("time")))
    cells = stage(reduce(DataFrame.unionByName, [derived.derive(aligned, name) for name in derived_names()]), "derived")
    before, after = s.before(cells), s.after(cells)
    stored = marks.cell_state(before)
    units = triggers.new_units(after, stored, marks.last_quadrant(stored))
    return triggers.time_triggers(units, triggers.derived_context(triggers.batch_context(s.after(s.view.readings))))


@query
def empty_outputs(s: Sample) -> DataFrame:
    """Graphs without data in the first sixty hours of each cycle, when most units are still running."""
    starts = s.view.spans.groupBy("round_id").agg(F.min("lo").alias("_lo"))
    cells = stage(s.stored_cells.join(starts, "round_id").filter(F.col("time") < F.col("_lo") + tp.hours(60)).drop("_lo"), "first-cells")
    last = stage(marks.last_rows(cells), "last")
    found = [
        series.latest_series(rollups.latest_over_space(cells)),
        series.round_series(rollups.round_over_space(rollups.round_over_time(cells, last), s.view.counter)),
        series.day_series(rollups.day_over_space(rollups.day_over_time(cells, last))),
        series.tod_series(rollups.tod_over_space(rollups.tod_over_time(cells, last))),
    ]
    plot = F.lit("graph").alias("type_of_plot")
    kinds = F.array(*[F.lit(k) for k in ("latest", "round", "new_day", "time_of_day")])
    expected = s.view.readings.select(*marks.KEY).distinct().select(*marks.KEY, F.explode(kinds).alias("event_type"), plot)
    return alerts.empty_output_alerts(expected, reduce(DataFrame.unionByName, [p.select(*marks.KEY, "event_type", plot) for p in found]))


# Scans of one cycle and observable. What they ask for.
CYCLE, OBSERVABLE, LAP, SINCE = "pc1", "temperature", 12, "2024-01-08 12:00:00"


@query
def scan_cells_since(s: Sample) -> DataFrame:
    return rounded(scans.cells_since(s.stored_cells, CYCLE, OBSERVABLE, SINCE), "value")


@query
def scan_round_cells(s: Sample) -> DataFrame:
    return rounded(scans.round_cells(s.stored_cells, CYCLE, OBSERVABLE, LAP), "value")


@query
def scan_latest_cells(s: Sample) -> DataFrame:
    return rounded(scans.latest_cells(s.stored_cells, CYCLE, OBSERVABLE, SINCE), "value")


@query
def scan_placed_rows(s: Sample) -> DataFrame:
    return rounded(scans.placed_rows(s.rounds, CYCLE, OBSERVABLE, "round_number"), "value")


@query
def scan_unit_times(s: Sample) -> DataFrame:
    return scans.unit_times(s.rounds_space, CYCLE, OBSERVABLE, "round_number")
