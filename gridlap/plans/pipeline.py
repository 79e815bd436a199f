"""The jobs of the engine on stored tables: take in a batch of files, refresh roll-ups, refresh display rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.formulas import derived_order
from ..operators import alerts, derived, invalidation, marks, rollups, triggers
from ..operators.cells import cell_partials, finalise_cells, merge_partials
from ..operators.heatmaps import with_dims
from ..operators.laps import LapIndex
from ..operators.quality import check_files
from ..session import side_by_side, stage
from ..sources.messages import envelope_manifest, envelope_readings, quarantined
from ..streaming.store import Store, day_slice, file_bucket, hour_slice, lap_slice, quadrant_slice
from .frontend import OUTPUTS, Rollups, event_outputs
from .jobs import JOBS


@dataclass
class Controls:
    """Control tables: lap counter, cycle starts, sensors per robot, grid size per cycle (round_id, x_dim, y_dim)."""

    counter: DataFrame
    cycles: DataFrame
    robot_observable: DataFrame
    dims: DataFrame


def _versions(store: Store, envelopes: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Files of a batch that no earlier batch has accepted, one row each, and those that one has.

    A file is its name and its content: a name that comes with other content is another file and gets part of its digest behind its name.
    Only the parts of the accepted files that the batch's names fall into are read.
    """
    header = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in envelopes.columns if c not in ("file_id", "digest")]
    files = envelopes.withColumn("digest", F.sha2(F.concat_ws("\u0001", *header), 256)).dropDuplicates(["file_id", "digest"])
    files = files.withColumn("file_bucket", file_bucket(F.col("file_id")))
    names = stage(files.select("file_bucket", "file_id").distinct(), "names")
    store.fold("accepted_files", batch_id)
    touched = names.select("file_bucket").distinct().filter(F.col("file_bucket") >= F.lit(0))
    accepted = store.log("accepted_files", batch_id).join(touched, "file_bucket", "left_semi")
    accepted = stage(accepted.join(names.select("file_id"), "file_id", "left_semi").select("file_id", "digest").distinct(), "accepted")
    repeated = files.join(accepted, ["file_id", "digest"], "left_semi")
    fresh = files.join(accepted, ["file_id", "digest"], "left_anti")
    first = fresh.groupBy("file_id").agg(F.min("digest").alias("_first")).join(
        accepted.select("file_id").distinct().withColumn("_known", F.lit(True)), "file_id", "left"
    )
    named = F.when(F.col("_known").isNull() & (F.col("digest") == F.col("_first")), F.col("file_id"))
    version = F.coalesce(named, F.concat("file_id", F.lit("#"), F.substring("digest", 1, 16)))
    fresh = fresh.join(first, "file_id").withColumns({"name": F.col("file_id"), "file_id": version}).drop("_first", "_known")
    return fresh, repeated


def control_changes(store: Store, controls: Controls, batch_id: int) -> DataFrame:
    """Writes how the lap counter differs from what earlier batches saw, and returns the laps (round_id, round_number) with a difference.

    A row that is gone is written without its validity.
    """
    key = ["round_id", "round_number", "time"]
    store.fold("counter_changes", batch_id)
    seen = store.log("counter_changes", batch_id).groupBy(*key).agg(F.max(F.struct("batch_id", "is_valid_round")).alias("m"))
    seen = seen.select(*key, F.col("m.is_valid_round").alias("_seen")).filter("_seen IS NOT NULL")
    now = controls.counter.groupBy(*key).agg(F.max("is_valid_round").alias("is_valid_round"))
    changed = now.join(seen, key, "full").filter(~F.col("is_valid_round").eqNullSafe(F.col("_seen")))
    store.put_batch("counter_changes", changed.select(*key, "is_valid_round"), batch_id)
    return store.batch("counter_changes", batch_id).select("round_id", "round_number").distinct()


def resized_cycles(store: Store, controls: Controls, batch_id: int) -> DataFrame:
    """Cycles whose grid differs from what earlier batches saw; what is new is written."""
    store.fold("dim_changes", batch_id)
    seen = store.log("dim_changes", batch_id).groupBy("round_id").agg(F.max(F.struct("batch_id", "x_dim", "y_dim")).alias("m"))
    seen = seen.select("round_id", F.col("m.x_dim").alias("_x"), F.col("m.y_dim").alias("_y"))
    same = F.col("x_dim").eqNullSafe(F.col("_x")) & F.col("y_dim").eqNullSafe(F.col("_y"))
    changed = controls.dims.join(seen, "round_id", "left").filter(~same).select("round_id", "x_dim", "y_dim")
    store.put_batch("dim_changes", changed, batch_id)
    return store.batch("dim_changes", batch_id).select("round_id").distinct()


def ingest(store: Store, envelopes: DataFrame, controls: Controls, batch_id: int) -> DataFrame:
    """Check and sum the files of one batch and write partials, alerts and the audit. Returns the touched (round_id, slice).

    ``envelopes`` are read several times: pass a table or a staged frame. A file that an earlier batch has accepted is reported and not
    counted a second time; one that was rejected may come again.
    """
    fresh, repeated = _versions(store, envelopes, batch_id)
    fresh = stage(fresh, "fresh-files")
    readings = stage(envelope_readings(fresh, keep_bad=True), "readings")
    return ingest_readings(store, readings, controls, batch_id, envelope_manifest(fresh), alerts.repeated_alerts(repeated), fresh)


def ingest_readings(
    store: Store,
    readings: DataFrame,
    controls: Controls,
    batch_id: int,
    manifest: DataFrame | None = None,
    more_alerts: DataFrame | None = None,
    versions: DataFrame | None = None,
) -> DataFrame:
    """:func:`ingest` from readings on; ``manifest`` names files that may have left none, ``versions`` (file_id, name, digest) what to remember."""
    index = LapIndex.build(controls.counter)
    files = stage(check_files(readings, index, controls.cycles, controls.robot_observable, manifest), "files")
    partials = stage(cell_partials(readings, files, index), "partials")
    accepted = files.filter("verdict IS NULL").select("file_id")
    context = triggers.batch_context((readings if manifest is None else manifest).join(accepted, "file_id", "left_semi"))
    found = alerts.file_alerts(files)
    changed = control_changes(store, controls, batch_id)
    tasks = [
        lambda: store.put_batch("partials", partials, batch_id),
        lambda: store.put_batch("alerts", found if more_alerts is None else found.unionByName(more_alerts), batch_id),
        lambda: store.put_batch("ingest_audit", alerts.ingest_audit(files, F.col("last_time")), batch_id),
        lambda: _put_triggers(store, partials, context, controls.counter, changed, batch_id),
    ]
    if "bad_line" in readings.columns:
        tasks.append(lambda: store.put_batch("quarantine", quarantined(readings), batch_id))
    if versions is not None:
        kept = versions.join(accepted, "file_id", "left_semi").select(F.col("name").alias("file_id"), "digest", "file_bucket")
        tasks.append(lambda: store.put_batch("accepted_files", kept, batch_id))
    side_by_side(*tasks)
    units = store.batch("new_units", batch_id)
    closing = _closed_laps(units.filter("is_known_cycle"), controls.counter)
    laps = partials.select("round_id", "round_number").unionByName(closing)
    touched = laps.select("round_id", lap_slice(F.col("round_number")).alias("slice"))
    # A lap whose counter rows changed is looked at again if it has cells.
    held = store.read("cell_spans", changed.select("round_id").distinct()).select("round_id", F.col("lap_block").alias("slice"))
    late = changed.select("round_id", lap_slice(F.col("round_number")).alias("slice")).distinct().join(held, ["round_id", "slice"], "left_semi")
    return stage(touched.unionByName(late).distinct(), "touched")


def _closed_laps(units: DataFrame, counter: DataFrame) -> DataFrame:
    """Laps of the counter that a batch closes: from the newest lap stored before it (of a new cycle: all) up to its own newest."""
    reach = units.groupBy("round_id").agg(F.max("stored_lap").alias("_from"), F.max("lap").alias("_to"))
    laps = counter.select("round_id", "round_number").join(reach, "round_id")
    reached = F.col("_from").isNull() | (F.col("round_number") >= F.col("_from"))
    return laps.filter(reached & (F.col("round_number") < F.col("_to"))).select("round_id", "round_number").distinct()


def _put_triggers(store: Store, partials: DataFrame, context: DataFrame, counter: DataFrame, changed: DataFrame, batch_id: int) -> None:
    """Triggers and discarded-lap alerts of a batch.

    What was stored before comes from the state beside which the batch itself will be marked, so a repeated batch raises the same
    triggers.
    """
    cycles = stage(partials.select("round_id").unionByName(changed.select("round_id")).distinct(), "trigger-cycles")
    stored = stage(marks.state_before(store.read("unit_marks", cycles), batch_id), "stored-state")
    newest = stored.groupBy("round_id").agg(F.max("last_round_number").alias("stored_lap"), F.lit(True).alias("is_known_cycle"))
    units = triggers.new_units(finalise_cells(partials), stored, marks.last_quadrant(stored)).join(newest, "round_id", "left")
    store.put_batch("new_units", units, batch_id)
    units = store.batch("new_units", batch_id)
    # Of laps closed before, those whose starts are other ones now.
    reopened = changed.join(newest, "round_id").filter(F.col("round_number") < F.col("stored_lap")).select("round_id", "round_number")
    closed = _closed_laps(units, counter).unionByName(reopened).distinct()
    side_by_side(
        lambda: store.put_batch("triggers", triggers.time_triggers(units, context), batch_id),
        lambda: store.put_batch("alert_notification", invalidation.invalid_alerts(counter, closed), batch_id),
    )


def refresh_cells(store: Store, controls: Controls, slices: DataFrame, batch_id: int) -> DataFrame:
    """Recompute the touched lap slices of the cell table: values, retraction, derived observables, and the state of their cycles.

    Returns, and keeps as ``touched_units``, the units of the touched cells before and after the batch, and everything between the newest
    units before and after. The cells before are those of the earlier batches' sums, so a repeated batch finds the same units. Only the
    touched slices are read, but for keys whose newest cell went away.
    """
    cycles = stage(slices.select("round_id").distinct(), "cycles")
    whole_cycles = cycles.withColumn("slice", F.lit(0))
    marked = stage(store.read("unit_marks", cycles), "marks")
    before = stage(marks.state_before(marked, batch_id), "state-before")
    units = ["round_id", "round_number", "day_of_production", "time"]
    sums = stage(store.sums(slices, batch_id), "slice-sums")
    old_units = finalise_cells(merge_partials(sums.filter(F.col("batch_id") < batch_id))).select(*units).distinct()

    measured = stage(finalise_cells(merge_partials(sums)), "measured")
    newest = measured.groupBy("round_id").agg(F.max("round_number").alias("n")).unionByName(
        before.select("round_id", F.col("last_round_number").alias("n"))
    )
    newest = newest.groupBy("round_id").agg(F.max("n").alias("newest"))
    closed = controls.counter.join(newest, "round_id").filter(F.col("round_number") < F.col("newest"))
    cells = stage(invalidation.drop_invalid(measured, controls.counter, closed), "kept")
    for name in derived_order():
        cells = cells.unionByName(derived.derive(cells, name))
    cells = stage(cells, "cells")
    block = lap_slice(F.col("round_number"))
    day, time = F.col("day_of_production"), F.col("time")
    spans = cells.groupBy("round_id", block.alias("lap_block")).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )
    side_by_side(lambda: store.replace_slices("cells", cells, slices), lambda: store.replace_slices("cell_spans", spans, slices))

    touched = before.withColumn("slice", lap_slice(F.col("last_round_number"))).join(slices, ["round_id", "slice"], "left_semi")
    after, unknown = marks.state_after(before, cells, touched)
    unknown = stage(unknown, "unknown")
    if not unknown.isEmpty():
        again = marks.cell_state(store.read("cells", unknown.select("round_id").distinct()).join(unknown, marks.KEY, "left_semi"))
        after = after.join(unknown, marks.KEY, "left_anti").unionByName(again)
    # Rows of keys this batch does not touch stay as the batch that marked them left them.
    after = stage(after, "state-after")
    keys = cells.select(*marks.KEY).union(touched.select(*marks.KEY)).union(marked.filter(F.col("marked_by") == batch_id).select(*marks.KEY)).distinct()
    own = marks.marked(before, after, batch_id).join(keys, marks.KEY, "left_semi")
    others = marked.join(keys, marks.KEY, "left_anti")
    store.replace_slices("unit_marks", stage(own.unionByName(others), "marks-now"), whole_cycles)

    new_units = measured.select(*units).distinct()
    span = before.alias("o").join(after.alias("n"), marks.KEY)
    found = (
        old_units.unionByName(new_units)
        .select("*", F.lit(None).cast("int").alias("to_round"), F.lit(None).cast("int").alias("to_day"),
                F.lit(None).cast("timestamp_ntz").alias("to_time"))
        .unionByName(
            span.select(
                "round_id",
                F.col("o.last_round_number").alias("round_number"),
                F.col("o.last_day").alias("day_of_production"),
                F.col("o.last_time").alias("time"),
                F.col("n.last_round_number").alias("to_round"),
                F.col("n.last_day").alias("to_day"),
                F.col("n.last_time").alias("to_time"),
            )
        )
        .distinct()
    )
    store.put_batch("touched_units", found, batch_id)
    put_derived_triggers(store, cells, before, batch_id)
    return store.batch("touched_units", batch_id).drop("batch_id")


def put_derived_triggers(store: Store, cells: DataFrame, before: DataFrame, batch_id: int) -> None:
    """Triggers of the derived observables of a batch, found as those of measured ones: from their own newest cells and their own state."""
    raised = store.batch("triggers", batch_id).filter(F.col("event_type") == S.LATEST)
    context = triggers.derived_context(raised.drop("batch_id", "event_type", "routing_key"))
    own = cells.filter(F.col("observable_name").isin(*derived_order()))
    # The cells stand in whole slices: a key none of whose inputs came with the batch has no context and drops out.
    units = triggers.new_units(own, before, marks.last_quadrant(before))
    store.put_batch("derived_triggers", triggers.time_triggers(units, context), batch_id)


def _slices(units: DataFrame, first: Column, last: Column) -> DataFrame:
    """Distinct slices of the units; a unit with an end stands for all slices up to it."""
    reach = F.sequence(F.least(first, F.coalesce(last, first)), F.greatest(first, F.coalesce(last, first)))
    return units.select("round_id", F.explode(reach).alias("slice")).filter("slice IS NOT NULL").distinct()


Keys = DataFrame | None


def _cells_in(store: Store, slices: DataFrame, first: str, last: str, slice_of: Callable[[Column], Column]) -> DataFrame:
    """Cells of the lap slices that reach into slices of days or times, by the spans kept with them; other folders are not read."""
    spans = store.read("cell_spans", slices.select("round_id").distinct())
    reached = F.col("slice").between(slice_of(F.col(first)), slice_of(F.col(last)))
    blocks = spans.join(slices, "round_id").filter(reached).select("round_id", F.col("lap_block").alias("slice")).distinct()
    return store.read("cells", stage(blocks, "lap-blocks"))


def _only(cells: DataFrame, only: Keys) -> DataFrame:
    return cells if only is None else cells.join(only, marks.KEY, "left_semi")


def _refresh_latest(store: Store, units: DataFrame, cycles: DataFrame, only: Keys = None) -> None:
    """Newest value of every place: of the touched lap slices again, of the others as kept with the lap each value came from."""
    one = cycles.withColumn("slice", F.lit(0))
    slices = stage(_slices(units, lap_slice(F.col("round_number")), lap_slice(F.col("to_round"))), "lap-slices")
    cells = stage(_only(store.read("cells", slices), only), "touched-cells")
    place = [*S.SERIES_KEY, *rollups.PLACE]
    old = stage(_only(store.read("latest_cells", cycles), only).withColumn("slice", lap_slice(F.col("round_number"))), "latest-old")
    fresh = rollups.latest_places(cells)
    lost = old.join(slices, ["round_id", "slice"], "left_semi").drop("slice")
    now = fresh.select(*place, F.col("time").alias("_now"))
    unknown = stage(lost.join(now, place, "left").filter("_now IS NULL OR _now < time").select(*place), "unknown-places")
    if not unknown.isEmpty():
        every = store.read("cells", unknown.select("round_id").distinct())
        fresh = fresh.join(unknown, place, "left_anti").unionByName(rollups.latest_places(every.join(unknown, place, "left_semi")))
    kept = old.join(slices, ["round_id", "slice"], "left_anti").drop("slice")
    newest = stage(rollups.newest_of(kept.unionByName(fresh)), "latest")
    side_by_side(
        lambda: store.replace_slices("latest_cells", newest, one, only),
        lambda: store.replace_slices("latest_over_time", newest, one, only),
    )
    stored = stage(store.read("latest_over_space", cycles), "latest-kept")
    means = rollups.latest_over_space(cells, marks.last_latest(stored))
    stale = stored.join(means.select(*marks.KEY), marks.KEY, "left_anti")
    store.replace_slices("latest_over_space", stage(means.unionByName(stale), "latest-space"), one)


def _refresh_rounds(store: Store, last: DataFrame, units: DataFrame, counter: DataFrame, only: Keys = None) -> None:
    number = F.col("round_number")
    slices = stage(_slices(units, lap_slice(number), lap_slice(F.col("to_round"))), "lap-slices")
    rounds = stage(rollups.round_over_time(_only(store.read("cells", slices), only), last), "rounds")
    store.replace_slices("round_over_time", rounds, slices, only)
    store.replace_slices("round_over_space", rollups.round_over_space(rounds, counter), slices, only)


def _refresh_days(store: Store, last: DataFrame, units: DataFrame, only: Keys = None) -> None:
    day = F.col("day_of_production")
    slices = stage(_slices(units, day_slice(day), day_slice(F.col("to_day"))), "day-slices")
    cells = _only(_cells_in(store, slices, "first_day", "last_day", day_slice), only)
    touched = cells.withColumn("slice", day_slice(day)).join(slices, ["round_id", "slice"], "left_semi")
    days = stage(rollups.day_over_time(touched, last), "days")
    store.replace_slices("day_over_time", days, slices, only)
    store.replace_slices("day_over_space", rollups.day_over_space(days), slices, only)


def _refresh_quadrants(store: Store, last: DataFrame, units: DataFrame, only: Keys = None) -> None:
    time = F.col("time")
    slices = stage(_slices(units, quadrant_slice(time), quadrant_slice(F.col("to_time"))), "quadrant-slices")
    cells = _only(_cells_in(store, slices, "first_time", "last_time", quadrant_slice), only)
    touched = cells.withColumn("slice", quadrant_slice(time)).join(slices, ["round_id", "slice"], "left_semi")
    quadrants = stage(rollups.tod_over_time(touched, last), "quadrants")
    store.replace_slices("tod_over_time", quadrants, slices, only)
    store.replace_slices("tod_over_space", rollups.tod_over_space(quadrants), slices, only)


def _refresh_hours(store: Store, units: DataFrame, only: Keys = None) -> None:
    time = F.col("time")
    slices = stage(_slices(units, hour_slice(time), hour_slice(F.col("to_time"))), "hour-slices")
    cells = _only(_cells_in(store, slices, "first_time", "last_time", hour_slice), only)
    touched = cells.withColumn("slice", hour_slice(time)).join(slices, ["round_id", "slice"], "left_semi")
    store.replace_slices("hourly_overview", rollups.hourly_overview(touched), slices, only)


def refresh_event(store: Store, controls: Controls, event: str, units: DataFrame, only: Keys = None) -> None:
    """Recompute the roll-ups of one event kind in every slice that a touched or newly closed unit falls into.

    Slices are recomputed whole, so late and repeated readings end up in the right place. With ``only`` (round_id, observable_name)
    other observables keep their rows.
    """
    cycles = stage(units.select("round_id").distinct(), "cycles")
    last = store.read("unit_marks", cycles).filter("last_time IS NOT NULL").select(*marks.KEY, "last_round_number", "last_day", "last_time")
    jobs: dict[str, Callable[[], None]] = {
        S.LATEST: lambda: _refresh_latest(store, units, cycles, only),
        S.NEW_ROUND: lambda: _refresh_rounds(store, last, units, controls.counter, only),
        S.NEW_DAY: lambda: _refresh_days(store, last, units, only),
        S.NEW_TIME_OF_DAY: lambda: _refresh_quadrants(store, last, units, only),
        S.NEW_HOURLY_OVERVIEW: lambda: _refresh_hours(store, units, only),
    }
    if event not in jobs:
        raise KeyError(f"unknown event kind {event!r}; known: {sorted(jobs)}")
    jobs[event]()


def refresh_rollups(store: Store, controls: Controls, units: DataFrame) -> None:
    """All roll-ups of the touched units. The families write different tables, so their jobs are submitted side by side."""
    side_by_side(*[partial(refresh_event, store, controls, event, units) for event in JOBS])


def stored_rollups(store: Store, controls: Controls, cycles: DataFrame) -> Rollups:
    """The stored roll-up tables in the shape the display outputs read."""
    cells = store.read("cells", cycles)
    last = store.read("unit_marks", cycles).filter("last_time IS NOT NULL").select(*marks.KEY, "last_round_number", "last_day", "last_time")
    tables = Rollups(cells, last, controls.counter, controls.cycles, controls.dims)
    for name, table in {
        "latest": "latest_over_time",
        "latest_space": "latest_over_space",
        "rounds": "round_over_time",
        "rounds_space": "round_over_space",
        "days": "day_over_time",
        "days_space": "day_over_space",
        "quadrants": "tod_over_time",
        "quadrants_space": "tod_over_space",
        "hours": "hourly_overview",
    }.items():
        setattr(tables, name, store.read(table, cycles))
    return tables


def refresh_frontend(store: Store, controls: Controls, cycles: DataFrame, batch_id: int) -> None:
    """Rewrite the display rows of the touched cycles; places outside the grid become alerts."""
    tables = stored_rollups(store, controls, cycles)
    outside = alerts.coordinate_alerts(with_dims(tables.latest, controls.dims))
    *outputs, _ = side_by_side(
        *[partial(lambda event: stage(event_outputs(event, tables), f"display-{event}"), event) for event in OUTPUTS],
        lambda: store.put_batch("coordinate_alerts", outside, batch_id),
    )
    store.replace_slices("frontend_data", reduce(DataFrame.unionByName, outputs), cycles.withColumn("slice", F.lit(0)))


def process_batch(store: Store, envelopes: DataFrame, controls: Controls, batch_id: int, frontend: bool = True, rollups: bool = True) -> None:
    """One micro-batch from messages to display rows. Running it again with the same batch id leaves the same tables.

    Without ``rollups`` it ends at cells and triggers; the streams over the triggers (:mod:`gridlap.plans.triggered`) do the rest.
    """
    finish_batch(store, ingest(store, envelopes, controls, batch_id), controls, batch_id, frontend, rollups)


def finish_batch(store: Store, slices: DataFrame, controls: Controls, batch_id: int, frontend: bool = True, rollups: bool = True) -> None:
    """What follows on the slices that a batch touched. Cycles whose grid has changed get new display rows."""
    resized = stage(resized_cycles(store, controls, batch_id), "resized")
    resized = resized.join(store.read("cell_spans", resized).select("round_id"), "round_id", "left_semi")
    shown = resized
    if not slices.isEmpty():
        units = refresh_cells(store, controls, slices, batch_id)
        shown = resized.union(units.select("round_id")).distinct()
        if rollups:
            refresh_rollups(store, controls, units)
    if rollups and frontend and not shown.isEmpty():
        refresh_frontend(store, controls, stage(shown, "cycles"), batch_id)
