"""Registered queries: one per operator or operator family, each over the whole sensor view of a data folder.

Floating results are rounded to six digits (see :func:`six`), because the last bits of a sum depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import timeparts as tp
from ..functions.formulas import derived_names
from ..functions.numbers import round_half_up
from ..operators import alerts, derived, heatmaps, invalidation, laps, marks, quality, rollups, series, triggers
from ..operators.cells import cell_partials, finalise_cells, merge_partials
from ..operators.upsert import upsert, upsert_newest
from ..sources import messages, scans
from .frontend import OUTPUTS, Rollups, event_outputs, frontend_data
from .jobs import JobInput, run_job
from .sample import Sample

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def six(column: str | Column) -> Column:
    return round_half_up(F.col(column) if isinstance(column, str) else column, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: six(c) for c in columns})


def query(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Sample(spark, sf_dir))
    return build


# Sources -------------------------------------------------------------------------------------------------------------------


def _text_lines(s: Sample, body: Column) -> DataFrame:
    return s.view.readings.select("file_id", body.alias("line"))


def _wire_time() -> Column:
    return F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")


@query
def parse_csv_lines(s: Sample) -> DataFrame:
    """Readings written as CSV text, parsed back: x and y swapped, fractions cut off."""
    number = [F.col(c).cast("string") for c in ("x", "y", "z", "value")]
    x, y, z, value = number
    line = F.concat(
        F.lit('"'), _wire_time(), F.lit('" , '), x, F.lit(".75,"), y, F.lit(".25,"), z, F.lit(".01, "), value
    )
    lines = _text_lines(s, line)
    header = lines.select("file_id", F.lit("timestamp,x,y,z,value").alias("line")).distinct()
    return messages.parse_lines(lines.unionByName(header))


@query
def parse_json_lines(s: Sample) -> DataFrame:
    """Readings written as JSON lines, parsed back: no swap."""
    place = F.array(*[F.col(c).cast("double") + 0.5 for c in ("x", "y", "z")])
    line = F.to_json(
        F.struct(place.alias("coordinates"), _wire_time().alias("timestamp"), F.col("value").alias("data"), F.lit("C").alias("unit"))
    )
    return messages.parse_lines(_text_lines(s, line))


@query
def parse_envelopes(s: Sample) -> DataFrame:
    """Queue messages that hold one short file each, parsed to readings (a message per reading and place of its file)."""
    line = F.concat(F.lit('"'), _wire_time(), F.lit('",'), F.concat_ws(",", "x", "y", "z", "value"))
    content = F.concat(F.lit("timestamp,x,y,z,value\n"), line, F.lit("\n"))
    name = F.concat_ws("/", "file_id", F.date_format("time", "yyyyMMddHHmmssSSSSSS"), "x", "y", F.round(F.col("value") * 10000).cast("long"))
    message = F.to_json(
        F.struct(
            content.alias("file_content"),
            F.col("round_id").alias("roundId"),
            F.col("robot_id").alias("robotId"),
            F.col("observable_name").alias("observableName"),
            F.col("observable_id").alias("observableId"),
            F.struct(F.col("x_dim").alias("dimX"), F.col("y_dim").alias("dimY")).alias("dimension"),
            F.col("obs_type").alias("type"),
            name.alias("dataFile"),
        )
    )
    files = messages.parse_envelopes(s.view.readings.select(message.alias("value")))
    return messages.envelope_readings(files)


# Files and laps ------------------------------------------------------------------------------------------------------------


@query
def asof_round_assign(s: Sample) -> DataFrame:
    return s.index.match(s.view.readings).select(
        "round_id", "observable_name", "time", "x", "y", "value", "round_number", "is_valid_round", "lap_time"
    )


@query
def asof_exact_assign(s: Sample) -> DataFrame:
    return s.index.match(s.view.readings, by_minute=False).select(
        "round_id", "observable_name", "time", "x", "y", "value", "round_number", "is_valid_round", "lap_time"
    )


@query
def file_statistics(s: Sample) -> DataFrame:
    stats = rounded(quality.file_stats(s.short_files), "value_sd", "x_sd", "y_sd")
    return stats.drop("bad_lines")


@query
def suspicious_files(s: Sample) -> DataFrame:
    return quality.file_stats(s.short_files).filter(quality.is_suspicious()).select("file_id", "readings", "span_seconds")


@query
def robot_allow_list(s: Sample) -> DataFrame:
    files = quality.file_stats(s.view.readings).select(*quality.FILE_COLUMNS, "readings")
    return quality.allowed(files, s.view.robot_observable)


@query
def robot_not_allowed(s: Sample) -> DataFrame:
    files = quality.file_stats(s.view.readings).select(*quality.FILE_COLUMNS, "readings")
    return quality.not_allowed(files, s.view.robot_observable)


@query
def day_of_production(s: Sample) -> DataFrame:
    rows = s.view.readings.select("file_id", "round_id", "time", "value")
    return quality.with_day_of_production(rows, s.view.cycles, "time")


@query
def file_verdicts(s: Sample) -> DataFrame:
    return s.short_verdicts.select("file_id", "round_id", "observable_name", "verdict", "file_round_number", "day_of_production")


@query
def file_round_shortcut(s: Sample) -> DataFrame:
    """Readings that survive the file rules, with their lap."""
    rows = laps.assign_laps(s.short_files, s.short_verdicts, s.index)
    return rows.select("file_id", "time", "x", "y", "z", "value", "round_number", "day_of_production")


@query
def file_rejections(s: Sample) -> DataFrame:
    return alerts.file_alerts(s.short_verdicts)


@query
def ingest_audit(s: Sample) -> DataFrame:
    return alerts.ingest_audit(s.files, F.col("last_time"))


# Cells ---------------------------------------------------------------------------------------------------------------------


@query
def cells_ambient(s: Sample) -> DataFrame:
    return rounded(s.cells.filter(F.col("obs_type") == S.AMBIENT), "value")


@query
def cells_anomaly(s: Sample) -> DataFrame:
    return rounded(s.cells.filter(F.col("obs_type") == S.ANOMALY), "value")


@query
def cells_incremental_merge(s: Sample) -> DataFrame:
    """Two batches, each checked and summed by itself, merged: equal to one batch."""
    parts = []
    for readings in (s.before(s.view.readings), s.after(s.view.readings)):
        files = quality.check_files(readings, s.index, s.view.cycles, s.view.robot_observable)
        parts.append(cell_partials(readings, files, s.index))
    return rounded(finalise_cells(merge_partials(*parts)), "value")


@query
def cells_with_precision(s: Sample) -> DataFrame:
    """Cell values at the number of digits set per observable (0 to 2 by the length of the name)."""
    names = s.view.spans.select(F.col("observable_id").alias("code_name")).distinct()
    settings = names.withColumn("observable_precision", F.length("code_name") % 3)
    return rounded(scans.with_precision(s.cells.withColumn("value", six("value")), settings), "value")


@query
def last_main_rows(s: Sample) -> DataFrame:
    return marks.last_rows(s.cells)


@query
def first_main_rows(s: Sample) -> DataFrame:
    return marks.first_rows(s.cells)


# Roll-ups ------------------------------------------------------------------------------------------------------------------


@query
def latest_over_time(s: Sample) -> DataFrame:
    return rounded(rollups.latest_over_time(s.cells), "value")


@query
def latest_over_space(s: Sample) -> DataFrame:
    return rounded(rollups.latest_over_space(s.cells), "mean", "sd", "total")


@query
def latest_incremental(s: Sample) -> DataFrame:
    done = marks.last_latest(rollups.latest_over_space(s.earlier_cells))
    return rounded(rollups.latest_over_space(s.stored_cells, done), "mean", "sd", "total")


@query
def round_over_time(s: Sample) -> DataFrame:
    return rounded(s.rounds, "value")


@query
def round_over_space(s: Sample) -> DataFrame:
    return rounded(s.rounds_space, "mean", "sd", "total")


@query
def round_incremental(s: Sample) -> DataFrame:
    earlier = rollups.round_over_time(s.earlier_cells, s.earlier_last)
    done = marks.last_round(rollups.round_over_space(earlier, s.view.counter))
    fresh = rollups.round_over_time(s.stored_cells, s.last, done)
    return rounded(rollups.round_over_space(fresh, s.view.counter), "mean", "sd", "total")


@query
def day_over_time(s: Sample) -> DataFrame:
    return rounded(s.days, "value")


@query
def day_over_space(s: Sample) -> DataFrame:
    return rounded(rollups.day_over_space(s.days), "mean", "sd", "total")


@query
def day_incremental(s: Sample) -> DataFrame:
    done = marks.last_day(rollups.day_over_space(rollups.day_over_time(s.earlier_cells, s.earlier_last)))
    return rounded(rollups.day_over_space(rollups.day_over_time(s.stored_cells, s.last, done)), "mean", "sd", "total")


@query
def tod_over_time(s: Sample) -> DataFrame:
    return rounded(s.quadrants, "value")


@query
def tod_over_space(s: Sample) -> DataFrame:
    return rounded(rollups.tod_over_space(s.quadrants), "mean", "sd", "total")


@query
def tod_incremental(s: Sample) -> DataFrame:
    done = marks.last_time_of_day(rollups.tod_over_space(rollups.tod_over_time(s.earlier_cells, s.earlier_last)))
    return rounded(rollups.tod_over_space(rollups.tod_over_time(s.stored_cells, s.last, done)), "mean", "sd", "total")


@query
def quadrant_windows(s: Sample) -> DataFrame:
    spans = s.view.spans.groupBy("round_id").agg(F.min("lo").alias("start"), F.max("hi").alias("newest"))
    return rollups.quadrant_windows(spans)


@query
def hourly_overview(s: Sample) -> DataFrame:
    return rounded(rollups.hourly_overview(s.cells), "mean", "sd", "total")


@query
def hourly_incremental(s: Sample) -> DataFrame:
    done = marks.last_hour(rollups.hourly_overview(s.earlier_cells))
    return rounded(rollups.hourly_overview(s.stored_cells, done), "mean", "sd", "total")


# Insert or update ----------------------------------------------------------------------------------------------------------


def _continued(s: Sample, event: str, table: str, mark: Callable[[DataFrame], DataFrame], source: str | None = None) -> DataFrame:
    """Roll-up of the earlier cells, continued from its high-water mark over all cells and merged by key."""
    earlier = run_job(event, JobInput(s.earlier_cells, s.earlier_last, s.view.counter))
    done = mark(earlier[source or table])
    fresh = run_job(event, JobInput(s.stored_cells, s.last, s.view.counter, done))
    return upsert(earlier[table], fresh[table], S.TABLE_KEYS[table])


@query
def upsert_latest(s: Sample) -> DataFrame:
    earlier = run_job(S.LATEST, JobInput(s.earlier_cells, s.earlier_last, s.view.counter))
    done = marks.last_latest(earlier["latest_over_space"])
    fresh = run_job(S.LATEST, JobInput(s.stored_cells, s.last, s.view.counter, done))
    key = S.TABLE_KEYS["latest_over_time"]
    return rounded(upsert_newest(earlier["latest_over_time"], fresh["latest_over_time"], key), "value")


@query
def upsert_rounds(s: Sample) -> DataFrame:
    return rounded(_continued(s, S.NEW_ROUND, "round_over_space", marks.last_round), "mean", "sd", "total")


@query
def upsert_round_places(s: Sample) -> DataFrame:
    return rounded(_continued(s, S.NEW_ROUND, "round_over_time", marks.last_round, "round_over_space"), "value")


@query
def upsert_days(s: Sample) -> DataFrame:
    return rounded(_continued(s, S.NEW_DAY, "day_over_space", marks.last_day), "mean", "sd", "total")


@query
def upsert_quadrants(s: Sample) -> DataFrame:
    return rounded(_continued(s, S.NEW_TIME_OF_DAY, "tod_over_space", marks.last_time_of_day), "mean", "sd", "total")


@query
def upsert_hours(s: Sample) -> DataFrame:
    return rounded(_continued(s, S.NEW_HOURLY_OVERVIEW, "hourly_overview", marks.last_hour), "mean", "sd", "total")


# Retraction ----------------------------------------------------------------------------------------------------------------


@query
def invalid_round_filter(s: Sample) -> DataFrame:
    return rounded(invalidation.drop_invalid(s.cells, s.view.counter), "value")


@query
def invalid_round_alerts(s: Sample) -> DataFrame:
    return invalidation.invalid_alerts(s.view.counter)


# Derived observables -------------------------------------------------------------------------------------------------------


def _aligned(s: Sample) -> DataFrame:
    """Cells stamped with their day, so that readings of different sensors meet."""
    return s.stored_cells.withColumn("time", tp.trunc("DAY", F.col("time")))


def _derived_query(name: str) -> None:
    QUERIES[f"derived_{name}"] = lambda spark, sf_dir: rounded(derived.derive(_aligned(Sample(spark, sf_dir)), name), "value")


for _name in derived_names():
    _derived_query(_name)


@query
def derived_ready(s: Sample) -> DataFrame:
    stored = derived.derive(s.before(_aligned(s)), "humidex")
    return derived.ready_cycles(_aligned(s), "humidex", stored)


@query
def derived_range(s: Sample) -> DataFrame:
    stored = derived.derive(s.before(_aligned(s)), "humidex")
    return derived.round_range(_aligned(s), "humidex", s.view.counter, stored)


@query
def derived_incremental(s: Sample) -> DataFrame:
    stored = derived.derive(s.before(_aligned(s)), "humidex")
    return rounded(derived.derive(_aligned(s), "humidex", s.view.counter, stored), "value")


# Triggers ------------------------------------------------------------------------------------------------------------------


def _new_units(s: Sample) -> DataFrame:
    tod = marks.last_time_of_day(rollups.tod_over_space(rollups.tod_over_time(s.earlier_cells, s.earlier_last)))
    return triggers.new_units(s.after(s.stored_cells), s.earlier_last, tod)


@query
def trigger_flags(s: Sample) -> DataFrame:
    return _new_units(s)


@query
def trigger_rows(s: Sample) -> DataFrame:
    return triggers.time_triggers(_new_units(s), triggers.batch_context(s.after(s.view.readings)))


@query
def frontend_trigger_rows(s: Sample) -> DataFrame:
    return triggers.frontend_triggers(triggers.time_triggers(_new_units(s), triggers.batch_context(s.after(s.view.readings))))


# Display -------------------------------------------------------------------------------------------------------------------


@query
def series_latest(s: Sample) -> DataFrame:
    return rounded(series.latest_series(rollups.latest_over_space(s.cells)), "value")


@query
def series_round(s: Sample) -> DataFrame:
    return rounded(series.round_series(s.rounds_space), "value")


@query
def series_day(s: Sample) -> DataFrame:
    return rounded(series.day_series(rollups.day_over_space(s.days)), "value")


@query
def series_tod(s: Sample) -> DataFrame:
    return rounded(series.tod_series(rollups.tod_over_space(s.quadrants)), "value")


@query
def series_hour(s: Sample) -> DataFrame:
    return rounded(series.hour_series(rollups.hourly_overview(s.cells)), "value")


def _calendar_query(unit: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(series.calendar_series(rollups.hourly_overview(Sample(spark, sf_dir).cells), unit), "value")

    QUERIES[f"series_calendar_{unit}"] = run


for _unit in series.CALENDAR_UNITS:
    _calendar_query(_unit)


@query
def matrix_latest(s: Sample) -> DataFrame:
    places = rollups.latest_over_time(s.stored_cells)
    return rounded(heatmaps.matrix_cells(heatmaps.latest_matrices(places, s.dims, s.view.cycles)), "value")


@query
def matrix_round(s: Sample) -> DataFrame:
    return rounded(heatmaps.matrix_cells(heatmaps.round_matrices(s.rounds, s.rounds_space, s.dims, s.view.cycles)), "value")


@query
def matrix_day(s: Sample) -> DataFrame:
    return rounded(heatmaps.matrix_cells(heatmaps.day_matrices(s.days, rollups.day_over_space(s.days), s.dims)), "value")


@query
def matrix_tod(s: Sample) -> DataFrame:
    return rounded(heatmaps.matrix_cells(heatmaps.tod_matrices(s.quadrants, s.dims)), "value")


@query
def matrix_hourly(s: Sample) -> DataFrame:
    matrices = heatmaps.hourly_matrices(rollups.hourly_overview(s.stored_cells), s.last)
    return rounded(heatmaps.matrix_cells(matrices).withColumnsRenamed({"x": "hour", "y": "day"}), "value")


@query
def coordinate_alerts(s: Sample) -> DataFrame:
    """Places beyond a grid that is one square smaller than the real one."""
    small = s.dims.withColumns({"x_dim": F.col("x_dim") - 1, "y_dim": F.col("y_dim") - 1})
    return alerts.coordinate_alerts(heatmaps.with_dims(rollups.latest_over_time(s.cells), small))


def _documents(s: Sample, plot: str) -> DataFrame:
    tables = Rollups(s.stored_cells, s.last, s.view.counter, s.view.cycles, s.dims)
    return reduce(DataFrame.unionByName, [event_outputs(event, tables) for event in OUTPUTS]).filter(F.col("type_of_plot") == plot)


@query
def graph_documents(s: Sample) -> DataFrame:
    """All graph documents, read back from their JSON."""
    parsed = F.from_json("data", "data array<double>, date array<string>")
    docs = _documents(s, "graph").select("round_id", "observable_name", "event_type", parsed.alias("d"))
    points = docs.select("round_id", "observable_name", "event_type", F.posexplode(F.arrays_zip("d.date", "d.data")).alias("n", "p"))
    return points.select("round_id", "observable_name", "event_type", "n", "p.date", six("p.data").alias("value"))


@query
def heatmap_documents(s: Sample) -> DataFrame:
    """All labelled heatmap documents, read back from their JSON."""
    parsed = F.from_json("data", "data map<string, array<array<double>>>, date array<string>")
    docs = _documents(s, "heatmap").filter("event_type <> 'hourly_overview'")
    keys = ["round_id", "observable_name", "event_type"]
    units = docs.select(*keys, parsed.alias("d")).select(*keys, F.posexplode("d.data").alias("n", "label", "matrix"), "d.date")
    units = units.select(*keys, "label", F.get("date", "n").alias("day"), "matrix")
    return rounded(heatmaps.matrix_cells(units), "value")


@query
def frontend_json(s: Sample) -> DataFrame:
    return frontend_data(s.stored_cells, s.last, s.view.counter, s.view.cycles, s.dims)
