"""Which display outputs an event kind produces, and all of them together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import heatmaps, rollups, series
from ..session import stage


@dataclass
class Rollups:
    """Roll-up tables of one run. Those that feed several outputs are staged, so they are computed once."""

    cells: DataFrame
    last: DataFrame
    counter: DataFrame
    cycles: DataFrame
    dims: DataFrame

    @cached_property
    def latest(self) -> DataFrame:
        return rollups.latest_over_time(self.cells)

    @cached_property
    def latest_space(self) -> DataFrame:
        return rollups.latest_over_space(self.cells)

    @cached_property
    def rounds(self) -> DataFrame:
        return stage(rollups.round_over_time(self.cells, self.last), "rounds")

    @cached_property
    def rounds_space(self) -> DataFrame:
        return stage(rollups.round_over_space(self.rounds, self.counter), "rounds-space")

    @cached_property
    def days(self) -> DataFrame:
        return stage(rollups.day_over_time(self.cells, self.last), "days")

    @cached_property
    def days_space(self) -> DataFrame:
        return stage(rollups.day_over_space(self.days), "days-space")

    @cached_property
    def quadrants(self) -> DataFrame:
        return stage(rollups.tod_over_time(self.cells, self.last), "quadrants")

    @cached_property
    def quadrants_space(self) -> DataFrame:
        return rollups.tod_over_space(self.quadrants)

    @cached_property
    def hours(self) -> DataFrame:
        return stage(rollups.hourly_overview(self.cells), "hours")


def _latest_heatmap(r: Rollups) -> DataFrame:
    matrices = heatmaps.latest_matrices(r.latest, r.dims, r.cycles)
    return heatmaps.matrix_documents(matrices, "latest", F.col("day").cast("string"))


def _round_heatmap(r: Rollups) -> DataFrame:
    matrices = heatmaps.round_matrices(r.rounds, r.rounds_space, r.dims, r.cycles)
    return heatmaps.matrix_documents(matrices, "round", F.col("day"))


def _day_heatmap(r: Rollups) -> DataFrame:
    return heatmaps.matrix_documents(heatmaps.day_matrices(r.days, r.days_space, r.dims), "new_day", F.col("day"))


def _tod_heatmap(r: Rollups) -> DataFrame:
    return heatmaps.matrix_documents(heatmaps.tod_matrices(r.quadrants, r.dims), "time_of_day", F.col("day"))


def _hourly_heatmap(r: Rollups) -> DataFrame:
    return heatmaps.hourly_documents(heatmaps.hourly_matrices(r.hours, r.last))


def _calendar(unit: str) -> Callable[[Rollups], DataFrame]:
    return lambda r: series.series_documents(series.calendar_series(r.hours, unit))


OUTPUTS: dict[str, dict[str, Callable[[Rollups], DataFrame]]] = {
    S.LATEST: {
        "graph": lambda r: series.series_documents(series.latest_series(r.latest_space)),
        "heatmap": _latest_heatmap,
    },
    S.NEW_ROUND: {
        "graph": lambda r: series.series_documents(series.round_series(r.rounds_space)),
        "heatmap": _round_heatmap,
    },
    S.NEW_DAY: {
        "graph": lambda r: series.series_documents(series.day_series(r.days_space)),
        "heatmap": _day_heatmap,
    },
    S.NEW_TIME_OF_DAY: {
        "graph": lambda r: series.series_documents(series.tod_series(r.quadrants_space)),
        "heatmap": _tod_heatmap,
    },
    S.NEW_HOURLY_OVERVIEW: {
        "hourly_overview": _hourly_heatmap,
        "hour": lambda r: series.series_documents(series.hour_series(r.hours)),
        "day": _calendar("day"),
        "week": _calendar("week"),
        "month": _calendar("month"),
    },
}


# Names of the outputs of each event kind, as they stand in the display rows.
OUTPUT_KINDS: dict[str, list[tuple[str, str]]] = {
    S.LATEST: [("latest", "graph"), ("latest", "heatmap")],
    S.NEW_ROUND: [("round", "graph"), ("round", "heatmap")],
    S.NEW_DAY: [("new_day", "graph"), ("new_day", "heatmap")],
    S.NEW_TIME_OF_DAY: [("time_of_day", "graph"), ("time_of_day", "heatmap")],
    S.NEW_HOURLY_OVERVIEW: [("hourly_overview", "heatmap"), ("hour", "graph"), ("day", "graph"), ("week", "graph"), ("month", "graph")],
}


def event_outputs(event: str, tables: Rollups) -> DataFrame:
    """All display rows of one event kind, for every cycle and observable in the tables."""
    if event not in OUTPUTS:
        raise KeyError(f"unknown event kind {event!r}; known: {sorted(OUTPUTS)}")
    return reduce(DataFrame.unionByName, [build(tables) for build in OUTPUTS[event].values()])


def frontend_data(cells: DataFrame, last: DataFrame, counter: DataFrame, cycles: DataFrame, dims: DataFrame) -> DataFrame:
    tables = Rollups(cells, last, counter, cycles, dims)
    return reduce(DataFrame.unionByName, [event_outputs(event, tables) for event in OUTPUTS])
