"""Roll-up jobs by event kind, for runs over a table of cells."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import schemas as S
from ..operators import derived, rollups


@dataclass
class JobInput:
    """Cells, their newest rows (:func:`marks.last_rows`), the lap counter, and how far the job has come (None: not started)."""

    cells: DataFrame
    last: DataFrame
    counter: DataFrame
    marks: DataFrame | None = None


def latest_job(job: JobInput) -> dict[str, DataFrame]:
    return {
        "latest_over_time": rollups.latest_over_time(job.cells, job.marks),
        "latest_over_space": rollups.latest_over_space(job.cells, job.marks),
    }


def round_job(job: JobInput) -> dict[str, DataFrame]:
    rounds = rollups.round_over_time(job.cells, job.last, job.marks)
    return {"round_over_time": rounds, "round_over_space": rollups.round_over_space(rounds, job.counter)}


def day_job(job: JobInput) -> dict[str, DataFrame]:
    days = rollups.day_over_time(job.cells, job.last, job.marks)
    return {"day_over_time": days, "day_over_space": rollups.day_over_space(days)}


def time_of_day_job(job: JobInput) -> dict[str, DataFrame]:
    quadrants = rollups.tod_over_time(job.cells, job.last, job.marks)
    return {"tod_over_time": quadrants, "tod_over_space": rollups.tod_over_space(quadrants)}


def hourly_job(job: JobInput) -> dict[str, DataFrame]:
    return {"hourly_overview": rollups.hourly_overview(job.cells, job.marks)}


JOBS: dict[str, Callable[[JobInput], dict[str, DataFrame]]] = {
    S.LATEST: latest_job,
    S.NEW_ROUND: round_job,
    S.NEW_DAY: day_job,
    S.NEW_TIME_OF_DAY: time_of_day_job,
    S.NEW_HOURLY_OVERVIEW: hourly_job,
}


def run_job(event: str, job: JobInput, observable: str | None = None, stored: DataFrame | None = None) -> dict[str, DataFrame]:
    """Output tables of an event kind; a derived observable is computed by its name, after its ``stored`` rows."""
    if event == S.DERIVED_OBSERVABLE:
        return {"cells": derived.derive(job.cells, observable, job.counter, stored)}
    if event not in JOBS:
        raise KeyError(f"unknown event kind {event!r}; known: {sorted(JOBS)}")
    return JOBS[event](job)
