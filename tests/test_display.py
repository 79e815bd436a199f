"""Matrices, series and their JSON documents."""

from __future__ import annotations

import json

import pytest
from frames import cells, cycles, rows_of, t

from gridlap.operators import alerts, heatmaps, marks, rollups, series


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame([("pc", 1, 2)], "round_id string, x_dim int, y_dim int")


CELLS = [
    (0, 0, 1, 1.23456, "2024-01-01 09:00:00", 0),
    (1, 2, 1, -3.0, "2024-01-01 09:05:00", 0),
    (-1, 0, 1, 9.0, "2024-01-01 09:06:00", 0),
    (0, 1, 1, 0.0, "2024-01-01 09:07:00", 0),
    (1, 1, 2, 2.0005, "2024-01-02 10:00:00", 1),
    (0, 0, 3, 5.0, "2024-01-03 10:00:00", 2),
]


def document(df):
    return json.loads(df.collect()[0].data)


def test_latest_matrix(spark, dims):
    matrices = heatmaps.latest_matrices(rollups.latest_over_time(cells(spark, CELLS)), dims, cycles(spark, ("pc", "2024-01-01")))
    from pyspark.sql import functions as F

    got = document(heatmaps.matrix_documents(matrices, "latest", F.col("day").cast("string")))
    assert got == {"data": {"03-01-24": [[5.0, 0.0, None], [None, 2.0, 0.0]]}, "date": ["2"]}


def test_round_matrices(spark, dims):
    from frames import counter
    from pyspark.sql import functions as F

    stored = cells(spark, CELLS)
    rounds = rollups.round_over_time(stored, marks.last_rows(stored))
    space = rollups.round_over_space(rounds, counter(spark, ("pc", "2024-01-01 08:00:00", 1, 1)))
    matrices = heatmaps.round_matrices(rounds, space, dims, cycles(spark, ("pc", "2024-01-01")))
    got = document(heatmaps.matrix_documents(matrices, "round", F.col("day")))
    assert got["data"] == {
        "Round 1 (01-01 08:00)": [[1.235, 0.0, None], [None, None, 0.0]],
        "Round 2 (02-01 10:00)": [[None, None, None], [None, 2.0, None]],
    }
    assert got["date"] == [0, 1]


def test_time_of_day_matrices_treat_zero_as_missing(spark, dims):
    from pyspark.sql import functions as F

    stored = cells(spark, CELLS)
    quadrants = rollups.tod_over_time(stored, marks.last_rows(stored))
    got = document(heatmaps.matrix_documents(heatmaps.tod_matrices(quadrants, dims), "time_of_day", F.col("day")))
    assert got["data"]["01-01 10:00"] == [[1.23, None, None], [None, None, 0.0]]
    assert got["date"] == [0, 1]


def test_places_outside_the_grid(spark, dims):
    stored = cells(spark, [*CELLS, (2, 0, 1, 1.0, "2024-01-01 09:08:00", 0)]).unionByName(cells(spark, CELLS, observable="humidity"))
    latest = rollups.latest_over_time(stored)
    shown = heatmaps.latest_matrices(latest, dims, cycles(spark, ("pc", "2024-01-01")))
    assert rows_of(shown, "observable_name") == [("humidity",)]
    row = alerts.coordinate_alerts(heatmaps.with_dims(latest, dims)).collect()
    assert [r.observable_name for r in row] == ["temperature"] and "X cordinates = 2" in row[0].body


def test_hourly_matrix(spark):
    stored = cells(spark, CELLS)
    matrices = heatmaps.hourly_matrices(rollups.hourly_overview(stored), marks.last_rows(stored))
    got = document(heatmaps.hourly_documents(matrices))
    assert got["date"] == ["Day 0", "Day 1", "Day 2"]
    assert len(got["data"]) == 24 and got["data"][9][0] == 1.81 and got["data"][10] == [None, 2.0, 5.0]


def hourly(spark, *rows):
    data = [(v, None, None, t(at), 1, 0, "pc", "temperature", "ambient_condition") for at, v in rows]
    return spark.createDataFrame(
        data, "mean double, sd double, total double, time timestamp_ntz, round_number int, day int, round_id string, observable_name string, obs_type string"
    )


def test_calendar_series(spark):
    table = hourly(
        spark, ("2023-12-31 08:00:00", 1.0), ("2024-01-01 07:00:00", 2.0), ("2024-01-01 09:00:00", 4.0), ("2024-01-07 00:00:00", 8.0),
        ("2024-12-31 00:00:00", 16.0), ("2025-01-01 00:00:00", 32.0),
    )
    days = rows_of(series.calendar_series(table, "day"), "date", "value")
    assert days == [("2023-12-31", 1.0), ("2024-01-01", 2.0), ("2024-01-07", 8.0), ("2024-12-31", 16.0), ("2025-01-01", 32.0)]
    assert ("2024-01-01", 6.0) in rows_of(series.calendar_series(table, "day", "sum"), "date", "value")
    assert len(rows_of(series.calendar_series(table, "week"), "date")) == 5
    assert rows_of(series.calendar_series(table, "month", "mean").filter("date = '2024-01-01'"), "value") == [(pytest.approx(14 / 3),)]


def test_series_document(spark):
    points = series.hour_series(hourly(spark, ("2024-01-02 09:00:00", None), ("2024-01-01 09:00:00", 1.5)))
    assert document(series.series_documents(points)) == {"data": [1.5, None], "date": ["2024-01-01 09", "2024-01-02 09"]}


def test_missing_outputs(spark):
    key = "round_id string, observable_name string, event_type string, type_of_plot string"
    expected = spark.createDataFrame([("pc", "temperature", "latest", "graph"), ("pc", "humidity", "latest", "graph")], key)
    found = spark.createDataFrame([("pc", "temperature", "latest", "graph")], key)
    assert rows_of(alerts.empty_output_alerts(expected, found), "observable_name", "kind") == [("humidity", "empty_output")]
