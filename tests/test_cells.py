"""Cells, mean time, merging, retraction."""

from __future__ import annotations

from datetime import datetime

import pytest
from frames import cells, counter, cycles, readings, rows_of, sensors

from gridlap.functions.numbers import nan_to_null, round_half_even, round_half_up
from gridlap.operators.cells import cell_partials, cells_of, finalise_cells, merge_partials
from gridlap.operators.invalidation import drop_invalid, invalid_alerts, invalid_starts
from gridlap.operators.laps import LapIndex
from gridlap.operators.quality import check_files
from gridlap.session import stage

LAP = [("pc", "2024-01-01 00:00:00", 1, 1)]


def build(spark, rows, kind="ambient_condition"):
    return cells_of(
        readings(spark, rows, kind=kind), counter(spark, *LAP), cycles(spark, ("pc", "2024-01-03")), sensors(spark, ("rb", "temperature"))
    )


ROWS = [
    ("2024-01-02 10:00:00", 1, 2, 1.0),
    ("2024-01-02 10:00:03", 1, 2, 2.5),
    ("2024-01-02 10:00:04", 1, 2, None),
    ("2024-01-02 10:00:09", 2, 2, 4.0),
]


def test_mean_sum_and_time(spark):
    assert rows_of(build(spark, ROWS), "x", "value", "time", "day_of_production") == [
        (1, 1.75, datetime(2024, 1, 2, 10, 0, 2), -1),
        (2, 4.0, datetime(2024, 1, 2, 10, 0, 9), -1),
    ]
    assert rows_of(build(spark, ROWS, "anomaly"), "x", "value") == [(1, 3.5), (2, 4.0)]


def test_cell_without_values(spark):
    rows = [("2024-01-02 10:00:00", 1, 2, None), ("2024-01-02 10:00:03", 2, 2, 2.5)]
    assert rows_of(build(spark, rows), "x", "value")[0] == (1, None)
    assert rows_of(build(spark, rows, "anomaly"), "x", "value")[0] == (1, 0.0)


def test_mean_time_of_many_readings(spark):
    """More rows than a plain sum of microseconds in a long could take."""
    rows = spark.range(40_000).selectExpr("CAST(id % 2 AS INT) AS x", "id")
    df = rows.selectExpr(
        "'f' AS file_id", "'pc' AS round_id", "'rb' AS robot_id", "'temperature' AS observable_name", "'temperature' AS observable_id",
        "'ambient_condition' AS obs_type", "3 AS x_dim", "3 AS y_dim",
        "CAST(timestamp_seconds(1704189600 + id) AS TIMESTAMP_NTZ) AS time", "x", "0 AS y", "0 AS z", "CAST(id AS DOUBLE) AS value",
    )
    found = cells_of(df, counter(spark, *LAP), cycles(spark, ("pc", "2024-01-01")), sensors(spark, ("rb", "temperature")))
    assert rows_of(found, "x", "value") == [(0, 19999.0), (1, 20000.0)]
    assert [r[1].timestamp() for r in rows_of(found, "x", "time")] == pytest.approx(
        [datetime(2024, 1, 2, 10).timestamp() + 19999, datetime(2024, 1, 2, 10).timestamp() + 20000]
    )


def test_merge_equals_one_pass(spark):
    index = LapIndex.build(counter(spark, *LAP))
    start, known = cycles(spark, ("pc", "2024-01-03")), sensors(spark, ("rb", "temperature"))

    def partials(rows):
        r = readings(spark, rows)
        return cell_partials(r, check_files(r, index, start, known), index)

    one = [(*r, "a") for r in ROWS]
    two = [("2024-01-05 08:00:00", 1, 2, 9.0, "b"), ("2024-01-05 08:00:05", 2, 2, 1.0, "b")]
    columns = ["x", "value", "time", "day_of_production"]
    merged = rows_of(finalise_cells(merge_partials(partials(one), partials(two))), *columns)
    assert merged == rows_of(finalise_cells(partials(one + two)), *columns)
    assert merged == rows_of(finalise_cells(merge_partials(partials(two), partials(one))), *columns)
    assert [r[3] for r in merged] == [-1, -1]  # the day of the earliest reading


def test_same_cells_without_broadcast_joins(spark):
    """Most readings in one file and one square, lookups beyond the broadcast limit."""
    hot = spark.range(6000).selectExpr("IF(id % 3 = 0, 'hot', concat('f', id % 40)) AS file_id", "id").selectExpr(
        "file_id", "'pc' AS round_id", "'rb' AS robot_id", "'temperature' AS observable_name", "'temperature' AS observable_id",
        "'ambient_condition' AS obs_type", "3 AS x_dim", "3 AS y_dim",
        "CAST(timestamp_seconds(1704189600 + 7 * id) AS TIMESTAMP_NTZ) AS time", "CAST(IF(file_id = 'hot', 1, id % 4) AS INT) AS x",
        "CAST(id % 2 AS INT) AS y", "0 AS z", "CAST(id % 17 AS DOUBLE) AS value",
    )
    hot = stage(hot, "hot")
    laps = counter(spark, *[("pc", f"2024-01-02 {h:02d}:15:00", h, int(h % 5 != 2)) for h in range(24)])
    args = laps, cycles(spark, ("pc", "2024-01-01")), sensors(spark, ("rb", "temperature"))
    columns = ["round_number", "x", "y", "value", "time", "day_of_production"]
    expected = rows_of(cells_of(hot, *args), *columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = cells_of(hot, *args)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert rows_of(found, *columns) == expected and expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


STARTS = {
    "good first": [("10:00", 1), ("11:00", 0), ("12:00", 0)],
    "good last": [("10:00", 0), ("11:00", 0), ("12:00", 1)],
    "good between": [("10:00", 0), ("11:00", 1), ("12:00", 0)],
    "none good": [("10:00", 0), ("11:00", 0)],
    "single": [("10:00", 0)],
}
KEPT = {
    "good first": [9, 10],
    "good last": [9, 12, 13],
    "good between": [9, 11],
    "none good": [9, 10, 11, 12, 13],
    "single": [9, 10, 11, 12, 13],
}
HANDLED = {"good first": [11], "good last": [10, 11], "good between": [10, 12], "none good": [10, 11], "single": []}


@pytest.mark.parametrize("case", sorted(STARTS))
def test_invalid_starts(spark, case):
    laps = counter(spark, *[("pc", f"2024-01-01 {at}:00", 4, v) for at, v in STARTS[case]])
    stored = cells(spark, [(0, h, 4, 1.0, f"2024-01-01 {h:02d}:30:00", 0) for h in range(9, 14)] + [(0, 0, 5, 1.0, "2024-01-01 13:00:00", 0)])
    left = drop_invalid(stored, laps)
    assert sorted(r[0] for r in rows_of(left.filter("round_number = 4"), "y")) == KEPT[case]
    assert left.filter("round_number = 5").count() == 1
    assert [r[0].hour for r in rows_of(invalid_starts(laps), "time")] == HANDLED[case]


def test_invalid_alert_row(spark):
    laps = counter(spark, ("pc", "2024-01-01 10:00:00", 4, 1), ("pc", "2024-01-01 11:00:00", 4, 0))
    row = invalid_alerts(laps).collect()[0]
    assert row.message == "Round with id pc, at time - 2024-01-01 11:00:00 and number 4 has been discarded."
    assert (row.robot_id, row.level, row.subject, len(row.id)) == ("pc", "high", "Discarded robot round", 64)
    only_other = spark.createDataFrame([("pc", 9)], "round_id string, round_number int")
    assert invalid_alerts(laps, only_other).count() == 0


def test_rounding(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1.005,), (1.0049999999999997,), (-2.5,), (float("nan"),)], "v double")
    got = df.select(round_half_up(nan_to_null(F.col("v")), 2), round_half_even(nan_to_null(F.col("v")), 0)).collect()
    assert [tuple(r) for r in got] == [(1.01, 1.0), (1.01, 1.0), (-2.5, -2.0), (None, None)]
