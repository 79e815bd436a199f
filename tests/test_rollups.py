"""Roll-ups, high-water marks, triggers, derived observables."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from frames import cells, counter, rows_of, t
from pyspark.sql import functions as F

from gridlap.functions import timeparts as tp
from gridlap.functions.formulas import derived, register_derived
from gridlap.operators import derived as d
from gridlap.operators import marks, rollups, triggers


def times(spark, *texts):
    return spark.createDataFrame([(t(x),) for x in texts], "time timestamp_ntz")


def test_quadrants_are_half_open(spark):
    df = times(spark, "2024-01-02 11:59:59.500", "2024-01-02 20:00:00", "2024-01-02 23:30:00", "2024-01-03 07:59:59", "2024-01-03 08:00:00")
    got = df.select(tp.quadrant(F.col("time")), tp.window_start(F.col("time")), tp.window_midpoint(tp.window_start(F.col("time")))).collect()
    night = (4, datetime(2024, 1, 2, 20), datetime(2024, 1, 3, 2))
    assert [tuple(r) for r in got] == [
        (1, datetime(2024, 1, 2, 8), datetime(2024, 1, 2, 10)),
        night,
        night,
        night,
        (1, datetime(2024, 1, 3, 8), datetime(2024, 1, 3, 10)),
    ]


def test_windows_between_two_times(spark):
    spans = spark.createDataFrame([(t("2021-11-01 09:00:01"), t("2021-11-02 13:00:01"))], "start timestamp_ntz, newest timestamp_ntz")
    assert rows_of(rollups.quadrant_windows(spans), "n", "window_start", "window_end", "quadrant") == [
        (0, datetime(2021, 11, 1, 12), datetime(2021, 11, 1, 15, 59, 59), tp.AFTERNOON),
        (1, datetime(2021, 11, 1, 16), datetime(2021, 11, 1, 19, 59, 59), tp.EVENING),
        (2, datetime(2021, 11, 1, 20), datetime(2021, 11, 2, 7, 59, 59), tp.NIGHT),
        (3, datetime(2021, 11, 2, 8), datetime(2021, 11, 2, 11, 59, 59), tp.MORNING),
    ]


def test_week_of_year(spark):
    df = times(spark, *[f"{y}-{m:02d}-{day:02d}" for y in (2022, 2023, 2024) for m in (1, 2, 12) for day in (1, 2, 6, 7, 8, 28)])
    for time, week in df.select("time", tp.week_of_year(F.col("time"))).collect():
        assert week == int(time.strftime("%U")), time


CELLS = [
    # x, y, lap, value, time, day
    (0, 0, 1, 1.0, "2024-01-01 09:00:00", 0),
    (0, 1, 1, 2.0, "2024-01-01 09:05:00", 0),
    (-1, 0, 1, 9.0, "2024-01-01 09:06:00", 0),
    (0, 0, 2, 4.0, "2024-01-01 13:00:00", 0),
    (0, 0, 2, 7.0, "2023-12-31 13:00:00", -1),
    (0, 1, 3, 5.0, "2024-01-02 21:00:00", 1),
    (0, 0, 4, 6.0, "2024-01-03 09:00:00", 2),
]


@pytest.fixture(scope="module")
def ambient(spark):
    return cells(spark, CELLS)


@pytest.fixture(scope="module")
def anomaly(spark):
    return cells(spark, CELLS, observable="bad_droppings", kind="anomaly")


def test_latest(spark, ambient):
    assert rows_of(rollups.latest_over_time(ambient), "x", "y", "value") == [(-1, 0, 9.0), (0, 0, 6.0), (0, 1, 5.0)]
    space = rollups.latest_over_space(ambient).collect()[0]
    assert (space.mean, space.total, space.old_time) == (pytest.approx(27 / 6), None, None)
    mark = spark.createDataFrame([("pc", "temperature", t("2024-01-01 13:00:00"))], "round_id string, observable_name string, mark timestamp_ntz")
    newer = rollups.latest_over_space(ambient, mark).collect()[0]
    assert (newer.mean, newer.old_time) == (5.5, datetime(2024, 1, 1, 13))


def test_rounds_leave_out_the_running_lap(spark, ambient, anomaly):
    last = marks.last_rows(ambient)
    assert rows_of(last, "last_round_number", "last_day", "last_time") == [(4, 2, datetime(2024, 1, 3, 9))]
    rounds = rollups.round_over_time(ambient, last)
    assert sorted({r[0] for r in rows_of(rounds, "round_number")}) == [1, 2, 3]
    laps = counter(spark, ("pc", "2024-01-01 08:00:00", 1, 1), ("pc", "2024-01-01 08:30:00", 1, 1), ("pc", "2024-01-01 12:00:00", 2, 0))
    space = {r.round_number: r for r in rollups.round_over_space(rounds, laps).collect()}
    assert space[1].time == datetime(2024, 1, 1, 8, 30) and space[1].mean == 4.0
    assert space[2].time == datetime(2024, 1, 1, 13) and space[2].sd is None
    total = rollups.round_over_space(rollups.round_over_time(anomaly, marks.last_rows(anomaly)), laps)
    assert rows_of(total.filter("round_number = 1"), "mean", "total") == [(None, 12.0)]
    mark = spark.createDataFrame([("pc", "temperature", 2)], "round_id string, observable_name string, mark int")
    assert sorted({r[0] for r in rows_of(rollups.round_over_time(ambient, last, mark), "round_number")}) == [2, 3]


def test_days(spark, ambient, anomaly):
    last = marks.last_rows(ambient)
    days = rollups.day_over_time(ambient, last)
    assert rows_of(days, "day", "x", "y", "value", "time") == [
        (0, 0, 0, 2.5, datetime(2024, 1, 1, 12)),
        (0, 0, 1, 2.0, datetime(2024, 1, 1, 12)),
        (1, 0, 1, 5.0, datetime(2024, 1, 2, 12)),
    ]
    assert rows_of(rollups.day_over_space(days), "day", "mean", "total") == [(0, 2.25, None), (1, 5.0, None)]
    peaks = rollups.day_over_time(anomaly, marks.last_rows(anomaly))
    assert rows_of(peaks, "day", "y", "value") == [(0, 0, 4.0), (0, 1, 2.0), (1, 1, 5.0)]


def test_quadrant_rollup(spark, ambient):
    last = marks.last_rows(ambient)
    quadrants = rollups.tod_over_time(ambient, last)
    assert rows_of(quadrants, "time_of_day", "time", "x", "y", "value", "day") == [
        (1, datetime(2024, 1, 1, 10), 0, 0, 1.0, 0),
        (1, datetime(2024, 1, 1, 10), 0, 1, 2.0, 0),
        (2, datetime(2024, 1, 1, 14), 0, 0, 4.0, 0),
        (4, datetime(2024, 1, 3, 2), 0, 1, 5.0, 1),
    ]
    mark = marks.last_time_of_day(rollups.tod_over_space(quadrants.filter("time_of_day = 1")))
    assert rows_of(rollups.tod_over_time(ambient, last, mark), "time_of_day") == [(2,), (4,)]
    assert rows_of(rollups.last_closed_quadrant(ambient, last), "mark") == [(datetime(2024, 1, 3, 2),)]


def test_hours(ambient, anomaly):
    hours = rows_of(rollups.hourly_overview(ambient), "time", "mean", "sd", "total")
    assert hours[0] == (datetime(2024, 1, 1, 9), 4.0, 3.56, None)
    assert rows_of(rollups.hourly_overview(anomaly), "time", "mean", "sd", "total")[0] == (datetime(2024, 1, 1, 9), 4.0, None, 12.0)
    done = marks.last_hour(rollups.hourly_overview(ambient.filter("time < '2024-01-01 14:00:00'")))
    assert [r[0].hour for r in rows_of(rollups.hourly_overview(ambient, done), "time")] == [13, 21, 9]


def test_triggers(spark, ambient):
    batch = cells(spark, [(0, 0, 4, 6.0, "2024-01-03 09:30:00", 2)])
    context = spark.createDataFrame(
        [("pc", "temperature", "rb", 3, 3, "ambient_condition")], "round_id string, observable_name string, robot_id string, x_dim int, y_dim int, obs_type string"
    )
    never = spark.createDataFrame([], "round_id string, observable_name string, mark timestamp_ntz")
    same = triggers.new_units(batch, marks.last_rows(ambient), never)
    flags = ["is_new_round", "is_new_day", "is_new_time_of_day", "is_new_hourly_overview"]
    assert rows_of(same, *flags) == [(False, False, True, False)]
    first = triggers.new_units(batch, marks.last_rows(ambient.limit(0)), never)
    rows = triggers.time_triggers(first, context)
    assert [r[0] for r in rows_of(rows, "event_type")] == ["DERIVED_OBSERVABLE"] * 3 + [
        "LATEST", "NEW_HOURLY_OVERVIEW", "NEW_NEW_DAY", "NEW_ROUND", "NEW_TIME_OF_DAY",
    ]
    assert ("NEW_ROUND", "round.event") in rows_of(rows, "event_type", "routing_key")
    assert ("NEW_NEW_DAY", "frontend.new_day") in rows_of(triggers.frontend_triggers(rows), "event_type", "routing_key")
    morning = spark.createDataFrame([("pc", "temperature", t("2024-01-02 10:00:00"))], "round_id string, observable_name string, mark timestamp_ntz")
    assert rows_of(triggers.new_units(batch, marks.last_rows(ambient), morning), "is_new_time_of_day") == [(False,)]
    older = spark.createDataFrame([("pc", "temperature", t("2024-01-01 10:00:00"))], "round_id string, observable_name string, mark timestamp_ntz")
    assert rows_of(triggers.new_units(batch, marks.last_rows(ambient), older), "is_new_time_of_day") == [(True,)]


def inputs(spark, temp, hum, air=None):
    at = "2024-01-01 09:00:00"
    out = cells(spark, [(0, 0, 1, temp, at, 0)]).unionByName(cells(spark, [(0, 0, 1, hum, at, 0)], observable="humidity"))
    return out if air is None else out.unionByName(cells(spark, [(0, 0, 1, air, at, 0)], observable="airspeed"))


def test_formulas(spark):
    temp, hum, air = 30.0, 60.0, 0.5
    row = inputs(spark, temp, hum, air)
    got = {n: d.derive(row, n).collect()[0].value for n in ("humidex", "heat_stress_index", "effective_temperature")}
    assert got["heat_stress_index"] == 90.0
    assert got["humidex"] == pytest.approx(temp + (6.112 * ((7.5 * temp) / (237.7 + temp)) ** 10 * hum / 100 - 10) * 5 / 9)
    wet = temp * math.atan(0.1515977 * (hum + 8.31659) ** 0.5) + math.atan(temp + hum) - math.atan(hum - 1.676331)
    wet += 0.00391838 * hum**1.5 * math.atan(0.023101 * hum) - 4.686035
    assert got["effective_temperature"] == pytest.approx(0.94 * temp + 0.25 * wet + 0.7 - 0.15 * (41 - temp) * (math.exp(air) - math.exp(0.2)))


def droppings(spark, good, bad):
    at = "2024-01-01 09:00:00"
    one = cells(spark, [(0, 0, 1, good, at, 0)], observable="good_droppings", kind="anomaly")
    return one.unionByName(cells(spark, [(0, 0, 1, bad, at, 0)], observable="bad_droppings", kind="anomaly"))


def test_digestion_index(spark):
    assert rows_of(d.derive(droppings(spark, 3.0, 1.0), "digestion_index"), "value", "obs_type") == [(75.0, "anomaly")]
    assert rows_of(d.derive(droppings(spark, 0.0, 0.0), "digestion_index"), "value") == [(0.0,)]


def test_not_a_number_becomes_zero(spark):
    assert rows_of(d.derive(inputs(spark, 20.0, -20.0, 0.1), "effective_temperature"), "value") == [(0.0,)]


def test_inputs_that_do_not_meet(spark):
    assert d.derive(inputs(spark, 20.0, 50.0), "effective_temperature").count() == 0
    other_time = cells(spark, [(0, 0, 1, 1.0, "2024-01-01 09:00:00", 0)]).unionByName(
        cells(spark, [(0, 0, 1, 1.0, "2024-01-01 09:00:01", 0)], observable="humidity")
    )
    assert d.derive(other_time, "humidex").count() == 0
    assert rows_of(d.ready_cycles(other_time, "humidex"), "ready") == [(True,)]
    assert rows_of(d.ready_cycles(other_time, "effective_temperature"), "ready") == [(False,)]


def test_heights_do_not_multiply(spark):
    base = inputs(spark, 20.0, 50.0)
    high = base.filter("observable_name = 'humidity'").withColumns({"z": F.lit(1), "value": F.lit(99.0)})
    assert rows_of(d.derive(base.unionByName(high), "heat_stress_index"), "z", "value") == [(0, 70.0)]


def test_laps_to_compute(spark):
    stored = cells(spark, [(0, 0, 2, 1.0, "2024-01-01 12:00:00", 0)], observable="humidex")
    base = inputs(spark, 20.0, 50.0)
    laps = [("pc", f"2024-01-01 {h:02d}:00:00", n, v) for n, h, v in ((1, 8, 1), (2, 11, 1), (3, 13, 1), (4, 15, 0), (5, 17, 1))]
    columns = ["first_round", "last_round"]
    assert rows_of(d.round_range(base, "humidex", counter(spark, *laps)), *columns) == [(1, 5)]
    assert rows_of(d.round_range(base, "humidex", counter(spark, *laps), stored), *columns) == [(3, 5)]
    assert rows_of(d.round_range(base, "humidex", counter(spark, *laps[:3]), stored), *columns) == [(2, 3)]
    assert rows_of(d.round_range(base, "humidex", counter(spark, *laps[:1])), *columns) == [(0, 1)]


def test_own_derived_observable(spark):
    register_derived("dryness", ["temperature", "humidity"], lambda c: c["temperature"] - c["humidity"])
    try:
        assert rows_of(d.derive(inputs(spark, 20.0, 50.0), "dryness"), "value") == [(-30.0,)]
    finally:
        from gridlap.functions import formulas

        formulas._REGISTRY.pop("dryness")
    with pytest.raises(KeyError):
        derived("dryness")
