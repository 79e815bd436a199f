"""As-of assignment and the per-file rules."""

from __future__ import annotations

from datetime import timedelta

from frames import counter, cycles, readings, rows_of, sensors, t
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridlap.operators.laps import LapIndex, assign_laps
from gridlap.operators.quality import check_files


def match(spark, laps, times, by_minute=True):
    rows = readings(spark, [(at, 0, 0, 1.0) for at in times])
    found = LapIndex.build(counter(spark, *laps)).match(rows, by_minute=by_minute)
    return {str(r[0]): r[1] for r in rows_of(found, "time", "round_number")}


def test_counter_row_claims_its_whole_minute(spark):
    laps = [("pc", "2024-01-01 10:00:30", 1, 1)]
    assert match(spark, laps, ["2024-01-01 10:00:10"]) == {"2024-01-01 10:00:10": 1}
    assert match(spark, laps, ["2024-01-01 10:00:10"], by_minute=False) == {"2024-01-01 10:00:10": None}
    assert match(spark, laps, ["2024-01-01 09:59:59"]) == {"2024-01-01 09:59:59": None}


def test_last_row_of_a_minute_wins(spark):
    laps = [("pc", "2024-01-01 10:00:10", 1, 1), ("pc", "2024-01-01 10:00:40", 2, 1)]
    found = match(spark, laps, ["2024-01-01 10:00:20", "2024-01-01 10:05:00"])
    assert found == {"2024-01-01 10:00:20": 2, "2024-01-01 10:05:00": 2}
    assert match(spark, laps, ["2024-01-01 10:00:20"], by_minute=False) == {"2024-01-01 10:00:20": 1}


def test_lap_runs_over_days_without_counter_rows(spark):
    laps = [("pc", "2024-01-01 22:00:00", 1, 1), ("pc", "2024-01-05 06:00:00", 2, 1), ("other", "2024-01-01 00:00:00", 9, 1)]
    times = ["2024-01-01 21:59:00", "2024-01-02 00:00:00", "2024-01-04 23:59:59", "2024-01-05 05:59:59", "2024-01-05 06:00:00",
             "2024-03-01 00:00:00"]
    assert list(match(spark, laps, times).values()) == [None, 1, 1, 1, 2, 2]


def minute_dictionary(laps, at):
    """Literal restatement: each counter row writes all minutes up to the next one's minute, later rows overwrite."""
    minute = at.replace(second=0, microsecond=0)
    found = None
    for when, number in sorted(laps):
        if when.replace(second=0, microsecond=0) <= minute:
            found = number
    return found


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    gaps=st.lists(st.integers(1, 200_000), min_size=1, max_size=25),
    offsets=st.lists(st.integers(-3_000, 2_000_000), min_size=1, max_size=60),
)
def test_same_as_minute_dictionary(spark, gaps, offsets):
    start, laps = t("2024-01-01 07:30:17"), []
    for i, gap in enumerate(gaps):
        laps.append((start, i + 1))
        start += timedelta(seconds=gap)
    times = sorted({laps[0][0] + timedelta(seconds=o) for o in offsets})
    found = match(spark, [("pc", str(at), n, 1) for at, n in laps], [str(at) for at in times])
    assert found == {str(at): minute_dictionary(laps, at) for at in times}


def verdicts(spark, rows, laps, known=("rb", "temperature")):
    index = LapIndex.build(counter(spark, *laps))
    files = check_files(readings(spark, rows), index, cycles(spark, ("pc", "2024-01-02")), sensors(spark, known))
    return files, index


def by_file(files, *columns):
    return {r[0]: tuple(r[1:]) if len(r) > 2 else r[1] for r in rows_of(files, "file_id", *columns)}


def series(file_id, start, n, step, value=lambda i: float(i), x=lambda i: i % 3):
    return [(str(t(start) + timedelta(seconds=step * i)), x(i), 0, value(i), file_id) for i in range(n)]


def test_suspicious_files(spark):
    rows = [
        ("2024-01-02 00:10:00", 0, 0, 1.0, "one"),
        *series("flat-11-min", "2024-01-02 01:00:00", 12, 60, value=lambda i: 5.0),
        *series("flat-9-min", "2024-01-02 02:00:00", 10, 60, value=lambda i: 5.0),
        *series("still-11-min", "2024-01-02 03:00:00", 12, 60, x=lambda i: 1),
        *series("good", "2024-01-02 04:00:00", 12, 60),
    ]
    files, _ = verdicts(spark, rows, [("pc", "2024-01-01 00:00:00", 1, 1)])
    assert by_file(files, "verdict") == {
        "one": "suspicious_data",
        "flat-11-min": "suspicious_data",
        "flat-9-min": None,
        "still-11-min": "suspicious_data",
        "good": None,
    }


def test_unknown_sensor_comes_first(spark):
    files, _ = verdicts(spark, [("2024-01-02 00:10:00", 0, 0, 1.0)], [("pc", "2024-01-01 00:00:00", 1, 1)], ("rb", "humidity"))
    assert by_file(files, "verdict") == {"f": "observable_not_available"}


def test_file_before_the_first_lap_is_rejected(spark):
    files, _ = verdicts(spark, series("f", "2024-01-02 00:00:00", 5, 60), [("pc", "2024-01-02 00:02:30", 1, 1)])
    assert by_file(files, "verdict") == {"f": "round_not_in_range"}


def test_whole_file_takes_a_shared_lap(spark):
    """The same lap restarted inside a file: all readings keep it, and only the flag at the end counts."""
    laps = [("pc", "2024-01-02 00:00:00", 5, 0), ("pc", "2024-01-02 01:00:00", 6, 0), ("pc", "2024-01-02 02:00:00", 5, 1)]
    rows = [("2024-01-02 00:30:00", 0, 0, 1.0), ("2024-01-02 01:30:00", 1, 0, 2.0), ("2024-01-02 02:30:00", 2, 0, 3.0)]
    files, index = verdicts(spark, rows, laps)
    assert by_file(files, "verdict", "file_round_number", "day_of_production") == {"f": (None, 5, 0)}
    assert [r[1] for r in rows_of(assign_laps(readings(spark, rows), files, index), "x", "round_number")] == [5, 5, 5]
    ended_invalid = [*laps[:2], ("pc", "2024-01-02 02:00:00", 5, 0)]
    assert by_file(verdicts(spark, rows, ended_invalid)[0], "verdict") == {"f": "round_not_valid"}


def test_invalid_laps_are_dropped_per_reading(spark):
    laps = [("pc", "2024-01-02 00:00:00", 5, 1), ("pc", "2024-01-02 01:00:00", 6, 0), ("pc", "2024-01-02 02:00:00", 7, 1)]
    rows = [("2024-01-02 00:30:00", 0, 0, 1.0), ("2024-01-02 01:30:00", 1, 0, 2.0), ("2024-01-02 02:30:00", 2, 0, 3.0)]
    files, index = verdicts(spark, rows, laps)
    assert rows_of(assign_laps(readings(spark, rows), files, index), "x", "round_number") == [(0, 5), (2, 7)]


def test_no_exploding_join_in_the_plan(spark, sf_dir):
    from gridlap.sources.sensor_view import sensor_view

    view = sensor_view(spark, sf_dir)
    found = LapIndex.build(view.counter).match(view.readings)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.filter(F.col("round_number").isNull()).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = LapIndex.build(view.counter).match(view.readings)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan
        assert rows_of(wide, "time", "round_number") == rows_of(found, "time", "round_number")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
