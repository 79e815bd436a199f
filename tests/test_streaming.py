"""Micro-batches against one batch, repeated delivery, late data, retraction."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from frames import counter, cycles, rows_of, sensors

from gridlap.plans.pipeline import Controls, ingest, process_batch, refresh_cells
from gridlap.session import stage
from gridlap.sources.messages import parse_envelopes
from gridlap.streaming.fence import open_writer
from gridlap.streaming.ingest import message_files, start_ingest
from gridlap.streaming.store import Store

CELL = ["round_id", "observable_name", "round_number", "x", "y", "z", "value", "time", "day_of_production"]
TABLES = {
    "cells": CELL,
    "latest_over_time": ["round_id", "observable_name", "x", "y", "value", "time"],
    "round_over_time": ["round_id", "observable_name", "round_number", "x", "y", "value", "time"],
    "round_over_space": ["round_id", "observable_name", "round_number", "mean", "sd", "total", "time"],
    "day_over_time": ["round_id", "observable_name", "day", "x", "y", "value", "time"],
    "day_over_space": ["round_id", "observable_name", "day", "mean", "sd", "total", "time"],
    "tod_over_time": ["round_id", "observable_name", "window_start", "x", "y", "value", "day"],
    "tod_over_space": ["round_id", "observable_name", "window_start", "mean", "sd", "total", "time"],
    "hourly_overview": ["round_id", "observable_name", "time", "mean", "sd", "total", "round_number", "day"],
}


def message(file_id, start, values, observable="temperature", kind="ambient_condition", round_id="007", minutes=3, robot="rb"):
    """A file with a reading every few minutes, walking over the grid."""
    lines = ["timestamp,x,y,z,value"]
    for i, v in enumerate(values):
        at = datetime.fromisoformat(start) + timedelta(minutes=minutes * i)
        lines.append(f'"{at:%Y-%m-%dT%H:%M:%SZ}",{i % 3}.4,{i % 2}.6,0.01,{v}')
    body = {
        "file_content": "\n".join(lines) + "\n", "roundId": round_id, "robotId": robot, "observableName": observable,
        "observableId": observable, "dimension": {"dimX": 3, "dimY": 3}, "type": kind, "dataFile": file_id,
    }
    return json.dumps(body)


def messages():
    out = []
    for d in range(1, 4):
        for h in (1, 9, 13, 22):
            start = f"2024-01-{d:02d} {h:02d}:00:00"
            out.append(message(f"t{d}-{h}", start, [20 + d + i * 0.5 for i in range(8)]))
            out.append(message(f"h{d}-{h}", start, [50 + d + i for i in range(8)], "humidity"))
            out.append(message(f"b{d}-{h}", start, [1, 0, 2, 0, 1, 3, 0, 1], "bad_droppings", "anomaly"))
    return out


@pytest.fixture(scope="module")
def controls(spark):
    laps = []
    for d in range(1, 5):
        for k, h in enumerate((0, 8, 16)):
            n = (d - 1) * 3 + k + 1
            laps.append(("007", f"2024-01-{d:02d} {h:02d}:00:00", n, 1))
    return Controls(
        counter(spark, *laps),
        cycles(spark, ("007", "2024-01-01")),
        sensors(spark, ("rb", "temperature"), ("rb", "humidity"), ("rb", "bad_droppings")),
        spark.createDataFrame([("007", 3, 3)], "round_id string, x_dim int, y_dim int"),
    )


def run(spark, root, controls, batches, first=0, frontend=False):
    store = Store(spark, str(root))
    for i, batch in enumerate(batches):
        df = parse_envelopes(spark.createDataFrame([(m,) for m in batch], "value string"))
        process_batch(store, df, controls, first + i, frontend)
    return store


def _document(text):
    return json.dumps(json.loads(text, parse_float=lambda f: round(float(f), 9)), sort_keys=True)


def snapshot(store):
    out = {name: rows_of(store.read(name), *columns) for name, columns in TABLES.items()}
    display = rows_of(store.read("frontend_data"), "round_id", "observable_name", "event_type", "type_of_plot", "data")
    out["frontend"] = [(*row[:4], _document(row[4])) for row in display]
    return out


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory, controls):
    return snapshot(run(spark, tmp_path_factory.mktemp("whole"), controls, [messages()], frontend=True))


def _same(a, b, skip=("frontend",)):
    for name in a:
        if name not in skip:
            assert a[name] == b[name], name


def test_one_batch_fills_every_table(whole):
    for name, rows in whole.items():
        assert rows, name
    assert {r[0] for r in whole["cells"]} == {"007"}  # not read back as a number
    assert {r[1] for r in whole["cells"]} == {"temperature", "humidity", "bad_droppings", "humidex", "heat_stress_index"}


def test_invalid_start_is_retracted(spark, tmp_path, controls):
    """The counter learns of an invalid start after the lap's cells were stored; closing the lap removes what came after it."""
    known = counter(spark, ("007", "2024-01-02 09:12:00", 5, 0))
    later = replace(controls, counter=controls.counter.unionByName(known))
    lap5 = message("a", "2024-01-02 08:30:00", [20 + i for i in range(30)])
    store = run(spark, tmp_path, controls, [[lap5]])
    late = datetime(2024, 1, 2, 9, 12)
    times = [r[7] for r in rows_of(store.read("cells"), *CELL)]
    assert any(at >= late for at in times) or max(times) < late
    spread = message("b", "2024-01-02 10:00:00", [20 + i for i in range(8)])
    store = run(spark, tmp_path, controls, [[spread]], first=1)
    stored = {r[:6] for r in rows_of(store.read("cells"), *CELL) if r[7] >= late}
    assert stored
    lap6 = message("c", "2024-01-02 17:00:00", [20 + i for i in range(8)])
    store = run(spark, tmp_path, later, [[lap6]], first=2)
    left = rows_of(store.read("cells"), *CELL)
    assert {r[2] for r in left} <= {5, 6} and all(r[7] < late for r in left if r[2] == 5)
    assert rows_of(store.batches("alert_notification"), "batch_id", "time") == [(2, late)]


def test_repeated_and_late_batches(spark, tmp_path, controls, whole):
    """Files arrive out of order and one batch is delivered twice."""
    every = messages()
    batches = [every[24:], every[:24]]
    store = run(spark, tmp_path, controls, batches)
    before = snapshot(store)
    triggers = rows_of(store.batches("triggers"), "batch_id", "event_type", "observable_name")
    _same(whole, before, skip=("frontend", "latest_over_space"))
    again = run(spark, tmp_path, controls, [batches[1]], first=1)
    _same(before, snapshot(again))
    assert rows_of(again.batches("triggers"), "batch_id", "event_type", "observable_name") == triggers


def test_rejected_files_and_audit(spark, tmp_path, controls):
    good = message("good", "2024-01-01 09:00:00", [20, 21, 22, 23])
    bad = message("bad", "2024-01-01 09:00:00", [20, "oops", 22])
    unknown = message("unknown", "2024-01-01 09:00:00", [1, 2, 3], "airspeed")
    short = message("short", "2024-01-01 09:00:00", [20])
    empty = json.dumps({**json.loads(good), "dataFile": "empty", "file_content": ""})
    store = Store(spark, str(tmp_path))
    files = stage(parse_envelopes(spark.createDataFrame([(m,) for m in (good, bad, unknown, short, empty)], "value string")), "m")
    ingest(store, files, controls, 0)
    assert rows_of(store.batches("alerts"), "file_id", "kind", "notify") == [
        ("bad", "bad_file", True),
        ("empty", "bad_file", True),
        ("short", "suspicious_data", True),
        ("unknown", "observable_not_available", False),
    ]
    assert {r[0] for r in rows_of(store.batches("ingest_audit"), "url")} == {"good", "bad", "unknown", "short", "empty"}
    assert {r[0] for r in rows_of(store.partials(), "observable_name")} == {"temperature"}


def test_compaction_keeps_the_cells(spark, tmp_path, controls):
    every = messages()
    store = Store(spark, str(tmp_path / "a"))
    for i in (0, 1):
        files = parse_envelopes(spark.createDataFrame([(m,) for m in every[6 * i : 6 * i + 6]], "value string"))
        refresh_cells(store, controls, ingest(store, stage(files, "m"), controls, i), i)
    target = Store(spark, str(tmp_path / "b"))
    store.compact(target)
    columns = ["round_id", "observable_name", "round_number", "x", "y", "value_sum", "rows", "first_key"]
    assert rows_of(target.partials(), *columns) == rows_of(store.partials(), *columns)
    assert rows_of(target.batches("partials").select("batch_id").distinct(), "batch_id") == [(1,)]
    for table in ("cells", "unit_marks", "cell_spans"):
        assert target.read(table).count() == store.read(table).count() > 0
    assert rows_of(target.log("accepted_files", 2), "file_id") == rows_of(store.log("accepted_files", 2), "file_id") != []
    assert open_writer(spark, target.root, str(tmp_path / "offsets"), "ingest").number(0) == 2


def test_only_touched_folders_are_read(spark, tmp_path, controls):
    store = Store(spark, str(tmp_path))
    files = parse_envelopes(spark.createDataFrame([(m,) for m in messages()[:6]], "value string"))
    slices = ingest(store, stage(files, "m"), controls, 0)
    plan = store.partials(slices)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_stream_equals_batch(spark, tmp_path, controls, whole):
    every = messages()
    source = tmp_path / "in"
    source.mkdir()
    for i in range(0, len(every), 18):
        (source / f"{i:03d}.txt").write_text("\n".join(every[i : i + 18]) + "\n")
    store = Store(spark, str(tmp_path / "out"))
    stream = start_ingest(
        message_files(spark, str(source), max_files=1), store, lambda: controls, str(tmp_path / "offsets"), available_now=True
    )
    stream.awaitTermination(600)
    assert stream.exception() is None
    parts = snapshot(store)
    _same(whole, parts)
    # The latest mean is taken over the cells of the last batch only, so that one document differs.
    assert [r for r in whole["frontend"] if r[2:4] != ("latest", "graph")] == [r for r in parts["frontend"] if r[2:4] != ("latest", "graph")]


def test_a_file_sent_again_counts_once(spark, tmp_path, controls):
    """The same file in two batches: sums stay, and the second delivery is reported."""
    file = message("a", "2024-01-01 09:00:00", [20 + i for i in range(8)])
    store = run(spark, tmp_path, controls, [[file]])
    store = run(spark, tmp_path, controls, [[file, message("b", "2024-01-01 13:00:00", [30 + i for i in range(8)])]], first=1)
    sums = rows_of(store.partials(), "value_sum", "rows")
    assert (sum(r[0] for r in sums), sum(r[1] for r in sums)) == (sum(range(20, 28)) + sum(range(30, 38)), 16)
    assert rows_of(store.batches("alerts"), "file_id", "kind", "batch_id") == [("a", "repeated_file", 1)]


def take_in(spark, root, controls, batches):
    """The first steps of a batch alone: partials, alerts, triggers, cells and their state."""
    store = Store(spark, str(root))
    for i, batch in enumerate(batches):
        slices = ingest(store, parse_envelopes(spark.createDataFrame([(m,) for m in batch], "value string")), controls, i)
        refresh_cells(store, controls, slices, i)
    return store


def test_discarded_laps_do_not_depend_on_the_cut(spark, tmp_path, controls):
    """Laps that a batch jumps over are closed too: the same alerts from one batch as from several."""
    starts = counter(spark, ("007", "2024-01-01 09:12:00", 2, 0), ("007", "2024-01-02 17:12:00", 6, 0))
    later = replace(controls, counter=controls.counter.unionByName(starts))
    hours = ["01 01", "01 09", "01 17", "02 01", "02 17", "03 09"]
    files = [message(f"f{h}", f"2024-01-{h}:00:00", [20 + i for i in range(8)]) for h in hours]
    one = take_in(spark, tmp_path / "one", later, [files])
    cut = take_in(spark, tmp_path / "cut", later, [files[:2], files[2:4], files[4:]])
    expected = [("007", datetime(2024, 1, 1, 9, 12)), ("007", datetime(2024, 1, 2, 17, 12))]
    for store in (one, cut):
        assert rows_of(store.batches("alert_notification"), "robot_id", "time") == expected


def test_a_jump_retracts_the_laps_between(spark, tmp_path, controls):
    """The counter learns of an invalid start late, and the next batch jumps beyond the lap and its slice."""
    far = counter(spark, *[("007", f"2024-01-{d:02d} 00:00:00", d + 8, 1) for d in range(5, 20)])
    known = replace(controls, counter=controls.counter.unionByName(far))
    late = datetime(2024, 1, 2, 9, 12)
    later = replace(known, counter=known.counter.unionByName(counter(spark, ("007", str(late), 5, 0))))
    first = message("a", "2024-01-02 10:00:00", [20 + i for i in range(8)])
    store = run(spark, tmp_path, known, [[first]])
    assert rows_of(store.read("cells"), "round_number")
    store = run(spark, tmp_path, later, [[message("c", "2024-01-15 10:00:00", [20 + i for i in range(8)])]], first=1)
    assert {r[0] for r in rows_of(store.read("cells"), "round_number")} == {23}
    assert rows_of(store.batches("alert_notification"), "batch_id", "time") == [(1, late)]


def test_every_robot_of_an_accepted_file_gets_triggers(spark, tmp_path, controls):
    pairs = sensors(spark, ("rb", "temperature"), ("rc", "temperature"), ("rz", "humidity"))
    values = [20 + i for i in range(8)]
    files = [message(f"f{r}", "2024-01-01 09:00:00", values, robot=r) for r in ("rb", "rc", "rz")]  # rz does not carry the sensor
    store = take_in(spark, tmp_path, replace(controls, robot_observable=pairs), [files])
    latest = store.batches("triggers").filter("event_type = 'LATEST'")
    assert rows_of(latest, "robot_id", "observable_name") == [("rb", "temperature"), ("rc", "temperature")]
