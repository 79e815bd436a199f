"""Jobs driven by stored triggers, batches of several checkpoints, control tables that change late, corrected files."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from frames import counter, rows_of, sensors
from test_streaming import TABLES, _same, controls, message, messages, run, snapshot, whole  # noqa: F401

from gridlap import schemas as S
from gridlap.functions import formulas
from gridlap.plans import pipeline, triggered
from gridlap.plans.pipeline import process_batch
from gridlap.sources.messages import parse_envelopes
from gridlap.streaming.fence import StaleWriter, open_writer
from gridlap.streaming.ingest import message_files, start_ingest
from gridlap.streaming import store as store_module
from gridlap.streaming.store import Store
from gridlap.streaming.triggered import start_events, start_frontend

F = pipeline.F


def take_in(spark, store, controls, batches, first=0):
    for i, batch in enumerate(batches):
        df = parse_envelopes(spark.createDataFrame([(m,) for m in batch], "value string"))
        process_batch(store, df, controls, first + i, rollups=False)


def all_triggers(store):
    rows = store.batches("triggers").unionByName(store.batches("derived_triggers"))
    return rows


def test_three_streams_equal_one_batch(spark, tmp_path, controls, whole):  # noqa: F811
    every = messages()
    source = tmp_path / "in"
    source.mkdir()
    for i in range(0, len(every), 18):
        (source / f"{i:03d}.txt").write_text("\n".join(every[i : i + 18]) + "\n")
    store = Store(spark, str(tmp_path / "out"))
    for start in (
        lambda: start_ingest(message_files(spark, str(source), 1), store, lambda: controls, str(tmp_path / "c1"), True, rollups=False),
        lambda: start_events(store, lambda: controls, str(tmp_path / "c2"), True),
        lambda: start_frontend(store, lambda: controls, str(tmp_path / "c3"), True),
    ):
        stream = start()
        stream.awaitTermination(600)
        assert stream.exception() is None
    parts = snapshot(store)
    _same(whole, parts, skip=("frontend", "latest_over_space"))
    graphs = ("latest", "graph")
    assert [r for r in whole["frontend"] if r[2:4] != graphs] == [r for r in parts["frontend"] if r[2:4] != graphs]
    assert store.batches("failed_events").isEmpty() and store.batches("failed_displays").isEmpty()


def test_only_named_units_are_recomputed(spark, tmp_path, controls):  # noqa: F811
    every = messages()
    store = Store(spark, str(tmp_path))
    take_in(spark, store, controls, [every[:24]])
    triggered.run_events(store, controls, all_triggers(store), 0)
    before = snapshot(store)
    take_in(spark, store, controls, [every[24:]], first=1)
    named = all_triggers(store).filter("batch_id = 1 AND observable_name IN ('humidity', 'humidex')")
    assert not named.isEmpty()
    triggered.run_events(store, controls, named, 1)
    after = snapshot(store)
    whole_ = snapshot(run(spark, tmp_path / "whole", controls, [every]))
    for table, columns in TABLES.items():
        if table in ("cells", "latest_over_space"):
            continue
        at = columns.index("observable_name")
        for name in ("humidity", "humidex", "temperature", "bad_droppings"):
            want = whole_ if name in ("humidity", "humidex") else before
            assert [r for r in after[table] if r[at] == name] == [r for r in want[table] if r[at] == name], (table, name)
    raised = rows_of(store.batches("frontend_triggers").filter("batch_id = 1").select("observable_name").distinct(), "observable_name")
    assert raised == [("humidex",), ("humidity",)]


def test_a_failing_unit_is_set_aside(spark, tmp_path, controls, monkeypatch):  # noqa: F811
    """One observable whose roll-up fails at run time, and an event kind nobody knows: the others are finished."""
    store = Store(spark, str(tmp_path))
    take_in(spark, store, controls, [messages()])
    real = pipeline.rollups.round_over_time

    def poisoned(cells, *args):
        broken = F.raise_error(F.lit("poison")).cast("double")
        return real(cells, *args).withColumn("value", F.when(F.col("observable_name") == "humidity", broken).otherwise(F.col("value")))

    monkeypatch.setattr(pipeline.rollups, "round_over_time", poisoned)
    strange = all_triggers(store).limit(1).withColumn("event_type", F.lit("NEW_MOON"))
    failed = triggered.run_events(store, controls, all_triggers(store).unionByName(strange), 0)
    found = {(r.event_type, r.observable_name): r.error for r in failed.collect()}
    assert {k for k in found if k[0] == S.NEW_ROUND} == {(S.NEW_ROUND, "humidity")} and "poison" in found[(S.NEW_ROUND, "humidity")]
    assert [k[0] for k in found if k[0] != S.NEW_ROUND] == ["NEW_MOON"]
    assert {r[0] for r in rows_of(store.read("round_over_time"), "observable_name")} == {"temperature", "bad_droppings", "humidex", "heat_stress_index"}
    assert {r[0] for r in rows_of(store.read("day_over_time"), "observable_name")} >= {"humidity", "temperature"}
    shown = rows_of(store.batches("frontend_triggers"), "event_type", "observable_name")
    assert (S.NEW_ROUND, "temperature") in shown and (S.NEW_ROUND, "humidity") not in shown and (S.NEW_DAY, "humidity") in shown
    # Fixed, the same triggers finish what was set aside.
    monkeypatch.setattr(pipeline.rollups, "round_over_time", real)
    assert triggered.run_events(store, controls, all_triggers(store), 1).isEmpty()
    assert "humidity" in {r[0] for r in rows_of(store.read("round_over_time"), "observable_name")}


def test_outputs_without_data_are_reported(spark, tmp_path, controls):  # noqa: F811
    store = Store(spark, str(tmp_path))
    take_in(spark, store, controls, [[message("a", "2024-01-01 09:00:00", [20 + i for i in range(8)])]])
    triggered.run_events(store, controls, all_triggers(store), 0)
    triggered.run_frontend(store, controls, store.batches("frontend_triggers"), 0)
    found = rows_of(store.batches("output_alerts").filter("kind = 'empty_output'"), "observable_name", "body")
    # The first lap and quadrant are still running: a graph and a heatmap each. Day 0 is no new day.
    assert [body.split(" of ")[0] for _, body in found] == [f"There is no {e} data for {p}" for e in ("round", "time_of_day") for p in ("graph", "heatmap")]
    assert {r[2] for r in snapshot(store)["frontend"]} == {"latest", "hourly_overview", "hour", "day", "week", "month"}


def test_derived_observables_raise_their_own_triggers(spark, tmp_path, controls):  # noqa: F811
    store = Store(spark, str(tmp_path))
    day1, day2 = messages()[:12], messages()[12:24]
    take_in(spark, store, controls, [day1, day2, []])
    rows = rows_of(store.batches("derived_triggers"), "batch_id", "event_type", "observable_name", "robot_id")
    for name in ("humidex", "heat_stress_index"):
        kinds = [S.LATEST, S.NEW_DAY, S.NEW_HOURLY_OVERVIEW, S.NEW_ROUND, S.NEW_TIME_OF_DAY]
        for n in (0, 1):
            expected = sorted(k for k in kinds if n or k != S.NEW_DAY)  # day 0 is no new day
            assert sorted(r[1] for r in rows if r[0] == n and r[2] == name) == expected, (n, name)
    assert not [r for r in rows if r[0] == 2]
    take_in(spark, store, controls, [day2], first=1)  # delivered again
    assert rows_of(store.batches("derived_triggers"), "batch_id", "event_type", "observable_name", "robot_id") == rows


def test_derived_of_derived(spark, tmp_path, controls, monkeypatch):  # noqa: F811
    monkeypatch.setattr(formulas, "_REGISTRY", dict(formulas._REGISTRY))
    first = dict(formulas._REGISTRY)
    formulas._REGISTRY.clear()
    formulas.register_derived("comfort", ["humidex", "temperature"], lambda c: c["humidex"] - c["temperature"])  # registered before its input
    formulas._REGISTRY.update(first)
    assert formulas.derived_order().index("comfort") > formulas.derived_order().index("humidex")
    store = Store(spark, str(tmp_path))
    take_in(spark, store, controls, [messages()[:12]])
    cells = {(r[0], *r[1:5]): r[5] for r in rows_of(store.read("cells"), "observable_name", "round_number", "x", "y", "time", "value")}
    own = {k[1:]: v for k, v in cells.items() if k[0] == "comfort"}
    assert own and all(v == pytest.approx(cells[("humidex", *k)] - cells[("temperature", *k)]) for k, v in own.items())
    raised = rows_of(store.batches("derived_triggers").filter("event_type = 'LATEST'"), "observable_name")
    assert ("comfort",) in raised
    formulas.register_derived("loop_a", ["loop_b"], lambda c: c["loop_b"])
    formulas.register_derived("loop_b", ["loop_a"], lambda c: c["loop_a"])
    with pytest.raises(ValueError, match="need each other"):
        formulas.derived_order()


def test_a_fresh_checkpoint_loses_nothing(spark, tmp_path, controls, whole):  # noqa: F811
    every = messages()
    store = Store(spark, str(tmp_path / "out"))
    for k, part in enumerate((every[:18], every[18:])):
        source = tmp_path / f"in{k}"
        source.mkdir()
        (source / "m.txt").write_text("\n".join(part) + "\n")
        stream = start_ingest(message_files(spark, str(source)), store, lambda: controls, str(tmp_path / f"offsets{k}"), True)
        stream.awaitTermination(600)
        assert stream.exception() is None
    _same(whole, snapshot(store), skip=("frontend", "latest_over_space"))
    assert rows_of(store.batches("partials").select("batch_id").distinct(), "batch_id") == [(0,), (1,)]


def test_a_replaced_writer_stops(spark, tmp_path):
    root = str(tmp_path / "store")
    old = open_writer(spark, root, str(tmp_path / "a"), "ingest")
    assert [old.number(0), old.number(1), old.number(0)] == [0, 1, 0]
    new = open_writer(spark, root, str(tmp_path / "b"), "ingest")
    with pytest.raises(StaleWriter):
        old.number(2)
    assert [new.number(0), new.number(1)] == [2, 3]
    again = open_writer(spark, root, str(tmp_path / "a"), "ingest")  # the first stream comes back
    assert [again.number(1), again.number(2)] == [1, 4]
    other = open_writer(spark, root, str(tmp_path / "c"), "events")
    assert other.number(0) == 0 and again.number(3) == 5


def test_a_late_invalid_start_retracts_without_new_files(spark, tmp_path, controls):  # noqa: F811
    """The counter learns of an invalid start long after the lap was closed; a batch without files applies it."""
    files = [message(f"f{h}", f"2024-01-{h}:00:00", [20 + i for i in range(8)]) for h in ("02 10", "03 01", "03 09")]
    late = datetime(2024, 1, 2, 9, 12)
    later = replace(controls, counter=controls.counter.unionByName(counter(spark, ("007", str(late), 5, 0))))
    store = run(spark, tmp_path, controls, [files])
    never = snapshot(store)
    assert 5 in {r[2] for r in never["cells"]}
    store = run(spark, tmp_path, later, [[]], first=1)
    assert rows_of(store.batches("alert_notification"), "batch_id", "time") == [(1, late)]
    once = run(spark, tmp_path / "once", later, [files])
    _same(snapshot(once), snapshot(store), skip=("frontend", "latest_over_space"))
    back = run(spark, tmp_path, controls, [[]], first=2)  # the start is taken back
    _same(never, snapshot(back), skip=("frontend", "latest_over_space"))
    assert rows_of(back.batches("counter_changes").filter("batch_id > 0"), "batch_id", "round_number", "is_valid_round") == [(1, 5, 0), (2, 5, None)]


def test_a_resized_grid_redraws_its_cycle(spark, tmp_path, controls):  # noqa: F811
    store = run(spark, tmp_path, controls, [messages()[:12]], frontend=True)
    assert rows_of(store.batches("coordinate_alerts"), "round_id") == []
    smaller = replace(controls, dims=spark.createDataFrame([("007", 3, 1)], "round_id string, x_dim int, y_dim int"))
    store = run(spark, tmp_path, smaller, [[]], first=1, frontend=True)
    assert rows_of(store.batches("coordinate_alerts").select("batch_id").distinct(), "batch_id") == [(1,)]
    assert not [r for r in snapshot(store)["frontend"] if r[2:4] == ("latest", "heatmap") and r[1] == "temperature"]


def test_a_rejected_file_counts_when_it_comes_again(spark, tmp_path, controls):  # noqa: F811
    """Turned away because its robot was not allowed, accepted later, sent once more; and a corrected file under the same name."""
    file = message("a", "2024-01-01 09:00:00", [20 + i for i in range(8)])
    closed = replace(controls, robot_observable=sensors(spark, ("rb", "humidity")))
    store = run(spark, tmp_path, closed, [[file]])
    assert store.partials().isEmpty()
    run(spark, tmp_path, controls, [[file], [file, file]], first=1)
    sums = rows_of(store.partials(), "value_sum", "rows")
    assert (sum(r[0] for r in sums), sum(r[1] for r in sums)) == (sum(range(20, 28)), 8)
    assert rows_of(store.batches("alerts"), "batch_id", "kind") == [(0, "observable_not_available"), (2, "repeated_file")]
    other = message("a", "2024-01-01 13:00:00", [30 + i for i in range(8)])
    run(spark, tmp_path, controls, [[other], [other]], first=3)
    sums = rows_of(store.partials(), "value_sum", "rows")
    assert (sum(r[0] for r in sums), sum(r[1] for r in sums)) == (sum(range(20, 28)) + sum(range(30, 38)), 16)
    assert rows_of(store.batches("accepted_files"), "batch_id", "file_id") == [(1, "a"), (3, "a")]


def _files_read(spark, run_batch):
    """Number of files that the scans of a batch opened."""
    store = spark._jsparkSession.sharedState().statusStore()
    seen = store.executionsCount()
    run_batch()
    total = 0
    executions = store.executionsList(int(seen), 100_000)
    for i in range(executions.size()):
        execution = executions.apply(i)
        names = {}
        metrics = execution.metrics()
        for k in range(metrics.size()):
            if metrics.apply(k).name() == "number of files read":
                names[metrics.apply(k).accumulatorId()] = True
        if names:
            values = store.executionMetrics(execution.executionId())
            total += sum(int(values.get(a).get().replace(",", "")) for a in names if values.contains(a))
    return total


def test_a_batch_reads_a_constant_number_of_files(spark, tmp_path, controls, monkeypatch):  # noqa: F811
    """Six batches, a day each: the last ones read no more files than the earlier ones, and the tables equal one batch."""
    monkeypatch.setattr(store_module, "FOLD_AFTER", 2)
    days = 6
    laps = [("007", f"2024-01-{d:02d} {h:02d}:00:00", (d - 1) * 3 + k + 1, 1) for d in range(1, days + 2) for k, h in enumerate((0, 8, 16))]
    known = replace(controls, counter=counter(spark, *laps))
    batches = [[message(f"t{d}-{h}", f"2024-01-{d:02d} {h:02d}:00:00", [20 + d + i * 0.5 for i in range(8)]) for h in (1, 9, 17)] for d in range(1, days + 1)]
    read = [_files_read(spark, lambda n=n, b=b: run(spark, tmp_path / "cut", known, [b], first=n)) for n, b in enumerate(batches)]
    assert min(read) > 0 and max(read[-2:]) <= 1.25 * max(read[2:4]), read
    whole_ = snapshot(run(spark, tmp_path / "one", known, [[m for b in batches for m in b]]))
    _same(whole_, snapshot(Store(spark, str(tmp_path / "cut"))), skip=("frontend", "latest_over_space"))
