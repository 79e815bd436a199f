"""Files, messages and scans."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from frames import cells, rows_of, t

from gridlap.sources import messages, scans

AT = datetime(2021, 11, 11, 9, 34, 1)
CSV = 'timestamp,x,y,z,value\n"2021-11-11T09:34:01Z",38.59,16.30,0.01,31.80\n'
JSON = json.dumps({"coordinates": [38.59, 16.3, 0.01], "timestamp": "2021-11-11T09:34:01Z", "data": 31.8, "unit": "C"}) + "\n"
PARSED = ["time", "x", "y", "z", "value", "is_bad"]


def parse(spark, text, file_id="f"):
    lines = spark.createDataFrame([(file_id, line) for line in text.split("\n")], "file_id string, line string")
    return messages.parse_lines(lines)


def test_csv_swaps_and_truncates(spark):
    assert rows_of(parse(spark, CSV), *PARSED) == [(AT, 16, 38, 0, 31.8, False)]


def test_json_does_not_swap(spark):
    assert rows_of(parse(spark, JSON), *PARSED) == [(AT, 38, 16, 0, 31.8, False)]


def test_columns_are_found_by_name(spark):
    text = 'value , z, timestamp , y ,x\n31.8, 0.9,"2021-11-11T09:34:01Z" , -16.3,38.5\n'
    assert rows_of(parse(spark, text), *PARSED) == [(AT, -16, 38, 0, 31.8, False)]


BAD = {
    "unreadable time": CSV.replace("2021-11-11T", "11.11.2021 "),
    "no number": CSV.replace("31.80", "hot"),
    "missing coordinate": CSV.replace("38.59", ""),
    "too long": CSV.replace("31.80", "31.80,7"),
    "json in csv": CSV + JSON,
    "csv in json": JSON + CSV.split("\n")[1],
    "no header": CSV.split("\n")[1],
    "broken json": JSON + "{broken",
}


@pytest.mark.parametrize("case", sorted(BAD))
def test_bad_lines(spark, case):
    assert parse(spark, BAD[case]).filter("is_bad").count() >= 1


@pytest.mark.parametrize("value", ["", "NaN"])
def test_missing_value_is_not_bad(spark, value):
    assert rows_of(parse(spark, CSV.replace("31.80", value)), "value", "is_bad") == [(None, False)]


def test_folder_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV + CSV.split("\n")[1].replace("34:01", "35:01") + "\n")
    (tmp_path / "b.json").write_text(JSON)
    (tmp_path / "c.csv").write_text("")
    folder = messages.read_lines(spark, str(tmp_path)).first().file_id.rsplit("/", 1)[0]
    names = [f"{folder}/{n}" for n in ("a.csv", "b.json", "c.csv")]
    manifest = spark.createDataFrame(
        [(n, "pc", "rb", "temperature", "temperature", "ambient_condition", 3, 3) for n in names],
        "file_id string, round_id string, robot_id string, observable_name string, observable_id string, obs_type string, x_dim int, y_dim int",
    )
    got = messages.read_files(spark, str(tmp_path), manifest)
    assert rows_of(got, "x", "is_bad", "round_id") == [(16, False, "pc"), (16, False, "pc"), (38, False, "pc")]
    flagged = messages.with_empty_flag(manifest, messages.read_lines(spark, str(tmp_path)))
    assert [r[1] for r in rows_of(flagged, "file_id", "is_empty")] == [False, False, True]


def test_fixed_order_readers(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "json").mkdir()
    (tmp_path / "csv" / "a.csv").write_text(CSV + '"2021-11-11T09:35:01Z",1.0\n')
    (tmp_path / "json" / "a.json").write_text(JSON + "{broken\n")
    assert rows_of(messages.read_csv_readings(spark, str(tmp_path / "csv")), "x", "value", "is_bad") == [(16, 31.8, False), (None, None, True)]
    assert rows_of(messages.read_json_readings(spark, str(tmp_path / "json")), "x", "value", "is_bad") == [(38, 31.8, False), (None, None, True)]


def envelope(content, name="s3/a"):
    return json.dumps({
        "file_content": content, "roundId": "pc", "robotId": "rb", "observableName": "temperature", "observableId": "o1",
        "dimension": {"dimX": 4, "dimY": 5}, "type": "ambient_condition", "dataFile": name,
    })


def test_envelopes(spark):
    bodies = [envelope(CSV), envelope(CSV), envelope(CSV.splitlines(keepends=True), "s3/b"), envelope("", "s3/c")]
    files = messages.parse_envelopes(spark.createDataFrame([(b,) for b in bodies], "value string"))
    got = messages.envelope_readings(files)
    assert rows_of(got, "file_id", "x", "observable_id", "x_dim", "y_dim") == [("s3/a", 16, "o1", 4, 5), ("s3/b", 16, "o1", 4, 5)]
    assert rows_of(messages.envelope_manifest(files), "file_id", "is_empty") == [("s3/a", False), ("s3/b", False), ("s3/c", True)]


def test_trigger_messages_round_trip(spark):
    body = json.dumps({"event_type": "LATEST", "roundId": "pc", "robotId": "rb", "observableName": "humidity", "x_dim": 3, "y_dim": 4, "type": "anomaly"})
    parsed = messages.parse_event_messages(spark.createDataFrame([(body,)], "value string"))
    from pyspark.sql import functions as F

    sent = messages.trigger_messages(parsed.withColumn("routing_key", F.lit("latest.event"))).collect()[0]
    assert sent.key == "latest.event" and json.loads(sent.value) == json.loads(body)


def test_scans(spark):
    table = cells(spark, [(0, 0, 1, 1.255, "2024-01-01 09:00:00", 0), (-1, 0, 2, 2.0, "2024-01-01 10:00:00", -1), (1, 1, 2, 3.0, "2024-01-01 11:00:00", 0)])
    assert scans.cells_since(table, "pc", "temperature", t("2024-01-01 09:00:00")).count() == 2
    assert scans.latest_cells(table, "pc", "temperature", t("2024-01-01 09:00:00")).count() == 1
    assert scans.round_cells(table, "pc", "temperature", 2).count() == 1
    assert scans.placed_rows(table, "pc", "temperature", "round_number").count() == 2
    assert scans.unit_times(table, "pc", "temperature", "round_number").count() == 3
    digits = spark.createDataFrame([("temperature", 1)], "code_name string, observable_precision int")
    assert rows_of(scans.with_precision(table, digits), "value") == [(1.3,), (2.0,), (3.0,)]
