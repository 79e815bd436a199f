from __future__ import annotations

import gzip
import hashlib
import io

import duckdb
import pytest

from gridlap.llm import warc
from gridlap.llm.common import new_folder

PAGES = "page_id long, url string, html string, digest string"


def round_trip(spark, rows, **sizes):
    folder = new_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([(*r, "own") for r in rows], PAGES), folder, **sizes)
    return warc.assemble(warc.read_segments(spark, folder)), folder


def test_payloads_survive_segments_and_chunks(spark):
    nasty = "é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n0\r\n\r\n" * 60
    rows = [(1, "http://a/", nasty), (2, "http://b/\r\nX: y", "x" * 5000), (3, None, ""), (4, "u", None), (5, "v", "日本語" * 700), (-6, "w", "z" * 200_000)]
    records, folder = round_trip(spark, rows, segment_bytes=700, chunk_bytes=97)
    found = {r.page_id: r for r in records.select("*", warc.page_id_of(records.record_id).alias("page_id")).collect()}
    assert {k: bytes(r.payload) for k, r in found.items()} == {k: (h or "").encode() for k, _, h in rows}
    assert all(r.complete and r.digest == hashlib.sha1(bytes(r.payload)).hexdigest() for r in found.values())
    raw = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(folder).collect())
    kinds = [r["record_type"] for r in warc.parse_archive(io.BytesIO(raw))]
    assert kinds.count("response") == 6 and kinds.count("continuation") > 200


def test_revisits(spark):
    long, short = "a" * 1000, "a" * 999
    rows = [(1, "u", long), (5, "u", long), (3, "u", long), (5, "u", long), (2, "u", short), (4, "u", short), (None, "u", long), (9, "u", "é" * 499 + "ab")]
    records, _ = round_trip(spark, rows)
    out = warc.with_targets(warc.described(records)).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in out) == sorted(
        [("1", "revisit", 5, 1000), ("3", "revisit", 5, 1000), ("5", "response", None, 1000), ("5", "response", None, 1000), ("2", "response", None, 999),
         ("4", "response", None, 999), ("None", "revisit", 5, 1000), ("9", "response", None, 1000)]
    )


def test_revisits_name_a_record_that_exists(spark):
    rows = [(k, "u", "a" * 1500 + str(k % 3)) for k in range(30)] + [(99, "u", "b" * 90_000), (98, "u", "b" * 90_000)]
    records, folder = round_trip(spark, rows, segment_bytes=7_000)
    found = records.collect()
    responses = {r.record_id: r.digest for r in found if r.record_type == "response"}
    revisits = [r for r in found if r.record_type == "revisit"]
    assert len(responses) == 4 and len(revisits) == 28 and all(responses[r.refers_to] == r.digest for r in revisits)
    heads = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(folder).collect())
    assert heads.count(b"\r\nWARC-Date: 20") == heads.count(b"WARC/1.1\r\n")


def test_damaged_records_are_marked(spark):
    block = warc.HTTP_HEAD + warc.chunked(b"hello", 3)
    whole = ("u", "response", None, "d")
    rows = [
        ("<r:1>", *whole, 1, None, block[:50]), ("<r:1>", None, "continuation", None, None, 2, len(block), block[50:]),
        ("<r:2>", *whole, 1, None, block[:50]), ("<r:2>", None, "continuation", None, None, 3, len(block), block[50:]),
        ("<r:3>", *whole, 1, None, block[:50]), ("<r:3>", None, "continuation", None, None, 2, 7, block[50:]),
        ("<r:4>", *whole, 0, None, block[:-6]), ("<r:5>", *whole, 0, None, block),
    ]
    out = {r.record_id: r for r in warc.assemble(spark.createDataFrame(rows[::-1], warc.RECORD_SCHEMA)).collect()}
    assert {k: r.complete for k, r in out.items()} == {"<r:1>": True, "<r:2>": False, "<r:3>": False, "<r:4>": False, "<r:5>": True}
    assert bytes(out["<r:1>"].payload) == b"hello" and out["<r:2>"].payload is None


def test_empty_table(spark):
    records, _ = round_trip(spark, [])
    assert records.count() == 0


@pytest.mark.parametrize("size", [1, 3, 100])
def test_chunked_framing(size):
    for payload in (b"", b"a", "äöü".encode() * 9):
        assert warc.unchunked(warc.chunked(payload, max(size, 4))) == payload
    assert warc.unchunked(b"5\r\nab") is None and warc.unchunked(b"x\r\n") is None


def test_same_as_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    order = "page_id, payload_bytes, payload_digest, record_type, refers_to, complete"
    expected = con.execute(f"SELECT {order} FROM ({warc.ORACLE_SQL})").fetchall()
    found = warc.op7_warc(spark, sf_dir).select(*order.split(", ")).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
