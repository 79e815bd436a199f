"""WARC archives: records cut into segments with chunked transfer framing, and their reassembly.

Writing: each page becomes a response record, or a revisit record where a later page has the same payload of at least 1000 bytes. A
block longer than ``segment_bytes`` goes on in continuation records. Archives are gzip text files whose record terminator is the line
separator, so Spark's own writer puts them on any file system; a file holds about ``ARCHIVE_BYTES`` at most. A revisit names its response by identifier.
Reading: records are cut by their Content-Length. A record in one piece is decoded where it is read; only segments are shuffled, grouped by the
identifier of their first record, put in order, checked for gaps and against the total length, joined, and the chunked framing is undone.

Edge cases: a null html is the empty payload; a null page_id stays null and such a page never is the one that others revisit; repeated rows
are records of their own, and rows that share the largest page_id of a payload are all responses, whose revisits are resolved by digest; a record with missing segments, a wrong
total length or broken framing is returned with ``complete`` false and a null payload; an empty table gives no archive and no rows; extra
columns are ignored. One record and one compressed archive file must fit in memory; a file's records are unpacked as a stream.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm.common import map_arrow, new_folder, stage

REVISIT_BYTES = 1000
SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
ARCHIVE_BYTES = 64 << 20
END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
RECORD_SCHEMA = "record_id string, url string, record_type string, refers_to string, digest string, segment int, total_length long, block binary"


def cut_points(data: bytes, size: int) -> list[int]:
    """Ends of pieces of at most ``size`` bytes (four at least) that do not split a UTF-8 character."""
    ends, at = [], 0
    while len(data) - at > size:
        at += size
        while data[at] & 0xC0 == 0x80:
            at -= 1
        ends.append(at)
    return [*ends, len(data)]


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    out, at = [], 0
    for end in cut_points(payload, size) if payload else []:
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """Payload of a chunked body; None if the framing is broken or the last chunk is missing."""
    out, at = [], 0
    while True:
        line_end = body.find(b"\r\n", at)
        if line_end < 0:
            return None
        try:
            size = int(body[at:line_end].split(b";")[0], 16)
        except ValueError:
            return None
        at = line_end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def record_texts(record_id: str, url: str | None, digest: str, payload: bytes, refers_to: str | None, date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[str]:
    """The records of one page without their terminators."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP_HEAD + chunked(payload, chunk_bytes) if refers_to is None else HTTP_HEAD
    ends, at = cut_points(block, segment_bytes), 0
    for number, end in enumerate(ends, 1):
        head = ["WARC/1.1", f"WARC-Type: {kind if number == 1 else 'continuation'}"]
        head.append(f"WARC-Record-ID: {record_id if number == 1 else record_id[:-1] + f';segment={number}>'}")
        head.append(f"WARC-Date: {date}")
        if number == 1:
            head += [f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}"]
            head += [f"WARC-Refers-To: {refers_to}"] if refers_to else []
        else:
            head.append(f"WARC-Segment-Origin-ID: {record_id}")
        if len(ends) > 1:
            head.append(f"WARC-Segment-Number: {number}")
            head += [f"WARC-Segment-Total-Length: {len(block)}"] if number == len(ends) else []
        head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {end - at}"]
        yield "\r\n".join(head) + END + block[at:end].decode("utf-8")
        at = end


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write all pages (page_id, url, html) as gzip WARC files into ``folder``."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    # Digests alone are shuffled here; the payloads too only where the table of shared ones is too large for the planner to broadcast.
    per_page = rows.where(F.length("payload") >= REVISIT_BYTES).groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    shared = per_page.groupBy("digest").agg(F.max(F.struct("page_id", "n")).alias("last"), F.sum("n").alias("n")).where("n > 1 AND last.page_id IS NOT NULL")
    shared = stage(shared.select(F.col("digest").alias("last_digest"), F.col("last.page_id").alias("last_page"), (F.col("last.n") == 1).alias("is_alone")), "shared-payloads")
    rows = rows.join(shared, (F.col("digest") == F.col("last_digest")) & (F.length("payload") >= REVISIT_BYTES), "left")
    is_last = F.col("page_id").eqNullSafe(F.col("last_page"))
    mark = F.when(is_last & F.col("is_alone"), F.col("digest")).otherwise(F.monotonically_increasing_id().cast("string"))
    rows = rows.select(
        F.format_string("<urn:page:%s:%s>", F.coalesce(F.col("page_id").cast("string"), F.lit("")), mark).alias("record_id"), "url", "digest", "payload",
        F.when(F.col("last_page").isNotNull() & ~is_last, F.format_string("<urn:page:%s:%s>", F.col("last_page").cast("string"), "digest")).alias("refers_to"),
    )
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in batch.to_pylist():
                for text in record_texts(row["record_id"], row["url"], row["digest"], row["payload"], row["refers_to"], date, segment_bytes, chunk_bytes):
                    out.append(text)
                    size += len(text)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
                    out, size = [], 0
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})

    records = map_arrow(rows, run, "value string")
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", max(1, ARCHIVE_BYTES // segment_bytes)).text(folder)


def parse_archive(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of an opened archive, one at a time."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[bytes, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            head[name.strip().lower()] = value.strip().decode("utf-8", "replace")
        block = stream.read(int(head.get(b"content-length", "0")))
        origin = head.get(b"warc-segment-origin-id")
        digest = head.get(b"warc-payload-digest")
        total = head.get(b"warc-segment-total-length")
        yield {
            "record_id": origin or head.get(b"warc-record-id"), "url": head.get(b"warc-target-uri"), "record_type": head.get(b"warc-type"),
            "refers_to": head.get(b"warc-refers-to"), "digest": digest and digest.removeprefix("sha1:"),
            "segment": int(head.get(b"warc-segment-number", "0")), "total_length": int(total) if total else None, "block": block,
        }


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives in ``folder`` as they stand, continuations included."""
    schema = pa.schema([
        ("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()),
        ("segment", pa.int32()), ("total_length", pa.int64()), ("block", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out, size = [], 0
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as unzipped, io.BufferedReader(unzipped, 1 << 18) as stream:
                    for record in parse_archive(stream):
                        out.append(record)
                        size += len(record["block"])
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return map_arrow(files, run, RECORD_SCHEMA)


ASSEMBLED = "record_id string, url string, record_type string, refers_to string, digest string, payload binary, complete boolean"
_KEPT = ["record_id", "url", "record_type", "refers_to", "digest"]


def decoded(block: bytes, record_type: str | None, is_whole: bool) -> tuple[bytes | None, bool]:
    """Payload of a response, and whether the record is complete."""
    head, mark, body = block.partition(b"\r\n\r\n")
    payload = None
    if is_whole and mark and record_type == "response":
        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    return payload, bool(is_whole and (payload is not None or record_type == "revisit"))


def assemble(segments: DataFrame) -> DataFrame:
    """One row per record: record_id, url, record_type, refers_to, digest, payload, complete.

    Segments come in any order. All numbers from 1 to the last must be there once, and the joined length must be the one stated.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield finish(part, part.column("block").to_pylist(), [True] * part.num_rows)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                blocks = [b"".join(row) for row in part.column("blocks").to_pylist()]
                stated = zip(part.column("in_order").to_pylist(), part.column("total_length").to_pylist(), blocks)
                yield finish(part, blocks, [bool(in_order and total == len(block)) for in_order, total, block in stated])

    def finish(part: pa.RecordBatch, blocks: list[bytes], is_whole: list[bool]) -> pa.RecordBatch:
        payloads, complete = zip(*map(decoded, blocks, part.column("record_type").to_pylist(), is_whole)) if blocks else ((), ())
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in _KEPT), pa.array(payloads, pa.binary()), pa.array(complete, pa.bool_())], names=[*_KEPT, "payload", "complete"])

    grouped = segments.where("segment > 0").groupBy("record_id").agg(
        F.sort_array(F.collect_list(F.struct("segment", "record_type", "url", "refers_to", "digest", "total_length", "block"))).alias("parts")
    )
    first, last = F.col("parts")[0], F.element_at("parts", -1)
    in_order = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    parts = grouped.select(
        "record_id", *(first[c].alias(c) for c in _KEPT[1:]), in_order.alias("in_order"), last["total_length"].alias("total_length"),
        F.transform("parts", lambda p: p["block"]).alias("blocks"),
    )
    return map_arrow(segments.where("segment = 0").select(*_KEPT, "block"), whole, ASSEMBLED).union(map_arrow(parts, joined, ASSEMBLED))


def page_id_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)[:>]", 1).try_cast("long")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives: written, read back, reassembled; the payload of a revisit is that of the record it refers to."""
    folder = new_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return with_targets(described(assemble(read_segments(spark, folder))))


def described(records: DataFrame) -> DataFrame:
    """Records without their payloads: record_id, record_type, refers_to, digest, own_bytes, own_digest, complete."""
    own = [F.length("payload").cast("long").alias("own_bytes"), F.sha1("payload").alias("own_digest")]
    return stage(records.select("record_id", "record_type", "refers_to", "digest", *own, "complete"), "records")


def with_targets(records: DataFrame) -> DataFrame:
    """Sizes of revisits come from the responses they name: (page_id, payload_bytes, payload_digest, record_type, refers_to, complete).

    A response that several rows share has no identifier of its own; its revisits are resolved by digest.
    """
    targets = records.where("record_type = 'response' AND own_bytes IS NOT NULL")
    named = targets.groupBy(F.col("record_id").alias("refers_to")).agg(F.max("own_bytes").alias("named_bytes"), F.max("own_digest").alias("named_digest"))
    alike = targets.groupBy(F.col("own_digest").alias("digest")).agg(F.max("own_bytes").alias("alike_bytes"))
    # Only revisits look for a response; the others would meet in the task of the missing name.
    revisits = records.where("refers_to IS NOT NULL").join(named, "refers_to", "left").join(alike, "digest", "left")
    sizes = [F.coalesce("own_bytes", "named_bytes", "alike_bytes").alias("payload_bytes"), F.coalesce("own_digest", "named_digest", "digest").alias("payload_digest")]
    own = [F.col("own_bytes").alias("payload_bytes"), F.coalesce("own_digest", "digest").alias("payload_digest")]

    def row(numbers: list[Column]) -> list[Column]:
        return [page_id_of(F.col("record_id")).alias("page_id"), *numbers, F.col("record_type"), page_id_of(F.col("refers_to")).alias("refers_to"), F.col("complete")]

    return revisits.select(*row(sizes)).union(records.where("refers_to IS NULL").select(*row(own)))


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages
), k AS (SELECT d, max(page_id) AS last FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last IS NULL OR last = page_id THEN NULL ELSE last END AS refers_to, TRUE AS complete
FROM p LEFT JOIN k ON p.d = k.d AND p.n >= {REVISIT_BYTES}
"""
