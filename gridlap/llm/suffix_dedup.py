"""Removal of repeated passages by longest-previous-factor arrays over distributed suffix order.

A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller doc_id. Strings are dealt to tasks by their
minimizer: of the hashes of their ``GRAM``-byte pieces the least. Equal strings have equal minimizers, so all occurrences of a string meet, and
neighbouring strings with one minimizer travel together as one stretch of text.

1. Every stretch sends its minimizer and place; minimizers met in one document only are dropped.
2. The stretches of the others send their bytes. Equal stretches are one; all but those of the first document go whole.
3. The strings of the different stretches of a minimizer are put in suffix order. For each the previous and next smaller document in that order
   give its longest previous factor; where it reaches ``length``, an earlier document has the string.
4. The places are joined with the texts, and runs of removed bytes are cut out.

Edge cases: a null text is the empty one; texts shorter than ``length`` bytes stay whole; equal doc_ids are never smaller than each other, and a row
that repeats a doc_id is judged by its own text (rows that repeat it with other texts carry a hash of their text along); a row with a null doc_id stays whole and removes nothing; an empty
table gives an empty result; extra columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm.common import BATCH_BYTES, by_bytes, map_arrow, mix, new_folder, power_tables, release_shuffles, remove_folder, shuffle_width, stage

LENGTH, GRAM, RUN = 50, 20, 64
GROUP_ROWS = 200_000


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position (GRAM - 1 fewer than bytes)."""
    words = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,)).copy()
    n = len(data) - GRAM + 1
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h += words[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    h += words[12 : 12 + n] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _window_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values."""
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = width - span
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def stretches(raw: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: (all bytes, where each text begins, and per stretch its first byte, its number of strings and its minimizer)."""
    begins = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=begins[1:])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return data, begins, none, none, none.astype(np.uint64)
    least = _window_least(_gram_hashes(data), length - GRAM + 1)
    inside = np.zeros(len(least) + 2, dtype=np.int32)  # +1 where the strings of a text begin, -1 behind the last of them
    long_enough = np.diff(begins) >= length
    np.add.at(inside, begins[:-1][long_enough], 1)
    np.add.at(inside, begins[1:][long_enough] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    fresh = inside[:-1].copy()
    fresh[1:] &= (least[1:] != least[:-1]) | ~inside[:-2]
    fresh[begins[:-1][long_enough]] = True
    firsts = np.flatnonzero(fresh)
    # A stretch ends where the next begins or where its text has no more strings.
    after = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    ends = np.minimum(np.append(firsts[1:], len(least)), after[np.searchsorted(after, firsts, side="right")])
    pieces = (ends - firsts + RUN - 1) // RUN
    starts = np.repeat(firsts, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    counts = np.minimum(RUN, np.repeat(ends, pieces) - starts)
    return data, begins, starts, counts, least[starts]


def _bytes_of(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _ordinals(begins: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text of each stretch and its number within the text."""
    owner = np.searchsorted(begins, starts, side="right") - 1
    first = np.searchsorted(starts, begins[:-1])
    return owner, np.arange(len(starts)) - first[owner]


def shared_stretches(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, ordinal) of the stretches whose minimizer occurs in several documents."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text").to_pylist()
            for lo, hi in by_bytes(texts, BATCH_BYTES // 4):
                _, begins, starts, _, least = stretches(_bytes_of(texts[lo:hi]), length)
                owner, ordinal = _ordinals(begins, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least.view(np.int64)), pa.array(ids[lo:hi][owner]), pa.array(ordinal.astype(np.int32))], names=["h", "doc_id", "ordinal"]
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by minimizer and document; what is held over is the first document of the minimizer that is still open."""
        held: pa.RecordBatch | None = None
        open_shared = False
        for batch in batches:
            if not batch.num_rows:
                continue
            carried = held.num_rows if held is not None else 0
            if carried:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            h, doc = batch.column("h").to_numpy(), batch.column("doc_id").to_numpy()
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            size = np.diff(np.append(first, len(h)))
            shared = doc[first] != doc[first + size - 1]
            if carried:
                shared[0] |= open_shared
            last = first[-1]
            keep = np.repeat(shared, size)
            if shared[-1]:
                # The open minimizer is known to be shared: its rows can go, and one stays as a reminder.
                out, held, open_shared = np.flatnonzero(keep), batch.slice(len(h) - 1), True
                if len(out) and out[-1] == len(h) - 1:
                    out = out[:-1]
            else:
                out, held, open_shared = np.flatnonzero(keep[:last]), batch.slice(last), False
            yield batch.select(["doc_id", "ordinal"]).take(pa.array(out))
        if held is not None and open_shared:
            yield held.select(["doc_id", "ordinal"])

    sent = map_arrow(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), send, "h long, doc_id long, ordinal int")
    ordered = sent.repartition(shuffle_width(docs.sparkSession), "h").sortWithinPartitions("h", "doc_id")
    return map_arrow(ordered, meet, "doc_id long, ordinal int")


def _stretch_rows(ids: np.ndarray, versions: np.ndarray, texts: list[str | None], wanted: list[np.ndarray], length: int) -> pa.RecordBatch:
    data, begins, starts, counts, least = stretches(_bytes_of(texts), length)
    owner, ordinal = _ordinals(begins, starts)
    first = np.searchsorted(starts, begins[:-1])
    chosen = np.zeros(len(starts), dtype=bool)
    for k, numbers in enumerate(wanted):
        numbers = np.unique(numbers)
        size = int(np.searchsorted(starts, begins[k + 1])) - first[k]
        chosen[first[k] + numbers[numbers < size]] = True
    at = np.flatnonzero(chosen)
    starts, sizes, owner = starts[at], counts[at] + length - 1, owner[at]
    ends = np.cumsum(sizes)
    gather = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    content = pa.BinaryArray.from_buffers(
        pa.binary(), len(at), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[gather]))]
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(least[at].view(np.int64)), pa.array(ids[owner]), pa.array(versions[owner]), pa.array((starts - begins[owner]).astype(np.int32)), content],
        names=["h", "doc_id", "version", "start", "content"],
    )


STRETCH_SCHEMA = "h long, doc_id long, version long, start int, content binary"


def stretch_texts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, doc_id, version, start, content) of the wanted stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, texts = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy(), batch.column("text").to_pylist()
            numbers = batch.column("ordinals")
            for lo, hi in by_bytes(texts, BATCH_BYTES // 4):
                yield _stretch_rows(ids[lo:hi], versions[lo:hi], texts[lo:hi], [numbers[k].values.to_numpy() for k in range(lo, hi)], length)

    # A set holds no more than the stretches of the longest text, however many rows repeat the doc_id.
    lists = wanted.groupBy("doc_id").agg(F.collect_set("ordinal").alias("ordinals"))
    return map_arrow(docs.join(lists, "doc_id").select("doc_id", "version", "text", "ordinals"), run, STRETCH_SCHEMA)


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Position of the nearest earlier value that is smaller, or -1.

    Everything between a position and its pointer is at least as large as its value, so a pointer that has not come to rest may
    jump where the value it points at has got to.
    """
    at = np.arange(len(values)) - 1
    moving = np.flatnonzero(at >= 0)
    moving = moving[values[at[moving]] >= values[moving]]
    while len(moving):
        at[moving] = at[at[moving]]
        moving = moving[at[moving] >= 0]
        moving = moving[values[at[moving]] >= values[moving]]
    return at


def previous_factors(rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix, cut to the width of ``rows``: the longest prefix shared with one of a smaller document.

    In suffix order the best partner with a smaller document is the nearest one before or after.
    """
    width = rows.shape[1]
    padded = np.zeros((len(rows), -(-width // 8) * 8), dtype=np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort([docs, *words.T[::-1]])
    in_order, owners = rows[order], docs[order]
    factor = np.zeros(len(rows), dtype=np.int32)
    before = nearest_smaller(owners)
    after = len(rows) - 1 - nearest_smaller(owners[::-1])[::-1]
    for partner in (before, after):
        has = np.flatnonzero((partner >= 0) & (partner < len(rows)))
        differ = in_order[has] != in_order[partner[has]]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        factor[has] = np.maximum(factor[has], common)
    out = np.empty_like(factor)
    out[order] = factor
    return out


def _content_digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit digest of each content; together with the minimizer it stands for the content."""
    begin, data = offsets[:-1] - offsets[0], data[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    out = np.empty(len(size), dtype=np.uint64)
    step = 1 << 14  # contents at a time, so that the tables of powers stay small
    for lo in range(0, len(size), step):
        own, length = begin[lo : lo + step], size[lo : lo + step]
        part = data[own[0] : own[-1] + length[-1]]
        up, down = power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        at = own - own[0]
        out[lo : lo + step] = mix((sums[at + length] - sums[at]) * down[at] + length.astype(np.uint64))
    return out


def _resolve(table: pa.Table, length: int) -> pa.RecordBatch:
    """Removed places (doc_id, version, first, last) from whole minimizer groups."""
    h, doc, version, start = (table.column(k).to_numpy() for k in ("h", "doc_id", "version", "start"))
    content = table.column("content").combine_chunks()
    if isinstance(content, pa.ChunkedArray):
        content = pa.concat_arrays(content.chunks)
    offsets = np.frombuffer(content.buffers()[1], dtype=np.int32)[content.offset : content.offset + len(content) + 1].astype(np.int64)
    data = np.frombuffer(content.buffers()[2], dtype=np.uint8)
    c = _content_digests(data, offsets)
    order = np.lexsort([doc, c, h])
    h, c, doc, version, start, begin_of, size = h[order], c[order], doc[order], version[order], start[order], offsets[:-1][order], np.diff(offsets)[order]
    new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    earliest = doc[first][group]
    later = doc > earliest
    spans = [(doc[later], version[later], start[later].astype(np.int64), start[later] + size[later])]
    # Minimizers with several different stretches need the suffix order.
    h_of = h[first]
    alone = np.append(True, h_of[1:] != h_of[:-1]) & np.append(h_of[1:] != h_of[:-1], True)
    contested = np.flatnonzero(~alone)
    if len(contested):
        counts = size[first[contested]] - length + 1
        ends = np.cumsum(counts)
        within = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
        places = np.repeat(begin_of[first[contested]], counts) + within
        rows = np.lib.stride_tricks.sliding_window_view(data, length)[places]
        hit = previous_factors(rows, np.repeat(doc[first[contested]], counts)) >= length
        bounds = np.concatenate([[0], ends])
        hits_of = dict(zip(contested.tolist(), zip(bounds[:-1].tolist(), bounds[1:].tolist())))
        own = np.flatnonzero(~later & ~alone[group])
        for k in own[[hit[slice(*hits_of[g])].any() for g in group[own].tolist()]] if len(own) else ():
            at = np.flatnonzero(hit[slice(*hits_of[int(group[k])])])
            runs = np.split(at, np.flatnonzero(np.diff(at) > length) + 1)
            begin = np.array([r[0] for r in runs], dtype=np.int64) + start[k]
            spans.append((np.full(len(runs), doc[k]), np.full(len(runs), version[k]), begin, np.array([r[-1] for r in runs], dtype=np.int64) + start[k] + length))
    ids, versions, begins, stops = (np.concatenate([s[k] for s in spans]) for k in range(4))
    columns = [pa.array(ids), pa.array(versions), pa.array(begins.astype(np.int32)), pa.array(stops.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "first", "last"])


def repeated_places(sent: DataFrame, length: int) -> DataFrame:
    """(doc_id, version, first, last): half-open byte ranges to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows < GROUP_ROWS // 10:
                continue
            table = pa.Table.from_batches(waiting)
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last minimizer may go on
            if cut:
                yield _resolve(table.slice(0, cut).combine_chunks(), length)
                waiting, rows = table.slice(cut).combine_chunks().to_batches(), len(h) - cut
        table = pa.Table.from_batches(waiting) if waiting else None
        if table is not None and table.num_rows:
            yield _resolve(table.combine_chunks(), length)

    ordered = sent.repartition(shuffle_width(sent.sparkSession), "h").sortWithinPartitions("h")
    return map_arrow(ordered, run, "doc_id long, version long, first int, last int")


def merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Union of ranges as maximal runs."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > reach[:-1])
    return list(zip(first[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)].tolist()))


def whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs made smaller to whole characters, for results that must stay text."""
    out = []
    for first, last in runs:
        while first < last and raw[first] & 0xC0 == 0x80:
            first += 1
        while last > first and last < len(raw) and raw[last] & 0xC0 == 0x80:
            last -= 1
        if first < last:
            out.append((first, last))
    return out


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *[e for run in runs for e in run], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[0::2], edges[1::2]))


def with_versions(docs: DataFrame) -> DataFrame:
    """``docs`` and ``version``: a hash of the text for rows whose doc_id occurs with several texts, else 0."""
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    hashes = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(text_hash).alias("least"), F.max(text_hash).alias("most"))
    several = stage(hashes.where("least != most").select("doc_id", F.lit(True).alias("several")), "several")
    return docs.join(several, "doc_id", "left").withColumn("version", F.when(F.col("several"), text_hash).otherwise(F.lit(0).cast("long"))).drop("several")


def removed_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, version, firsts, lasts): the places to remove of every document (with its version) that has some."""
    if length < GRAM + 1:
        raise ValueError(f"length must be over {GRAM}")
    docs, spark = docs.select("doc_id", "version", "text"), docs.sparkSession
    release_shuffles(spark)
    path = new_folder(spark, "shared")
    shared_stretches(docs, length).write.parquet(path)
    wanted = spark.read.schema("doc_id long, ordinal int").parquet(path)
    release_shuffles(spark)
    places = stage(repeated_places(stretch_texts(docs, wanted, length), length), "places")
    remove_folder(spark, path)
    release_shuffles(spark)
    grouped = places.groupBy("doc_id", "version").agg(F.collect_set(F.struct("first", "last")).alias("p"))
    return grouped.select("doc_id", "version", F.col("p.first").alias("firsts"), F.col("p.last").alias("lasts"))


def _each_document(docs: DataFrame, length: int, make, schema: str, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of doc_id, what ``make`` gives for the text's bytes and its removed runs, and the columns ``carry`` of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                firsts, lasts = part.column("firsts"), part.column("lasts")
                rows = []
                for k, raw in enumerate(_bytes_of(part.column("text").to_pylist())):
                    runs = merged(firsts[k].values.to_numpy(), lasts[k].values.to_numpy()) if firsts[k].is_valid else []
                    rows.append(make(raw, runs))
                made = [pa.array(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made, *[part.column(c) for c in carry]], names=names)

    schema = ", ".join([schema, *[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]])
    names = [c.split()[0].strip("`") for c in schema.split(", ")]
    docs = with_versions(docs.select("doc_id", "text", *carry))
    joined = docs.join(removed_runs(docs, length), ["doc_id", "version"], "left")
    return map_arrow(joined.select("doc_id", "text", "firsts", "lasts", *carry), run, schema)


def deduplicated(docs: DataFrame, length: int = LENGTH, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, kept (the text without repeated passages, cut at whole characters), n_removed, n_spans and the columns ``carry`` of every row."""

    def make(raw: bytes, runs: list[tuple[int, int]]) -> tuple:
        runs = whole_characters(raw, runs)
        return kept_bytes(raw, runs).decode("utf-8", "replace"), sum(b - a for a, b in runs), len(runs)

    return _each_document(docs, length, make, "doc_id long, kept string, n_removed long, n_spans long", carry)


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of the remaining bytes) of every row."""

    def make(raw: bytes, runs: list[tuple[int, int]]) -> tuple:
        return len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept_bytes(raw, runs)).hexdigest()

    return _each_document(docs, length, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 bytes in all documents."""
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def by_brute_force(texts: dict[int, str | None], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The same result from a dictionary of all strings, for tests on small tables."""
    first_seen: dict[bytes, int] = {}
    out = {}
    for doc in sorted(texts):
        raw = (texts[doc] or "").encode()
        hit = [k for k in range(len(raw) - length + 1) if first_seen.get(raw[k : k + length], doc) < doc]
        for k in range(len(raw) - length + 1):
            first_seen.setdefault(raw[k : k + length], doc)
        runs = merged(np.array(hit), np.array(hit) + length)
        out[doc] = (len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept_bytes(raw, runs)).hexdigest())
    return out


def report(found, folder):
    """Comparison with brute force, for trials by hand on small tables."""
    import pandas as pd

    docs = pd.read_parquet(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    print("removed", found.n_removed.sum(), "of", found.n_bytes.sum(), "spans", found.n_spans.sum())
    if len(docs) <= 3000:
        true = by_brute_force(dict(zip(docs.doc_id, docs.text)))
        rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.itertuples()}
        print("rows that differ", sum(rows[d] != t for d, t in true.items()), "of", len(true), "true removed", sum(t[1] for t in true.values()))
