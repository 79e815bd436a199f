"""Runs of words with a period, found through a dictionary of basic factors.

For each power of two L every stretch of L words that occurs twice in its text has a name; the name of length 2L is the pair of the names of its
halves, and a stretch that occurs once has no name and is left out of all longer ones. Where stretches of L words recur with the same
distance d, at most 2L, at one place after the other, the places form an arithmetic progression that proposes a run of period d. Proposals are extended to
both sides and made distinct. A run of smallest period q that is at least three periods long is proposed at the L with q <= L < 2q: within
it a stretch of L words recurs first after q words, because a shorter distance would divide the period.

Texts of a batch are searched together, and names differ between texts. A word of a text is a longest run of bytes other than the
six white-space characters of ASCII.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; a row with a null doc_id is searched as it is; repeated rows
get equal answers; an empty table gives an empty result; extra columns are ignored; texts of any length are searched whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridlap.llm.common import by_bytes, map_arrow, mix

LEAST, TIMES = 24, 3
SCHEMA = "doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"
OP_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"
)


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and period of all runs, ordered by first word and period.

    ``words`` are the numbers of the words of all texts, ``bounds`` where each text begins and, last, the number of words. A run is at least
    ``least`` words and ``times`` periods (three or more) long.
    """
    n = len(words)
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    names = mix(words.astype(np.uint64) ^ mix(text_of.astype(np.uint64) + np.uint64(1)))
    at, span = np.arange(n), 1
    proposed: list[np.ndarray] = []
    while len(at):
        order = np.argsort(names, kind="stable")
        at, names = at[order], names[order]
        same = names[1:] == names[:-1]
        distance = at[1:] - at[:-1]
        near = same & (distance <= 2 * span)
        proposed.append(_progressions(at[:-1][near], distance[near], span, least, times))
        recurs = np.append(same, False) | np.append(False, same)
        number = np.cumsum(np.append(True, ~same))
        named = np.zeros(n + span, dtype=np.int64)
        named[at[recurs]] = number[recurs]
        at = np.flatnonzero((named[:n] > 0) & (named[span:] > 0))
        names = named[at] * (len(number) + 1) + named[at + span]
        span *= 2
    starts, lengths, periods = _extended(words, bounds, text_of, np.concatenate(proposed) if proposed else np.zeros((0, 3), dtype=np.int64))
    enough = (lengths >= least) & (lengths >= times * periods)
    found = np.unique(np.stack([starts, periods, lengths], axis=1)[enough], axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _progressions(at: np.ndarray, distance: np.ndarray, span: int, least: int, times: int) -> np.ndarray:
    """Rows (start, end, period) of neighbouring places with one distance that reach far enough for a run."""
    order = np.argsort(at)
    at, distance = at[order], distance[order]
    first = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(distance) != 0))) if len(at) else np.zeros(0, dtype=np.int64)
    places = np.diff(np.append(first, len(at)))
    start, period = at[first], distance[first]
    length = places + span - 1 + period
    far = (length >= least) & (length >= times * period)
    return np.stack([start, start + length, period], axis=1)[far]


def _extended(words: np.ndarray, bounds: np.ndarray, text_of: np.ndarray, proposed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of the proposals, carried on while the next word keeps the period."""
    start, end, period = proposed.T.copy()
    low, high = bounds[text_of[start]], bounds[text_of[start] + 1]
    moving = np.arange(len(start))
    while len(moving):
        moving = moving[start[moving] > low[moving]]
        moving = moving[words[start[moving] - 1] == words[start[moving] - 1 + period[moving]]]
        start[moving] -= 1
    moving = np.arange(len(start))
    while len(moving):
        moving = moving[end[moving] < high[moving]]
        moving = moving[words[end[moving]] == words[end[moving] - period[moving]]]
        end[moving] += 1
    return start, end - start, period


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a text after the fixed change that some documents get; a null doc_id changes nothing."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole = words[a : a + p]
    return words[:a] + (whole * (-(-(n - a) // p)))[: n - a]


def word_runs(texts: list[list[bytes]]) -> Iterator[tuple[list[int], list[int], list[int], list[bytes]]]:
    """Starts, lengths and periods of the runs of each text given as words, and the words that are kept: of a run, its first period and what no run drops."""
    seen: dict[bytes, int] = {}
    bounds = np.cumsum([0, *map(len, texts)])
    numbers = np.fromiter((seen.setdefault(w, len(seen)) for t in texts for w in t), np.int64, int(bounds[-1]))
    starts, lengths, periods = find_runs(numbers, bounds)
    first = np.searchsorted(starts, bounds)
    for k, words in enumerate(texts):
        own = slice(first[k], first[k + 1])
        if first[k] == first[k + 1]:
            yield [], [], [], words
            continue
        start, length, period = starts[own] - bounds[k], lengths[own], periods[own]
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(depth, start + period, 1)
        np.add.at(depth, start + length, -1)
        kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
        yield start.tolist(), length.tolist(), period.tolist(), [words[i] for i in kept]


def _batches(batches: Iterator[pa.RecordBatch], change) -> Iterator[tuple[list, list, list]]:
    """(doc_ids, texts as words, runs of each) of bounded numbers of texts."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        raw = batch.column("text").cast(pa.binary()).to_pylist()
        for lo, hi in by_bytes(raw, 4 << 20):
            words = [change((t or b"").split(), i) for t, i in zip(raw[lo:hi], ids[lo:hi])]
            yield ids[lo:hi], words, list(word_runs(words))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the runs of each text and the text with each run collapsed to its first period, words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, found in _batches(batches, lambda w, _: w):
            starts, lengths, periods, kept = zip(*found)
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (starts, lengths, periods)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), *lists, pa.array([b" ".join(k).decode("utf-8", "replace") for k in kept], pa.string())],
                names=["doc_id", "n_words", "starts", "lengths", "periods", "collapsed"],
            )

    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)


def strongest(starts: list[int], lengths: list[int], periods: list[int]) -> tuple[int, int, int]:
    """The run that repeats most often; of equal ones that with the smallest start, then period."""
    return min(zip(starts, lengths, periods), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents after the fixed change, as counts and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, found in _batches(batches, repeated):
            rows = []
            for i, own, (starts, lengths, periods, kept) in zip(ids, words, found):
                best = strongest(starts, lengths, periods) if starts else (None, None, None)
                told = "".join(f"{s},{n},{p}\n" for s, n, p in zip(starts, lengths, periods))
                rows.append((
                    i, len(starts), *best, 1000 * best[1] // best[2] if starts else None, hashlib.sha256(told.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(kept)).hexdigest(), len(own), len(own) - len(kept),
                ))
            columns = [pa.array(c, pa.string() if k in (6, 7) else pa.int64()) for k, c in enumerate(zip(*rows))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OP_SCHEMA.split(", ")])

    return map_arrow(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), run, OP_SCHEMA)
