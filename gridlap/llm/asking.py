"""Totals of keys over the whole corpus for blocks of documents that ask for them, without gathering the keys in one place.

A block is a bounded run of documents, made once and stored. It sends the distinct keys of its documents, sorted and cut into parts by
key, one packed row for each part. The task that owns a part adds up the rows of all blocks and sends each block an answer in the order of
the keys it sent. Keys meet pre-aggregated, so a key that fills the corpus costs its part one entry a block. What is sent grows with the
distinct keys of the blocks, that is with the corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import map_arrow, new_folder, shuffle_width

KEY_BITS = 48
REQUEST = "block long, part int, keys binary, amounts binary"
ANSWER = "block long, part int, payload binary, tally array<long>"
Answer = tuple[bytes, list[int]]


def new_block() -> int:
    """A number no other block has; a block that is made again after a failure gets another, and only committed rows are read."""
    return uuid.uuid4().int >> 65


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed planes of bytes, the high ones of which are mostly zero."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob), dtype=np.uint64)


def part_bounds(keys: np.ndarray, parts: int, together: int = 0, bits: int = KEY_BITS) -> np.ndarray:
    """Where the keys (ascending, of ``bits`` bits) of each part of equal key range begin; one more entry than parts. Keys that differ in
    their last ``together`` bits alone are in one part."""
    edges = [-(-(p << bits - together) // parts) << together for p in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, dtype=np.uint64)), [len(keys)]]).astype(np.int64)


def request_rows(block: int, keys: np.ndarray, amounts: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
    """One row for each part that has keys; ``amounts`` are columns beside the keys."""
    filled = [p for p in range(len(bounds) - 1) if bounds[p] < bounds[p + 1]]
    cuts = [slice(bounds[p], bounds[p + 1]) for p in filled]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(filled), pa.int64()), pa.array(filled, pa.int32()), pa.array([packed_keys(keys[c]) for c in cuts], pa.binary()),
            pa.array([packed(np.concatenate([a[c] for a in amounts])) for c in cuts], pa.binary()),
        ],
        names=["block", "part", "keys", "amounts"],
    )


def stored_blocks(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks as a table bucketed by their number in the shared folder, so that answers come to them and they are never shuffled."""
    spark = blocks.sparkSession
    table = f"gridlap_{name}_{uuid.uuid4().hex}"
    blocks.write.option("path", new_folder(spark, name)).bucketBy(shuffle_width(spark), "block").sortBy("block").saveAsTable(table)
    return spark.table(table)


def parts_for(df: DataFrame) -> int:
    """Parts to cut keys into: two for each task that will own some."""
    return 2 * shuffle_width(df.sparkSession)


def answers(requests: DataFrame, answer: Callable[[list[np.ndarray], list[np.ndarray]], list[Answer]]) -> DataFrame:
    """The answers to all requests. ``answer`` gets the keys and the amounts (columns as rows of a matrix) of all requests to one part and
    gives the payload and tally of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, bytes, bytes]] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "keys", "amounts"))):
                if waiting and waiting[0][1] != row[1]:
                    yield finish(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield finish(waiting)

    def finish(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
        keys = [unpacked_keys(r[2]) for r in rows]
        found = answer(keys, [unpacked(r[3]).reshape(-1, len(k)) for r, k in zip(rows, keys)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([f[0] for f in found], pa.binary()),
                pa.array([f[1] for f in found], pa.list_(pa.int64())),
            ],
            names=["block", "part", "payload", "tally"],
        )

    by_part = requests.repartition(shuffle_width(requests.sparkSession), "part").sortWithinPartitions("part")
    return map_arrow(by_part, run, ANSWER)


def with_answers(blocks: DataFrame, **answered: DataFrame) -> DataFrame:
    """Blocks with one more column for each kind of answers: its payloads in the order of the parts."""
    out = blocks
    for name, found in answered.items():
        own = found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "payload"))).alias("own"))
        out = out.join(own.select("block", F.col("own.payload").alias(name)), "block", "left")
    return out


def joined(payloads: list[bytes] | None) -> np.ndarray:
    """The numbers of all answers to a block, in the order of its keys."""
    return np.concatenate([unpacked(p) for p in payloads]) if payloads else np.zeros(0, dtype=np.uint64)
