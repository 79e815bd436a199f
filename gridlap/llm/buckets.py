"""Exact comparison inside candidate buckets, each pair counted in one bucket only.

A member may lie in many buckets. Buckets with the same members are one. Every row that is sent to a bucket carries the list of all its
member's buckets, so two members that meet in several are counted in the first of them alone, and no list of pairs is ever built. A
bucket larger than ``BLOCK`` is dealt out as pairs of blocks, so a task never holds more than two blocks of a bucket; nothing is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import map_arrow, shuffle_width

BLOCK = 256
FOUND = "id long, n_links long, root long"


def member_lists(leaves: DataFrame) -> DataFrame:
    """(id, buckets: array of (bucket, n)) from distinct rows (id, bucket): buckets of one member go, of buckets with the same members the
    first stays."""
    sizes = leaves.groupBy("bucket").agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(id))").alias("h1"), F.sum(F.xxhash64("id", F.lit(7)).cast("decimal(38,0)")).alias("h2")
    ).where("n > 1")
    kept = sizes.groupBy("n", "h1", "h2").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    return leaves.join(kept, "bucket").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("buckets"))


def _spread(ids: np.ndarray, blocks: int) -> np.ndarray:
    """Block of each id."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % blocks


def deal(ids: list[int], copies: list[int], buckets: list[list[dict]], payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, i, j, id, copies, own, paths, payload): one for each pair of blocks that the member's block is part of."""
    out: dict[str, list] = {k: [] for k in ("bucket", "i", "j", "id", "copies", "block", "paths", "payload")}
    size = 0
    for doc, n_copies, own, payload in zip(ids, copies, buckets, payloads):
        paths = np.array([b["bucket"] for b in own], dtype=np.int64).tobytes()
        for b in own:
            blocks = -(-b["n"] // BLOCK)
            mine = int(_spread(np.array([doc]), blocks)[0])
            for other in range(blocks):
                row = (b["bucket"], min(mine, other), max(mine, other), doc, n_copies, mine, paths, payload)
                for values, value in zip(out.values(), row):
                    values.append(value)
                size += len(payload) + len(paths) + 64
        if size > 4 << 20:
            yield pa.RecordBatch.from_pydict(out, DEALT)
            out, size = {k: [] for k in out}, 0
    yield pa.RecordBatch.from_pydict(out, DEALT)


DEALT = pa.schema([
    ("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("id", pa.int64()), ("copies", pa.int64()), ("block", pa.int32()),
    ("paths", pa.binary()), ("payload", pa.binary()),
])
DEALT_SCHEMA = "bucket long, i int, j int, id long, copies long, block int, paths binary, payload binary"


def first_shared(paths: list[np.ndarray], bucket: int) -> np.ndarray:
    """Matrix of members: whether ``bucket`` is the first bucket two of them share."""
    earlier = [p[p < bucket] for p in paths]
    values, at = np.unique(np.concatenate(earlier), return_inverse=True)
    if not len(values):
        return np.ones((len(paths), len(paths)), dtype=bool)
    marks = np.zeros((len(paths), len(values)), dtype=np.float32)
    marks[np.repeat(np.arange(len(paths)), [len(e) for e in earlier]), at] = 1
    return (marks @ marks.T) == 0


def compare_group(bucket: int, i: int, j: int, rows: dict[str, np.ndarray | list], similar: Callable[[list[bytes]], np.ndarray]) -> list[tuple[int, int, int]]:
    """(id, links weighted by copies, smallest id reached inside the group) of the members that have links here."""
    ids, order = np.unique(rows["id"], return_index=True)
    if len(ids) < 2:
        return []
    block, copies = rows["block"][order], rows["copies"][order]
    linked = similar([rows["payload"][k] for k in order])
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= block[:, None] != block[None, :]
    if not linked.any():
        return []
    linked &= first_shared([np.frombuffer(rows["paths"][k], dtype=np.int64) for k in order], bucket)
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], len(ids)).min(axis=1))
        if (low == root).all():
            break
        root = low
    degree = linked @ copies
    return [(int(ids[k]), int(degree[k]), int(ids[root[k]])) for k in np.flatnonzero(linked.any(axis=1))]


def compare(dealt: DataFrame, similar: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """(id, n_links, root): parts of each member's number of links, and links that span what is connected.

    ``similar`` gives the symmetric matrix of which payloads are similar. Groups are read from sorted partitions one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(c).to_numpy() for c in ("bucket", "i", "j")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if waiting and any(waiting[-1].column(c)[-1].as_py() != k[0] for c, k in zip(("bucket", "i", "j"), key)):
                yield finish(waiting)
                waiting = []
            if not len(change):
                waiting.append(batch)
                continue
            yield finish([*waiting, batch.slice(0, change[-1])])
            waiting = [batch.slice(change[-1])]
        if waiting:
            yield finish(waiting)

    def finish(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        columns = {c: table.column(c).to_numpy() for c in ("bucket", "i", "j", "id", "copies", "block")}
        blobs = {c: table.column(c).to_pylist() for c in ("paths", "payload")}
        change = np.flatnonzero(np.any([columns[c][1:] != columns[c][:-1] for c in ("bucket", "i", "j")], axis=0)) + 1
        found: list[tuple[int, int, int]] = []
        for lo, hi in zip([0, *change], [*change, table.num_rows]):
            if hi - lo > 1:
                rows = {c: v[lo:hi] for c, v in columns.items()} | {c: v[lo:hi] for c, v in blobs.items()}
                found += compare_group(int(columns["bucket"][lo]), int(columns["i"][lo]), int(columns["j"][lo]), rows, similar)
        ids, degrees, roots = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, degrees, roots)], names=["id", "n_links", "root"])

    width = shuffle_width(dealt.sparkSession)
    ordered = dealt.repartition(width, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return map_arrow(ordered, run, FOUND)
