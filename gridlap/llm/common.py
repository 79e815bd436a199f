"""Helpers the operators share: staged frames, batches of texts, hashed words and shingles."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridlap.session import staging_dir

BATCH_BYTES = 2 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder in the shared staging folder."""
    return f"{staging_dir(spark).rstrip('/')}/gridlap-llm/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, unless the environment they inherit already names its folder."""
    root = Path(__file__).resolve().parents[2]
    named = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if str(root) in named or any(f.endswith("/gridlap.zip") for f in context.listFiles):
        return
    archive = Path(tempfile.mkdtemp(prefix="gridlap-code-"), "gridlap.zip")  # Spark's file server hands it out from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted((root / "gridlap").rglob("*.py")):
            z.write(source, source.relative_to(root))
    context.addPyFile(str(archive))


def map_arrow(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(task, schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later jobs start from files that outlive any executor."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now, not when the driver next happens to collect its garbage.

    The scheduler holds on to the last job until another one comes, so a job of one row goes first.
    """
    spark.range(1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that no later step reads."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_bytes(texts: list, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of texts or bytes into runs [lo, hi) of about ``limit`` characters; a longer text is a run of its own."""
    lo = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text is not None else 0
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = True
_powers: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, factor in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and where each text's words start (one more entry than texts).

    A word is a longest run of ASCII letters, digits, underscores or non-ASCII characters of the lower-cased text; a null text
    has none.
    """
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    begins = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=begins[1:])
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = _WORD_BYTE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    up, down = power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts])
    return words, np.searchsorted(starts, begins)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one text; a shorter text that has words is one shingle."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        h = h * np.uint64(_MULTIPLIER) + words[k : k + n]
    return mix(h)
