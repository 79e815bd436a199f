"""Near duplicates of embeddings by lattice hashing.

Unit vectors are projected on random 8-dimensional subspaces, one per table, and decoded to points of the E8 lattice. A vector is filed under
its own lattice cell and the neighbouring cells closest to it, so two vectors meet in a table if any of these agree. Whoever meets is
compared by cosine in double precision. The tables, probes and scale below find 0.998 of random pairs at a cosine of exactly 0.9.

Equal vectors are one vector with a number of copies, so copies are counted and never paired.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do vectors of another length with
each other; rows that repeat a vec_id with equal vectors are one vector; a null vec_id stays alone, with component null; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm import buckets, lattice
from gridlap.llm.common import map_arrow, stage
from gridlap.llm.components import components

THRESHOLD = 0.9
TABLES, PROBES, SCALE, SEED = 8, 2, 0.8, 7


def tables_for(size: int, threshold: float, tables: int = TABLES, scale: float = SCALE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per table a projection, scaled so that two vectors at the threshold lie about ``scale`` apart, and an offset."""
    rng = np.random.default_rng(SEED + size)
    apart = np.sqrt(max(2 - 2 * threshold, 1e-9)) * np.sqrt(min(1.0, 8 / size))
    found = []
    for _ in range(tables):
        basis = np.zeros((size, 8))
        basis[:, : min(8, size)] = np.linalg.qr(rng.standard_normal((size, min(8, size))))[0]
        found.append((basis * (scale / apart), rng.random(8)))
    return found


def cell_keys(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """(rows, keys): the cells under which unit vectors are filed."""
    tables = tables_for(vectors.shape[1], threshold)
    found = [lattice.keys(lattice.cells(vectors @ basis + offset, PROBES), vectors.shape[1] * 1024 + k) for k, (basis, offset) in enumerate(tables)]
    return np.concatenate(found, axis=1)


def file_vectors(vectors: DataFrame, threshold: float) -> DataFrame:
    """Distinct (id, bucket) of rows (id, embedding: array of double)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                ids, lists = part.column("id").to_numpy(), part.column("embedding")
                sizes = np.array([len(v) for v in lists])
                flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
                for size in np.unique(sizes):
                    own = np.flatnonzero(sizes == size)
                    block = np.stack([flat[ends[k] - size : ends[k]] for k in own])
                    keys = cell_keys(block / np.linalg.norm(block, axis=1)[:, None], threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[own], keys.shape[1])), pa.array(keys.ravel().view(np.int64))], names=["id", "bucket"])

    return map_arrow(vectors.select("id", "embedding"), run, "id long, bucket long").distinct()


def similar_vectors(threshold: float):
    def similar(payloads: list[bytes]) -> np.ndarray:
        size = max(map(len, payloads))
        block = np.stack([np.frombuffer(p if len(p) == size else bytes(size), dtype=np.float64) for p in payloads])
        short = np.array([len(p) != size for p in payloads])
        block = block / np.where(short, 1.0, np.linalg.norm(block, axis=1))[:, None]
        return (block @ block.T >= threshold) & ~short[:, None] & ~short[None, :]

    return similar


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    # Halving by the largest component keeps sums of squares finite for any finite vector.
    largest = F.array_max(F.transform("embedding", lambda v: F.abs(v)))
    fit = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & (largest > 0)
    unit = F.when(F.col("vec_id").isNotNull() & fit, F.transform("embedding", lambda v: v / largest))
    rows = rows.withColumn("digest", F.when(unit.isNotNull(), F.sha2(F.array_join(F.transform("embedding", lambda v: (v + 0.0).cast("string")), ","), 256)))
    usable = rows.where("digest IS NOT NULL").withColumn("embedding", unit)
    groups = stage(usable.groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.count_distinct("vec_id").alias("copies"), F.any_value("embedding").alias("embedding")).withColumn("id", F.xxhash64("digest")), "vectors")
    lists = buckets.member_lists(stage(file_vectors(groups, threshold), "cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                columns = [batch.column(c).slice(lo, 1024).to_pylist() for c in ("id", "copies", "buckets", "embedding")]
                yield from buckets.deal(*columns[:3], [np.array(v, dtype=np.float64).tobytes() for v in columns[3]])

    dealt = map_arrow(groups.join(lists, "id").select("id", "copies", "buckets", "embedding"), run, buckets.DEALT_SCHEMA)
    found = stage(buckets.compare(dealt, similar_vectors(threshold)), "links")
    degree = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    reached = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    placed = groups.drop("embedding").join(degree, "id", "left").join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    answers = placed.join(named, "component").select("digest", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id", "digest").join(answers, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )


def op6_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

