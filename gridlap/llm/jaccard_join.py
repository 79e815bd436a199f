"""Similarity join on word shingles by chosen paths.

Texts are sets of hashed five-word shingles. In each run every set picks the shared tokens for which a hash of (path, token) falls below
``1 / (overlap * size)``, about one, and where there is none the token of the least hash; sets that pick a token meet below it. A bucket of more
than ``LIMIT`` sets is split again, with hashes that depend on its path, up to ``DEPTH`` levels, and small buckets are compared exactly. As every set
picks something in every bucket, no path dies out for a whole group of near copies. Two sets of any sizes share the token of the least hash with
a probability of their similarity per level, so the number of runs follows from the target recall. Buckets that splitting does not make
small, and those of which most sets are near copies, are compared in pairs of blocks, whole.

Rows with the same set are one set with a number of copies, so copies are counted and never paired.

Edge cases: a text of one to four words is one shingle of them all; null and empty texts and texts without words link with nothing and are
their own class; rows that repeat a doc_id with one text are one document in the links, with different texts one in the links of each, and every
row is returned; a null doc_id stays alone, with class null; an
empty table gives an empty result; extra columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm import buckets
from gridlap.llm.common import by_bytes, hashed_words, map_arrow, mix, release_shuffles, shingles, stage
from gridlap.llm.components import components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99
LIMIT, DEPTH = 512, 3
COLUMNS = 4096
SET_SCHEMA = "doc_id long, n long, f1 long, f2 long, l1 array<long>, l2 array<struct<parent:long,child:long>>, l3 array<struct<parent:long,child:long>>"


def runs_for(recall: float, depth: int = DEPTH, threshold: float = THRESHOLD) -> int:
    """Runs after which two sets at the threshold have met with probability ``recall``, even where all their buckets are split to the end.

    Counts only the token of the least hash in both sets together: it is shared, and then picked by both, with a probability of the
    similarity, whatever the ratio of the sizes. The further picks come on top.
    """
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def token_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, at = hashed_words(texts)
    for lo, hi in zip(at[:-1], at[1:]):
        yield np.unique(shingles(words[lo:hi], WORDS))


def prints(tokens: np.ndarray) -> tuple[int, int]:
    """128-bit fingerprint of a set, as two signed numbers."""
    sums = np.array([mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], dtype=np.uint64)
    return tuple(sums.view(np.int64).tolist())


def _picked(path: int, tokens: np.ndarray, limit: int) -> np.ndarray:
    """Paths below ``path`` for the tokens that its hash picks: those below ``limit``, or else the one of the least hash."""
    seed = np.uint64(path)
    hashes = (tokens ^ seed) * np.uint64(0x9FB21C651E98DF25)
    chosen = tokens[hashes >> np.uint64(24) < np.uint64(limit)]
    if not len(chosen):
        chosen = tokens[[hashes.argmin()]]
    return mix(chosen + (seed << np.uint64(1)) + np.uint64(1))


def chosen_paths(tokens: np.ndarray, runs: int, threshold: float) -> list[list]:
    """The paths of a set on each level: [first], [(parent, child)], [(parent, child)]."""
    overlap = 2 * threshold / (1 + threshold)  # of two sets of one size at the threshold
    limit = min(1 << 40, int((1 << 40) / (overlap * len(tokens))))
    first: list[int] = []
    for run in range(runs):
        first += _picked(int(mix(np.array([run + 1], dtype=np.uint64))[0]), tokens, limit).tolist()
    levels: list[list] = [first]
    above = first
    for _ in range(DEPTH - 1):
        pairs = [(parent, child) for parent in above for child in _picked(parent, tokens, limit).tolist()]
        levels.append(pairs)
        above = [child for _, child in pairs]
    return levels


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _pairs_array(rows: list[list[tuple[int, int]]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    flat = [p for row in rows for p in row]
    parents, children = (_signed([p[k] for p in flat]) for k in (0, 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(parents), pa.array(children)], ["parent", "child"]))


def describe_sets(docs: DataFrame, runs: int, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: size and 128-bit fingerprint of its set, and the paths it picks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for lo, hi in by_bytes(texts):
                sizes, marks, levels = [], [], [[], [], []]
                for tokens in token_sets(texts[lo:hi]):
                    sizes.append(len(tokens))
                    marks.append(prints(tokens))
                    for level, paths in zip(levels, chosen_paths(tokens, runs, threshold) if len(tokens) else [[], [], []]):
                        level.append(paths)
                first = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, levels[0])]), pa.int32()), pa.array(_signed([p for row in levels[0] for p in row])))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(lo, hi - lo), pa.array(sizes, pa.int64()), *(pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1)), first, _pairs_array(levels[1]), _pairs_array(levels[2])],
                    names=["doc_id", "n", "f1", "f2", "l1", "l2", "l3"],
                )

    return map_arrow(docs.select("doc_id", "text"), run, SET_SCHEMA)


def near_copies(sizes: DataFrame, parents: DataFrame) -> DataFrame:
    """The split buckets whose sets are mostly near copies: at least four fifths of what they pick is picked by at least half of them.

    Sets that have only a common passage pick other tokens besides those of the passage.
    """
    picks = sizes.join(parents.select(F.col("bucket").alias("parent"), F.col("n").alias("whole")), "parent")
    common = F.sum(F.when(F.col("n") * 2 >= F.col("whole"), F.col("n")).otherwise(0))
    return picks.groupBy("parent").agg(common.alias("common"), F.sum("n").alias("all")).where("common * 5 >= all * 4").select(F.col("parent").alias("bucket"))


def leaf_buckets(sets: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Distinct (id, bucket): each path goes down until its bucket holds at most ``limit`` sets, or near copies, or the levels end."""
    leaves, above, too_large = [], None, None
    for level in range(1, DEPTH + 1):
        if level == 1:
            rows = sets.select("id", F.lit(0).cast("long").alias("parent"), F.explode("l1").alias("bucket")).distinct()
        else:
            split = above.join(too_large.select("bucket"), "bucket", "left_semi").groupBy("id").agg(F.collect_set("bucket").alias("split"))
            below = F.filter(f"l{level}", lambda e: F.array_contains("split", e["parent"]))  # paths of a set are few
            edges = sets.join(split, "id").select("id", F.explode(below).alias("e"))
            rows = edges.select("id", F.col("e.parent").alias("parent"), F.col("e.child").alias("bucket")).distinct()
        rows = stage(rows, f"paths-{level}")
        sizes = rows.groupBy("bucket").agg(F.min("parent").alias("parent"), F.count("*").alias("n"))
        if level > 1:
            sizes = stage(sizes, f"sizes-{level}")
            alike = stage(near_copies(sizes, too_large), f"alike-{level}")
            leaves.append(above.join(alike, "bucket", "left_semi").select("id", "bucket"))
            sizes = sizes.join(alike.withColumnRenamed("bucket", "parent"), "parent", "left_anti")
        small = sizes.where("n > 1") if level == DEPTH else sizes.where(f"n > 1 AND n <= {limit}")
        leaves.append(rows.join(small.select("bucket"), "bucket", "left_semi").select("id", "bucket"))
        if level < DEPTH:
            above, too_large = rows, stage(sizes.where(f"n > {limit}").select("bucket", "n"), f"large-{level}")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def packed(tokens: np.ndarray) -> bytes:
    """48 bits of each hash: enough to tell the few thousand tokens of one comparison apart."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(payload: bytes) -> np.ndarray:
    tokens = np.zeros((len(payload) // 6, 8), dtype=np.uint8)
    tokens[:, :6] = np.frombuffer(payload, dtype=np.uint8).reshape(-1, 6)
    return tokens.view("<u8").ravel()


def similar_sets(threshold: float):
    """Which of some sets, given as bytes of sorted hashes, have a Jaccard similarity of at least ``threshold``."""

    def similar(payloads: list[bytes]) -> np.ndarray:
        sets = [unpacked(p) for p in payloads]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
        in_common = times[at] > 1  # the others are in no intersection
        at, owner = (np.cumsum(times > 1) - 1)[at[in_common]], owner[in_common]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        shared = np.zeros((len(sets), len(sets)))
        for lo in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
            own = slice(*np.searchsorted(at, [lo, lo + COLUMNS]))
            marks = np.zeros((len(sets), COLUMNS), dtype=np.float32)
            marks[owner[own], at[own] - lo] = 1
            shared += marks @ marks.T
        return shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-6

    return similar


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest doc_id that links reach) and n_links (other documents with at least the threshold) of every row."""
    docs = docs.select("doc_id", "text")
    described = stage(describe_sets(docs, runs_for(recall, threshold=threshold), threshold), "sets")
    known = described.where("doc_id IS NOT NULL AND n > 0")
    groups = known.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("doc_id"), F.count_distinct("doc_id").alias("copies"))
    groups = stage(groups.withColumn("id", F.xxhash64("f1", "f2", "n")), "groups")
    sets = known.join(groups.select("doc_id", "f1", "f2", "n", "id"), ["doc_id", "f1", "f2", "n"]).select("id", "l1", "l2", "l3").dropDuplicates(["id"])
    lists = stage(buckets.member_lists(leaf_buckets(stage(sets, "paths"))), "lists")
    release_shuffles(docs.sparkSession)
    members = lists.join(groups.select("id", "doc_id", "f1", "copies"), "id")
    texts = docs.join(members, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("text").to_pylist()
            for lo, hi in by_bytes(values):
                part = batch.slice(lo, hi - lo)
                columns = [part.column(c).to_pylist() for c in ("id", "copies", "buckets", "f1")]
                # Of rows that repeat a doc_id, those with the text of this set.
                own = [(*row[:3], packed(tokens)) for *row, tokens in zip(*columns, token_sets(values[lo:hi])) if prints(tokens)[0] == row[3]]
                yield from buckets.deal(*([r[k] for r in own] for k in range(4)))

    dealt = map_arrow(texts.select("id", "copies", "buckets", "f1", "text"), run, buckets.DEALT_SCHEMA)
    found = stage(buckets.compare(dealt, similar_sets(threshold)), "links")
    release_shuffles(docs.sparkSession)
    return classes(described.select("doc_id", "f1", "f2", "n"), groups, found)


def classes(members: DataFrame, groups: DataFrame, found: DataFrame) -> DataFrame:
    """Answers for all documents from those for distinct sets; a class is named by its smallest doc_id."""
    degree = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    reached = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    placed = groups.join(degree, "id", "left").join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = placed.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    answers = placed.join(named, "component").select("f1", "f2", "n", "class_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return members.join(answers, ["f1", "f2", "n"], "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and numbers of links of all documents."""
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))

