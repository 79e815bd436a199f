"""Quality by compression: how much better a dictionary of good text compresses a document than one of bad text.

Two zstandard dictionaries are trained on labelled text, one per label. For a document of n bytes with compressed sizes g (good) and b (bad)
the normalised difference is (b - g) / n. A logistic calibration fitted on labelled rows that the dictionaries have not seen turns it,
together with min(g, b) / n, which tells plain repetition apart, into the probability of label 1.

Training takes a bounded sample: at most ``sample`` rows per label, chosen by a hash of doc_id, and at most ``excerpt`` bytes of each; both are
parameters. Scoring reads every text whole.

Edge cases: null and empty texts have no size to compare and get the features (0, 0), so the score that the calibration gives to a text
without information; without rows of both labels every score is the share of label 1 (0.5 without any label); labels that are null or
neither 0 nor 1 are not used; repeated rows get equal scores; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm.common import map_arrow

SAMPLE, EXCERPT, DICTIONARY_BYTES, LEVEL = 3_000, 16_384, 112 << 10, 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    level: int = LEVEL


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


class Sizer:
    """Features of texts under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes, level: int) -> None:
        self.compressors = []
        for raw in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(raw)
            dictionary.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))

    def features(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), 2))
        good, bad = self.compressors
        for i, text in enumerate(texts):
            if text:
                g, b = len(good.compress(text)), len(bad.compress(text))
                out[i] = (b - g) / len(text), min(g, b) / len(text)
        return out


def _scaled(features: np.ndarray) -> np.ndarray:
    """The columns of the calibration: a saturated difference, and how far the text falls short of what ordinary text needs."""
    return np.column_stack([np.ones(len(features)), np.tanh(features[:, 0] * 10) * 10, np.minimum(features[:, 1], 0.25) * 40])


def _probability(features: np.ndarray, weights: tuple[float, ...]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_scaled(features) @ np.asarray(weights), -40, 40)))


def calibrate(features: np.ndarray, labels: np.ndarray, rounds: int = 60) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge; each label counts by its number of rows."""
    x, w = _scaled(features), np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (labels - p) - 0.01 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, held_out_fold: tuple[int, int] | None = None, sample: int = SAMPLE, excerpt: int = EXCERPT) -> QualityModel:
    """Model from labelled rows (doc_id, quality); rows of the fold (remainder, parts) are left out."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    if held_out_fold:
        usable = usable.where(fold(F.col("doc_id"), held_out_fold[1]) != held_out_fold[0])
    counts = dict(usable.groupBy("quality").count().collect())  # two rows at most
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    prior = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))
    if len(counts) < 2:
        return QualityModel(b"", b"", (prior, 0.0, 0.0))
    chosen = [
        usable.where(F.col("quality") == q).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (0, 1)
    ]
    ids = chosen[0].union(chosen[1])
    texts = docs.select("doc_id", "text").where("text IS NOT NULL AND text != ''")
    # The sample is bounded by its parameters, so it may be broadcast and gathered here.
    rows = texts.join(F.broadcast(ids), "doc_id").select(
        "quality", F.substring(F.encode("text", "UTF-8"), 1, excerpt).alias("text"), (F.xxhash64("doc_id", F.lit(1)) % 2 == 0).alias("for_dictionary"),
        F.xxhash64("doc_id").alias("order"),
    ).collect()
    rows = sorted(rows, key=lambda r: (r.order, bytes(r.text)))[: 4 * sample]
    if len({r.quality for r in rows}) < 2:
        return QualityModel(b"", b"", (prior, 0.0, 0.0))
    material = {q: [bytes(r.text) for r in rows if r.quality == q and r.for_dictionary] for q in (0, 1)}
    try:
        bad, good = (zstandard.train_dictionary(DICTIONARY_BYTES, material[q]).as_bytes() for q in (0, 1))
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        bad, good = (b"".join(material[q])[:DICTIONARY_BYTES] for q in (0, 1))
    seen = [r for r in rows if not r.for_dictionary] or rows
    features = Sizer(good, bad, LEVEL).features([bytes(r.text) for r in seen])
    is_good = np.array([r.quality for r in seen], dtype=float)
    weights = calibrate(features, is_good)
    # The sample holds the labels in other shares than the table: move the intercept by the difference in log odds.
    in_sample = np.clip(is_good.mean(), 1e-6, 1 - 1e-6)
    return QualityModel(good, bad, (weights[0] + prior - float(np.log(in_sample / (1 - in_sample))), weights[1], weights[2]))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every row, from its whole text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(model.good, model.bad, model.level)
        for batch in batches:
            features = sizer.features([t.encode("utf-8", "surrogatepass") if t else b"" for t in batch.column("text").to_pylist()])
            values = pa.array(_probability(features, model.weights), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], names=["doc_id", "score"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, score double")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; rows whose crc32 is divisible by 5 are held out of the training."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_fold=(0, 5))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

