"""Languages of a document as a mixture: proportions by expectation-maximisation, the set of languages by penalised likelihood.

Counts of hashed three-byte pieces of letters are learned per language over all training rows. A document's pieces are a mixture of the
languages' distributions; expectation-maximisation finds the proportions. The single best language is kept unless a larger set, taken in
the order of the proportions, raises the log likelihood by more than ``PENALTY`` times log(pieces) for each further language.

Edge cases: a null text, or one without letters, is ``und`` with score 0, as is every text if nothing was learned; ties go to the first
language in alphabetical order; rows without lang are not learned from; repeated rows get equal answers; an empty table gives an empty
result; extra columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm.common import map_arrow

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
ROUNDS, SET_ROUNDS = 8, 30
PENALTY = 3.0
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_PLAIN = np.full(256, 0x20, dtype=np.uint32)
_PLAIN[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x61, 0x7B), *range(0x80, 0x100)]


def piece_counts(text: str) -> np.ndarray:
    """How often each bucket of three-byte pieces occurs in the lower-cased text; other characters than letters count as spaces."""
    data = _PLAIN[np.frombuffer(f" {text} ".lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    codes = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    codes = codes[(codes & np.uint32(0xFF00)) != 0x2000]  # a piece around a space says little
    return np.bincount((codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the probabilities (bucket, language) of their pieces, from rows (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                sums[lang] = sums.get(lang, 0) + piece_counts(text)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["lang", "bucket", "n"]
            )

    rows = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = map_arrow(rows, run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())  # languages x BUCKETS rows at most, whatever the size of the table
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    for k, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        table[own["bucket"].to_numpy(), k] += own["n"].to_numpy()
    return langs, table / table.sum(axis=0) if langs else table


def mixture(counts: np.ndarray, likelihoods: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions after some rounds of expectation-maximisation, and the log likelihood before the last step."""
    share, value = start, -np.inf
    total = counts.sum()
    for _ in range(rounds):
        by_piece = likelihoods @ share
        before, value = value, float(counts @ np.log(by_piece))
        share = share * ((counts / by_piece) @ likelihoods) / total
        if value - before < 1e-3:
            break
    return share, value


def language_set(counts: np.ndarray, likelihoods: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Proportions of the chosen set of languages; the others are 0."""
    size = likelihoods.shape[1]
    single = counts @ logs
    best = int(single.argmax())
    share = np.zeros(size)
    share[best] = 1.0
    cost = PENALTY * np.log(counts.sum() + 1)
    spread, full = mixture(counts, likelihoods, np.full(size, 1 / size), ROUNDS)
    # The whole mixture is at least as likely as any smaller set, so most documents are settled here; the bound is widened by what
    # further rounds could still add.
    if size == 1 or full - single[best] < cost - 0.05 * max(cost, full - single[best]):
        return share
    order, top = np.argsort(-spread, kind="stable"), single[best]
    for k in range(2, size + 1):
        chosen = order[:k]
        start = spread[chosen] + 1e-3
        part, value = mixture(counts, likelihoods[:, chosen], start / start.sum(), SET_ROUNDS)
        if value - (k - 1) * cost > top:
            top, share = value - (k - 1) * cost, np.zeros(size)
            share[chosen] = part
    return share


def predict(docs: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score (its proportion) and the chosen languages with their proportions, of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log(table)
        for batch in batches:
            names, scores, sets, shares = [], [], [], []
            for text in batch.column("text").to_pylist():
                share = None
                if text and langs and _LETTER.search(text):
                    counts = piece_counts(text)
                    at = np.flatnonzero(counts)
                    if len(at):
                        share = language_set(counts[at].astype(float), table[at], logs[at])
                if share is None:
                    names.append(UNKNOWN), scores.append(0.0), sets.append([]), shares.append([])
                    continue
                order = [k for k in np.argsort(-share, kind="stable") if share[k] > 0]
                names.append(langs[order[0]]), scores.append(min(1.0, float(share[order[0]])))
                sets.append([langs[k] for k in order]), shares.append([float(share[k]) for k in order])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))],
                names=["doc_id", "lang_pred", "score", "langs", "shares"],
            )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>")


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those whose crc32 leaves another remainder than 2 by 4."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    langs, table = learn(docs.where(~held_out))
    return predict(docs, langs, table).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.array_join("langs", "+").alias("langs"))


def report(found, folder):
    """Held-out accuracy, for trials by hand."""
    import pandas as pd

    both = found[found.held_out].merge(pd.read_parquet(f"{folder}/documents.parquet", columns=["doc_id", "lang"]), on="doc_id")
    print("accuracy", (both.lang == both.lang_pred).mean(), both.langs.value_counts().head(8).to_dict())
