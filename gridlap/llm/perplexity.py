"""Quality rules by perplexity under a word bigram model with modified Kneser-Ney smoothing, with bands for each language.

The model is counted over all documents and never gathered: a table of blocks holds the documents as word numbers, blocks send their distinct bigrams to
the tasks that own them and get totals back (``asking``), sorted arrays of hashes throughout. One block of those that hold a bigram, the first,
counts it for its context (how many words follow it once, twice, more often) and for its word (how many words it follows); a second round
of questions adds these up for each word. Only seven sums come to the driver: bigrams that occur once to four times, all bigrams, words.

Each document is scored by the model of all other rows: its own counts are taken out of every number it uses. So made-up words do not vouch for
themselves, and other copies of a text still do. Words nothing else in the corpus has share what the lowest order leaves over. A document's score is
the mean negative log probability of its words, the first one after a mark for the beginning.

Documents that fail fixed rules on words and repetition are rejected. Of the others the median and the upper quartile of the scores of each language
are taken; their distance is the unit, because copies in the corpus draw the lower half down and leave the upper one alone. A document more than
``ABOVE`` units over the quartile is too unlike the language, one more than ``BELOW`` units under the median too predictable; both are rejected.

A word is a longest run of bytes other than the six white-space characters of ASCII; words are compared by 48-bit hashes of their bytes, lines by
their bytes. The hashes of bigrams have ``SPARE_BITS`` more bits than the number of words in the corpus needs, so one in 2**SPARE_BITS bigrams at most
shares its hash, in a corpus of any size.

Edge cases: null and empty texts and texts without words have no score and fail the rules; a null language is a language of its own; every row is
a document, so repeated rows count each and get equal answers; null doc_ids are carried along; an empty table gives an empty result; extra columns
are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm import asking
from gridlap.llm.common import by_bytes, map_arrow, mix, power_tables, release_shuffles, stage

BLOCK_BYTES = 16 << 20
SCORED_WORDS = 1 << 19
SPARE_BITS = 12
LEAST_WORDS, WINDOW, REPEAT_PERCENT = 50, 3, 50
SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\v\f\r"
ABOVE, BELOW, LEAST_UNIT = 5.0, 24.0, 0.1
LEFT_OVER = 0.75
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BLOCK = "block long, doc_id array<long>, lang array<string>, " + ", ".join(f"{s} array<long>" for s in STATS) + ", vocabulary binary, words binary"
SCORED = "doc_id long, lang string, " + ", ".join(f"{s} long" for s in STATS) + ", entropy double"
_SPREAD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - asking.KEY_BITS)
_BEGIN = np.uint64(0x5851F42D4C95)
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[list(SPACES)] = False


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (one more entry than texts)."""
    parts, counts = [], [0]
    for lo, hi in by_bytes(raw):
        data = np.frombuffer(b"\n".join(raw[lo:hi]) + b"\n", dtype=np.uint8)
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[1:] = _IN_WORD[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        up, down = power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        parts.append(mix((sums[ends] - sums[starts]) * down[starts]) >> _SHIFT)
        begins = np.cumsum([0, *(len(r) + 1 for r in raw[lo:hi])])
        counts += np.diff(np.searchsorted(starts, begins)).tolist()
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64), np.cumsum(counts)


def repeated_words(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each text the number of words in runs of ``WINDOW`` words that its text has more than once."""
    n = len(words)
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = np.flatnonzero(text_of[: max(0, n - WINDOW + 1)] == text_of[WINDOW - 1 :])
    h = mix(text_of[places].astype(np.uint64) + np.uint64(1))
    for k in range(WINDOW):
        h = mix((h ^ words[places + k]) * _SPREAD)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = places[order][np.append(same, False) | np.append(False, same)] if len(places) else places
    covered = np.zeros(n + WINDOW, dtype=bool)
    for k in range(WINDOW):
        covered[twice + k] = True
    return np.bincount(text_of[covered[:n]], minlength=len(bounds) - 1)


def rule_numbers(texts: list[str], raw: list[bytes]) -> np.ndarray:
    """Rows: code points in words, symbols, and lines with a word that equal an earlier line, of each text."""
    out = np.zeros((3, len(texts)), dtype=np.int64)
    for k, (text, own) in enumerate(zip(texts, raw)):
        lines = [line for line in own.split(b"\n") if line.strip(SPACES)]
        out[:, k] = (
            len(text) - len(own) + len(own.translate(None, SPACES)), len(own) - len(own.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
        )
    return out


def document_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents as numbers of words in the block's sorted vocabulary, with the numbers the rules use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, langs, hashes, stats, size = [], [], [], [], 0
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in by_bytes(texts.to_pylist()):
                ids += batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                langs += batch.column("lang").slice(lo, hi - lo).to_pylist()
                own, numbers = described([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                hashes.append(own)
                stats.append(numbers)
                size += int(numbers[1].sum()) + len(own)
                if size >= BLOCK_BYTES:
                    yield block(ids, langs, hashes, stats)
                    ids, langs, hashes, stats, size = [], [], [], [], 0
        if ids:
            yield block(ids, langs, hashes, stats)

    def described(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        own, bounds = word_hashes(raw)
        return own, np.stack([np.diff(bounds), *rule_numbers(texts, raw), repeated_words(own, bounds)])

    def block(ids: list, langs: list, hashes: list[np.ndarray], stats: list[np.ndarray]) -> pa.RecordBatch:
        vocabulary, words = np.unique(np.concatenate(hashes), return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([asking.new_block()], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([langs], pa.list_(pa.string())),
                *(pa.array([s], pa.list_(pa.int64())) for s in np.concatenate(stats, axis=1)),
                pa.array([asking.packed_keys(vocabulary)], pa.binary()), pa.array([asking.packed(words)], pa.binary()),
            ],
            names=[c.split()[0] for c in BLOCK.split(", ")],
        )

    return map_arrow(docs.select("doc_id", "lang", "text"), run, BLOCK)


class Bigrams:
    """The distinct bigrams of a block, as codes (number of the context times size of the vocabulary, plus number of the word) in ascending order, and of
    every word the code of its bigram. A context is a word or, for the beginning, the last number of the vocabulary."""

    def __init__(self, vocabulary: bytes, words: bytes, n_words: list[int]) -> None:
        self.vocabulary = np.append(asking.unpacked_keys(vocabulary), _BEGIN)
        self.size = len(self.vocabulary)
        word = asking.unpacked(words).astype(np.int64)
        self.codes = np.append(self.size - 1, word)[:-1] if len(word) else word.copy()
        self.bounds = np.cumsum([0, *n_words])
        self.codes[self.bounds[:-1][np.diff(self.bounds) > 0]] = self.size - 1
        self.codes *= self.size
        self.codes += word
        del word
        self.distinct, self.counts = np.unique(self.codes, return_counts=True)

    def context(self) -> np.ndarray:
        return self.distinct // self.size

    def word(self) -> np.ndarray:
        return self.distinct % self.size

    def keys(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the distinct bigrams in ascending order, and the place of each among the codes."""
        keys = self.vocabulary[self.context()]
        keys *= _SPREAD
        keys += self.vocabulary[self.word()]
        keys = mix(keys) >> np.uint64(64 - bits)
        order = np.argsort(keys, kind="stable")
        return keys[order], order


def _bigram_totals(keys: list[np.ndarray], amounts: list[np.ndarray]) -> list[asking.Answer]:
    """Occurrences of each bigram in other blocks, times 2, plus 1 for the first block that has it; tally: how many such bigrams occur 1, 2, 3, 4
    times, and all."""
    every, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    own = np.concatenate([a[0] for a in amounts])
    total = np.bincount(place, own.astype(np.float64)).astype(np.uint64)[place]
    is_first = np.zeros(len(place), dtype=np.uint64)
    is_first[first] = 1
    told = (total - own) * np.uint64(2) + is_first
    cuts = np.cumsum([0, *map(len, keys)])
    out = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        counted = total[lo:hi][is_first[lo:hi] == 1]
        out.append((asking.packed(told[lo:hi]), [*np.bincount(np.minimum(counted, 5).astype(np.int64), minlength=6)[1:5].tolist(), len(counted)]))
    return out


def _word_sums(keys: list[np.ndarray], amounts: list[np.ndarray]) -> list[asking.Answer]:
    """What the other blocks add to the five columns of each word; tally: words (the mark for the beginning is one), told once."""
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    columns = np.concatenate(amounts, axis=1)
    sums = np.stack([np.bincount(place, c.astype(np.float64)).astype(np.uint64)[place] - c for c in columns])
    cuts = np.cumsum([0, *map(len, keys)])
    return [(asking.packed(sums[:, lo:hi].T.ravel()), [len(every) if lo == 0 else 0]) for lo, hi in zip(cuts[:-1], cuts[1:])]


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more; within 0 and the count where counts of counts are missing."""
    share = n1 / (n1 + 2 * n2) if n1 else 0.5
    above = [(n2, n1), (n3, n2), (n4, n3)]
    return np.array([0.0, *(min(max(k - (k + 1) * share * (more / less if less else 0), 0.1), k - 0.1) for k, (more, less) in enumerate(above, 1))])


def _by_class(own: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """For each group the number of members of class 1, 2 and 3 (three or more)."""
    return np.stack([np.bincount(group[own == k], minlength=size) for k in (1, 2, 3)])


def document_log_probs(bigrams: Bigrams, total: np.ndarray, sums: np.ndarray, off: np.ndarray, n_types: int, n_vocabulary: int) -> np.ndarray:
    """Log probability of each document under the counts of all other rows.

    ``total`` are the occurrences of the distinct bigrams, ``sums`` (words x 5) of the words: occurrences as context, words that follow
    once, twice, more often, words before. Documents are scored in runs of about ``SCORED_WORDS`` words.
    """
    out = [np.zeros(0)]
    bounds, lo = bigrams.bounds, 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SCORED_WORDS, side="right")) - 1)
        out.append(_log_probs(bigrams, bounds[lo : hi + 1], total, sums, off, n_types, n_vocabulary))
        lo = hi
    return np.concatenate(out)


def _log_probs(bigrams: Bigrams, bounds: np.ndarray, total: np.ndarray, sums: np.ndarray, off: np.ndarray, n_types: int, n_vocabulary: int) -> np.ndarray:
    n_docs, size, n_distinct = len(bounds) - 1, bigrams.size, max(1, len(total))
    doc_of = np.repeat(np.arange(n_docs), np.diff(bounds))
    own, times = np.unique(doc_of * n_distinct + np.searchsorted(bigrams.distinct, bigrams.codes[bounds[0] : bounds[-1]]), return_counts=True)
    doc, bigram = own // n_distinct, own % n_distinct
    context, word = bigrams.distinct[bigram] // size, bigrams.distinct[bigram] % size
    rest = total[bigram] - times

    # A context's rows of one document are neighbours.
    fresh = np.append(True, (doc[1:] != doc[:-1]) | (context[1:] != context[:-1]))[: len(doc)]
    group = np.cumsum(fresh) - 1
    size_g = int(group[-1]) + 1 if len(group) else 0
    base = sums[context[fresh]]
    seen = base[:, 0] - np.bincount(group, times, size_g).astype(np.int64)
    following = base[:, 1:4].T - _by_class(np.minimum(total[bigram], 3), group, size_g) + _by_class(np.minimum(rest, 3), group, size_g)

    gone = rest == 0
    per_word, word_group = np.unique(doc * size + word, return_inverse=True)
    before = sums[per_word % size, 4] - np.bincount(word_group[gone], minlength=len(per_word))
    types = np.maximum(1, n_types - np.bincount(doc[gone], minlength=n_docs))
    lowest = (np.maximum(before[word_group] - LEFT_OVER, 0) + LEFT_OVER * n_vocabulary / (n_vocabulary + 1)) / types[doc]

    known = np.maximum(seen, 1)
    weight = np.where(seen > 0, off[1:] @ following / known, 1.0)
    direct = np.where(seen[group] > 0, np.maximum(rest - off[np.minimum(rest, 3)], 0) / known[group], 0.0)
    return np.bincount(doc, times * np.log(direct + weight[group] * lowest), n_docs)


def perplexities(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the numbers the rules use, and entropy (mean negative log probability of a word; null without words) of every row."""
    spark = docs.sparkSession
    blocks = asking.stored_blocks(document_blocks(docs), "perplexity_blocks")
    content = blocks.select("block", "n_words", "vocabulary", "words")
    parts = asking.parts_for(docs)
    n_corpus = blocks.select(F.aggregate("n_words", F.lit(0).cast("long"), lambda a, n: a + n).alias("n")).agg(F.sum("n")).first()[0] or 1
    bits = min(62, max(24, int(n_corpus).bit_length() + SPARE_BITS))

    def ask_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Bigrams(row["vocabulary"], row["words"], row["n_words"])
            keys, order = own.keys(bits)
            yield asking.request_rows(row["block"], keys, [own.counts[order]], asking.part_bounds(keys, parts, bits=bits))

    def totals(own: Bigrams, told: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of the distinct bigrams, and of which this is the first block."""
        answer = np.empty(len(own.distinct), dtype=np.uint64)
        answer[own.keys(bits)[1]] = asking.joined(told)
        return (answer // np.uint64(2)).astype(np.int64) + own.counts, answer % np.uint64(2) == 1

    told = stage(asking.answers(map_arrow(content, ask_bigrams, asking.REQUEST), _bigram_totals), "bigram-totals")
    release_shuffles(spark)
    *n, n_types = _tallies(told, 5)
    off = discounts(*n)

    def word_columns(own: Bigrams, total: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What a block adds to each word of its vocabulary (rows), by the bigrams it is the first to have."""
        total, context, word = total[first], own.context()[first], own.word()[first]
        classes = _by_class(np.minimum(total, 3), context, own.size)
        return np.stack([np.bincount(context, total, own.size).astype(np.int64), *classes, np.bincount(word, minlength=own.size)], axis=1)

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Bigrams(row["vocabulary"], row["words"], row["n_words"])
            columns = word_columns(own, *totals(own, row["told"]))
            order = np.argsort(own.vocabulary, kind="stable")
            keys = own.vocabulary[order]
            yield asking.request_rows(row["block"], keys, list(columns[order].T.astype(np.uint64)), asking.part_bounds(keys, parts))

    with_bigrams = asking.with_answers(content, told=told)
    summed = stage(asking.answers(map_arrow(with_bigrams, ask_words, asking.REQUEST), _word_sums), "word-sums")
    release_shuffles(spark)
    n_vocabulary = max(0, _tallies(summed, 1)[0] - 1)  # without the mark for the beginning

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Bigrams(row["vocabulary"], row["words"], row["n_words"])
            total, first = totals(own, row["told"])
            sums = word_columns(own, total, first)
            sums[np.argsort(own.vocabulary, kind="stable")] += asking.joined(row["sums"]).astype(np.int64).reshape(-1, 5)
            logs = document_log_probs(own, total, sums, off, n_types, n_vocabulary)
            entropy = [-x / n if n else None for x, n in zip(logs.tolist(), row["n_words"])]
            columns = [pa.array(row["doc_id"], pa.int64()), pa.array(row["lang"], pa.string()), *(pa.array(row[s], pa.int64()) for s in STATS), pa.array(entropy, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCORED.split(", ")])

    return map_arrow(asking.with_answers(blocks, told=told, sums=summed), score, SCORED)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}


def _tallies(answered: DataFrame, n: int) -> list[int]:
    """Sums of the tallies: one row."""
    sums = answered.agg(*(F.sum(F.col("tally")[k]).alias(f"s{k}") for k in range(n))).first()
    return [s or 0 for s in sums]


def base_failed():
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def judged(scored: DataFrame, above: float = ABOVE, below: float = BELOW) -> DataFrame:
    """Rows of ``perplexities`` with base_failed, perplexity, the band of their language and kept."""
    spark = scored.sparkSession
    scored = stage(scored.withColumn("base_failed", base_failed()).withColumn("band", F.coalesce("lang", F.lit(""))), "perplexities")
    release_shuffles(spark)
    quantiles = F.percentile_approx("entropy", F.array(F.lit(0.5), F.lit(0.75)), 10_000)
    bands = scored.where("NOT base_failed").groupBy("band").agg(quantiles.alias("q"))
    unit = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_UNIT))
    # A table of languages, so that the planner knows its size and need not shuffle the documents by language.
    bands = stage(bands.select("band", (F.col("q")[0] - below * unit).alias("low"), (F.col("q")[1] + above * unit).alias("high")), "bands")
    kept = ~F.col("base_failed") & F.col("entropy").between(F.col("low"), F.col("high"))
    return scored.join(bands, "band", "left").select(
        "doc_id", "lang", *STATS, "base_failed", F.coalesce(kept, F.lit(False)).alias("kept"), F.exp("entropy").alias("perplexity"),
        F.exp("low").alias("least_perplexity"), F.exp("high").alias("most_perplexity"),
    )


def op11_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and perplexity bands for all documents."""
    return judged(perplexities(spark.read.parquet(f"{sf_dir}/documents.parquet")))
