"""Benchmark decontamination by SimHash over item-sized windows.

Item lengths are rounded down to classes a fifth apart. Of each item the first and the last words, as many as its class says, get a 64-bit
SimHash over word pairs; documents get one at every word for every class in use, from running sums of the bits. The 64 bits are cut in three
blocks: two fingerprints within ``RADIUS`` agree in one block up to a third of it, so an index of all block values that near is
enough to find every fingerprint within the radius. What is found is verified by the weighted Jaccard similarity (each shingle counts as often as it
occurs) of five-word shingles between the whole item and the window of its length.

Windows that the text's end cuts short, which may be shorter than the class and are all there is of a text shorter than its item, are searched
exactly: of the shingles of an item more than a fifth, the rarest, are in an index, and a window without any of those is below the threshold.

Different item texts are given to the tasks in passes of about ``ITEMS`` texts and ``ITEM_BYTES`` bytes, so what is sent is bounded; a worker builds the indexes of a pass
once. Hits are joined with the items by the digest of their text. Documents are never shuffled.

Edge cases: items that are null or have fewer than five words are not searched; null and empty texts and texts of fewer than five words match nothing; repeated items and
repeated rows are answered each; at a document's end the window is cut; of several places the most similar, then the first, is reported; empty
tables give an empty result; extra columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm.common import by_bytes, hashed_words, map_arrow, shingles

WORDS, THRESHOLD = 5, 0.8
RADIUS, BLOCKS = 11, (21, 21, 22)  # bits of each block of a fingerprint
STRIDE, ITEMS, ITEM_BYTES = 8_192, 2_000, 8 << 20
HIT_SCHEMA = "doc_id long, digest string, similarity double, first_word int, n_words int"


def size_class(words: int) -> int:
    """The largest class that is not over ``words``; classes are about a fifth apart."""
    size = WORDS
    while (following := max(size + 1, size * 6 // 5)) <= words:
        size = following
    return size


def running_bits(words: np.ndarray) -> np.ndarray:
    """Running sums, per bit, of +1 or -1 over the hashes of word pairs; row k sums the pairs before word k."""
    pairs = (words[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ words[1:]
    pairs ^= pairs >> np.uint64(31)
    pairs *= np.uint64(0xD6E8FEB86659FD93)
    bits = np.unpackbits(pairs.view(np.uint8).reshape(-1, 8), axis=1).view(np.int8)
    kind = np.int16 if len(words) < 1 << 15 else np.int32
    sums = np.zeros((len(words), 64), dtype=kind)
    np.cumsum(bits * np.int8(2) - np.int8(1), axis=0, dtype=kind, out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, size: int) -> np.ndarray:
    """SimHashes of all windows of ``size`` words."""
    return np.packbits(sums[size - 1 :] > sums[: len(sums) - size + 1], axis=1).view(np.uint64)[:, 0]


class BlockIndex:
    """The fingerprints of one class by all values that one block of their bits has within some flips.

    The values are a bitmap with the number of values before each of its words, so that a look-up is a bit and a count of bits.
    """

    def __init__(self, prints: np.ndarray, shift: int, bits: int, flips: int) -> None:
        self.shift, self.mask = np.uint64(shift), np.uint64((1 << bits) - 1)
        masks = block_masks(bits, flips)
        values = (((prints >> self.shift) & self.mask)[:, None] ^ masks[None, :]).ravel()
        order = np.argsort(values, kind="stable")
        values = values[order]
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        self.members = (order // len(masks)).astype(np.int32)
        self.offsets = np.append(first, len(values)).astype(np.int64)
        present = np.zeros(1 << bits, dtype=np.uint8)
        present[values[first]] = 1
        self.words = np.packbits(present, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def candidates(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, fingerprint) pairs that are near each other in this block."""
        value = (found >> self.shift) & self.mask
        word = self.words[(value >> np.uint64(6)).view(np.int64)]
        bit = np.uint64(1) << (value & np.uint64(63))
        at = np.flatnonzero(word & bit)
        value, word, bit = value[at], word[at], bit[at]
        rank = self.before[(value >> np.uint64(6)).view(np.int64)] + np.bitwise_count(word & (bit - np.uint64(1)))
        begin = self.offsets[rank]
        count = self.offsets[rank + 1] - begin
        ends = np.cumsum(count)
        which = self.members[np.repeat(begin - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        return np.repeat(at, count), which


@dataclass
class ClassIndex:
    """Fingerprints of one class with the item of each, the first word of the item that it covers, and an index per block."""

    prints: np.ndarray
    items: np.ndarray
    back: np.ndarray
    blocks: list[BlockIndex]

    def near(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, fingerprint) pairs within the radius."""
        pairs = []
        for block in self.blocks:
            window, which = block.candidates(found)
            close = np.bitwise_count(found[window] ^ self.prints[which]) <= RADIUS
            pairs.append(window[close] * np.int64(len(self.prints)) + which[close])
        both = np.unique(np.concatenate(pairs))
        return both // len(self.prints), both % len(self.prints)


def block_masks(bits: int, flips: int) -> np.ndarray:
    """All values of ``bits`` bits with at most ``flips`` set."""
    return np.array([sum(1 << b for b in chosen) for n in range(flips + 1) for chosen in combinations(range(bits), n)], dtype=np.uint64)


def build_index(items: list[np.ndarray]) -> dict[int, ClassIndex]:
    """Class indexes of items given as word hashes."""
    by_class: dict[int, list[tuple[np.uint64, int, int]]] = {}
    for k, words in enumerate(items):
        if len(words) >= WORDS:
            size = size_class(len(words))
            for back in sorted({0, len(words) - size}):
                part = words[back : back + size]
                by_class.setdefault(size, []).append((fingerprints(running_bits(part), size)[0], k, back))
    shifts = np.cumsum((0, *BLOCKS[:-1])).tolist()
    found = {}
    for size, rows in sorted(by_class.items()):
        prints, owners, back = (np.array(column, dtype=kind) for column, kind in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
        blocks = [BlockIndex(prints, shift, bits, RADIUS // len(BLOCKS)) for shift, bits in zip(shifts, BLOCKS)]
        found[size] = ClassIndex(prints, owners, back, blocks)
    return found


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger number of times each shingle occurs."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = np.bincount(at[: len(a)], minlength=len(values)), np.bincount(at[len(a) :], minlength=len(values))
    return float(np.minimum(left, right).sum() / np.maximum(left, right).sum())


@dataclass
class RareShingles:
    """Shingles of which a window similar to an item has at least one, sorted, with the item of each."""

    values: np.ndarray
    items: np.ndarray


def build_rare(grams: list[np.ndarray]) -> RareShingles:
    """For each item its rarest shingles, so many (counted as often as they occur) that without them the threshold is out of reach."""
    usable = [k for k, g in enumerate(grams) if len(g)]
    if not usable:
        return RareShingles(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    _, at, times = np.unique(np.concatenate([grams[k] for k in usable]), return_inverse=True, return_counts=True)
    often = np.split(times[at], np.cumsum([len(grams[k]) for k in usable])[:-1])
    rare = []
    for k, n in zip(usable, often):
        own = grams[k][np.lexsort([grams[k], n])]
        rare.append(np.unique(own[: int((1 - THRESHOLD) * len(own) + 1e-9) + 1]))
    values, items = np.concatenate(rare), np.repeat(usable, [len(r) for r in rare])
    order = np.argsort(values, kind="stable")
    return RareShingles(values[order], items[order])


def cut_windows(words: np.ndarray, begins: np.ndarray, items: list[np.ndarray], grams: list[np.ndarray], rare: RareShingles) -> dict[tuple[int, int], tuple]:
    """Best place (similarity, first word, words) per (text, item) among the windows that the end of their text cuts to fewer words than the item has."""
    best: dict[tuple[int, int], tuple] = {}
    if len(words) < WORDS or not len(rare.values):
        return best
    all_grams = shingles(words, WORDS)
    lengths = np.array([len(w) for w in items])
    ends = begins[1:][np.diff(begins) >= WORDS]
    reach = np.minimum(np.diff(begins)[np.diff(begins) >= WORDS], lengths.max() - 1) - WORDS + 1  # shingles of the longest cut window
    if not len(ends) or reach.max() < 1:
        return best
    stops = np.cumsum(reach)
    places = np.arange(stops[-1]) + np.repeat(ends - WORDS + 1 - stops, reach)
    found = all_grams[places]
    lo, hi = (np.searchsorted(rare.values, found, side=side) for side in ("left", "right"))
    at = np.flatnonzero(hi > lo)
    if not len(at):
        return best
    count = (hi - lo)[at]
    upto = np.cumsum(count)
    which = rare.items[np.repeat(lo[at] - (upto - count), count) + np.arange(upto[-1])]
    place = np.repeat(places[at], count)
    text = np.searchsorted(begins, place, side="right") - 1
    near = place > begins[text + 1] - lengths[which]
    both = np.unique(text[near] * np.int64(len(items)) + which[near])
    for t, k in zip((both // len(items)).tolist(), (both % len(items)).tolist()):
        begin, end, m = int(begins[t]), int(begins[t + 1]), len(grams[k])
        first = max(begin, end - len(items[k]) + 1)
        own = all_grams[first : end - WORDS + 1]
        shared = np.cumsum(np.isin(own, grams[k])[::-1])[::-1]  # of the window from each place on, an upper bound of what is in common
        bound = shared / np.maximum(m, np.arange(len(own), 0, -1) + m - shared)
        for p in np.argsort(-bound, kind="stable").tolist():
            if bound[p] < THRESHOLD - 1e-12 or ((t, k) in best and bound[p] < best[t, k][0]):
                break
            similarity = weighted_similarity(own[p:], grams[k])
            if similarity >= THRESHOLD - 1e-12:
                here = (similarity, -(first + p - begin), end - first - p)
                best[t, k] = max(best.get((t, k), here), here)
    return best


def search(words: np.ndarray, begins: np.ndarray, items: list[np.ndarray], grams: list[np.ndarray], index: dict[int, ClassIndex], rare: RareShingles) -> dict[tuple[int, int], tuple]:
    """Best place (similarity, first word, words) per (text, item) in some texts given as word hashes."""
    best = cut_windows(words, begins, items, grams, rare)
    tried: set[tuple[int, int, int]] = set()
    longest = max(index, default=0)
    for lo in range(0, len(words), STRIDE) if index else ():
        part = words[lo : lo + STRIDE + longest]
        if len(part) < WORDS:
            break
        sums = running_bits(part)
        for size, own in index.items():
            if len(part) < size:
                break
            windows, prints = own.near(fingerprints(sums[: STRIDE + size - 1], size))
            if not len(windows):
                continue
            place = windows + lo
            text = np.searchsorted(begins, place, side="right") - 1
            inside = place + size <= begins[text + 1]
            for p, t, f in zip(place[inside].tolist(), text[inside].tolist(), prints[inside].tolist()):
                k = int(own.items[f])
                first = max(p - int(own.back[f]), int(begins[t]))
                if (t, k, first) in tried:
                    continue
                tried.add((t, k, first))
                last = min(first + len(items[k]), int(begins[t + 1]))
                similarity = weighted_similarity(shingles(words[first:last], WORDS), grams[k])
                if similarity >= THRESHOLD - 1e-12:
                    here = (similarity, -(first - int(begins[t])), last - first)
                    best[t, k] = max(best.get((t, k), here), here)
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, items_per_pass: int = ITEMS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) of every row and item that it holds."""
    wanted = benchmark.where("text IS NOT NULL").select("item_id", "text", F.sha2("text", 256).alias("digest"))
    texts = wanted.groupBy("digest").agg(F.any_value("text").alias("text"))
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, -(-n // items_per_pass), -(-size // ITEM_BYTES))
    out = None
    for k in range(passes):
        part = texts.where(F.pmod(F.xxhash64("digest"), F.lit(passes)) == k)
        hits = _one_pass(docs, part.collect())  # about items_per_pass texts and ITEM_BYTES bytes at most
        out = hits if out is None else out.union(hits)
    return out.join(wanted.select("digest", "item_id"), "digest").select("doc_id", "item_id", "similarity", "first_word", "n_words")


@dataclass
class Prepared:
    """What the documents of a pass are searched with."""

    items: list[np.ndarray]
    grams: list[np.ndarray]
    index: dict[int, ClassIndex]
    rare: RareShingles


_prepared: dict[tuple[str, ...], Prepared] = {}


def prepare(digests: tuple[str, ...], texts: list[str]) -> Prepared:
    """The indexes of a pass, built once per worker process; those of the pass before go."""
    if digests not in _prepared:
        _prepared.clear()
        words, at = hashed_words(texts)
        items = [words[a:b] for a, b in zip(at[:-1], at[1:])]
        grams = [shingles(w, WORDS) for w in items]
        rare = build_rare([g if len(w) >= WORDS else g[:0] for w, g in zip(items, grams)])
        _prepared[digests] = Prepared(items, grams, build_index(items), rare)
    return _prepared[digests]


def _one_pass(docs: DataFrame, rows: list) -> DataFrame:
    rows = sorted(rows)
    digests, item_texts = tuple(r.digest for r in rows), [r.text for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = prepare(digests, item_texts)
        for batch in batches:
            doc_ids, values = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            found = []
            for lo, hi in by_bytes(values, 1 << 19):
                for (t, k), (similarity, first, n) in sorted(search(*hashed_words(values[lo:hi]), own.items, own.grams, own.index, own.rare).items()):
                    found.append((doc_ids[lo + t], digests[k], similarity, -first, n))
            columns = list(zip(*found)) if found else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in HIT_SCHEMA.split(", ")])

    return map_arrow(docs.select("doc_id", "text"), run, HIT_SCHEMA)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All benchmark items in all documents."""
    hits = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.withColumn("similarity", F.round("similarity", 6))


def report(found, folder):
    """Comparison with a search for whole items and with all windows, for trials by hand."""
    import pandas as pd

    docs, items = (pd.read_parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    pairs = set(zip(found.doc_id, found.item_id))
    exact = {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, b in zip(items.item_id, items.text) if b in t} if len(docs) < 60_000 else set()
    print("pairs", len(pairs), "verbatim", len(exact), "verbatim missed", len(exact - pairs), "not verbatim", len(pairs - exact), found.similarity.describe().round(3).to_dict())
    if len(docs) > 2000:
        return
    words, at = hashed_words(docs.text.tolist())
    iw, ia = hashed_words(items.text.tolist())
    true = set()
    for k, item in enumerate(items.item_id):
        own = iw[ia[k] : ia[k + 1]]
        g = set(shingles(own, WORDS).tolist())
        for d in range(len(docs)):
            w = words[at[d] : at[d + 1]]
            hit = np.isin(shingles(w, WORDS), list(g)) if len(w) >= WORDS else np.zeros(0)
            if hit.sum() < 0.5 * len(g):
                continue
            for s in range(max(0, np.flatnonzero(hit)[0] - len(own)), len(w)):
                if weighted_similarity(shingles(w[s : s + len(own)], WORDS), shingles(own, WORDS)) >= 0.8:
                    true.add((docs.doc_id[d], item))
                    break
    print("true pairs", len(true), "missed", len(true - pairs), "wrong", len(pairs - true))
