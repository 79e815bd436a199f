"""Alignment of the tokens of two tokenizers over the same bytes.

Both tokenizers cut the same bytes; tokens overlap where they share a byte, and a group is a smallest stretch that both cut out whole. Every
token points to the overlapping token that ends farthest right, itself included (of two that end together, that of the first tokenizer), and
successors are doubled until nothing moves: each token then names the last token of its group. Every boundary of either tokenizer ends one
overlap, so links are counted and enumerated by sorted boundaries, never by pairs of tokens.

How many documents hold a pair of ids linked is a total over the whole corpus: blocks send their distinct pairs to the task that owns the
first id and get totals, and whether a total is the highest of its first id, back (``asking``).

Edge cases: null and empty texts, and texts whose bytes one tokenizer does not give back, have no tokens; a text is read whole, repeated rows each
count as a document and get equal answers, a null doc_id is an id like any other, an empty table gives an empty result, extra columns are
ignored. Ids must be below 2**24.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridlap.llm import asking
from gridlap.llm.common import by_bytes, map_arrow

ID_BITS = 24
ENCODE_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
# Below this character the Unicode tables of both libraries agree on what is a letter, a number or a space.
SETTLED = "ɐ"
_SPREAD = 0x9E3779B1 | 1
_MASK = (1 << ID_BITS) - 1
BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
    "keys binary, held binary, links binary"
)


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character by which byte-level vocabularies write bytes: printable ones are themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Ids by a byte-level vocabulary in a tokenizer file; with the same vocabulary as ranks beside it, common text is encoded by those."""

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None) -> None:
        import tokenizers

        self._whole = tokenizers.Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True
        self._whole.no_truncation()
        self._whole.no_padding()
        alphabet = _byte_alphabet()
        entries = sorted(self._whole.get_vocab().items(), key=lambda e: e[1])
        self.pieces = [b""] * (entries[-1][1] + 1)
        for entry, k in entries:
            self.pieces[k] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self._by_ranks = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self._by_ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._by_ranks is None:
            return [e.ids for e in self._whole.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return [
            self._by_ranks.encode_ordinary(" " + t) if t.isascii() or max(t) < SETTLED else self._whole.encode(" " + t, add_special_tokens=False).ids
            for t in texts
        ]


class Pieces:
    """Ids by a model of pieces with byte fallback, which puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for k in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(k)
            self.pieces.append(bytes([int(piece[3:5], 16)]) if self._model.is_byte(k) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Tokenizers:
    """Files of the two tokenizers; opened once in each worker."""

    first: str
    second: str
    first_ranks: str | None = None
    pattern: str | None = None

    def open(self) -> tuple[ByteLevel, Pieces]:
        if self not in _opened:
            _opened[self] = ByteLevel(self.first, self.first_ranks, self.pattern), Pieces(self.second)
        return _opened[self]


_opened: dict[Tokenizers, tuple[ByteLevel, Pieces]] = {}


@dataclass
class Aligned:
    """Alignment of some texts: per text counts and where its tokens and links lie in the flat arrays."""

    first_ids: np.ndarray
    second_ids: np.ndarray
    first_group: np.ndarray
    second_group: np.ndarray
    linked: np.ndarray  # of each link its place in first_ids and second_ids
    first_at: np.ndarray
    second_at: np.ndarray
    group_at: np.ndarray
    link_at: np.ndarray


def groups_by_jumping(first_end: np.ndarray, second_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of both cuts the token of the first cut that ends its group."""
    n = len(first_end)
    across = np.searchsorted(second_end, first_end)  # the last token it overlaps: the first that does not end before it
    succ_first = np.where(second_end[across] == first_end, np.arange(n), n + across) if n else across
    succ = np.concatenate([succ_first, np.searchsorted(first_end, second_end)])
    while True:
        further = succ[succ]
        if (further == succ).all():
            return succ[:n], succ[n:]
        succ = further


def align(first: list[list[int]], second: list[list[int]], first_bytes: np.ndarray, second_bytes: np.ndarray) -> Aligned:
    """Aligns texts given as ids; ``first_bytes`` and ``second_bytes`` are the numbers of bytes of the ids. Both ids of a text must cover as many bytes."""
    a, b = (np.array([i for own in ids for i in own], dtype=np.int64) for ids in (first, second))
    first_at, second_at = (np.cumsum([0, *map(len, ids)]) for ids in (first, second))
    a_end, b_end = np.cumsum(first_bytes[a]), np.cumsum(second_bytes[b])
    last_a, last_b = groups_by_jumping(a_end, b_end)
    ends = np.union1d(a_end, b_end)
    linked = np.stack([np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)])
    final = np.unique(last_a)
    begins = np.append(0, a_end)[first_at]  # in bytes
    return Aligned(
        a, b, np.searchsorted(final, last_a), np.searchsorted(final, last_b), linked, first_at, second_at,
        np.searchsorted(final, first_at), np.searchsorted(ends, begins, side="right"),
    )


def written(aligned: Aligned, first_names: list[str], second_names: list[str]) -> list[str]:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``. ``*_names``: ids as text, each with the two marks that may follow it."""
    a, b, ga, gb = aligned.first_ids, aligned.second_ids, aligned.first_group, aligned.second_group
    place_a = np.arange(len(a)) + np.searchsorted(gb, ga)
    place_b = np.arange(len(b)) + np.searchsorted(ga, gb, side="right")
    last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    codes[place_a] = 2 * a + last_a[: len(a)]
    codes[place_b] = 2 * (b + len(first_names) // 2) + last_b[: len(b)]
    names = first_names + second_names
    cuts = aligned.first_at + aligned.second_at
    return ["".join(map(names.__getitem__, codes[lo:hi].tolist()))[:-1] for lo, hi in zip(cuts[:-1], cuts[1:])]


def _names(pieces: list[bytes], within: str, after: str) -> list[str]:
    return [f"{k}{mark}" for k in range(len(pieces)) for mark in (within, after)]


def encoded_alike(texts: list[str | None], first: ByteLevel, second: Pieces) -> tuple[list[int], list[list[int]], list[list[int]]]:
    """The texts whose bytes both tokenizers give back, as places in ``texts`` and ids."""
    at = [k for k, t in enumerate(texts) if t]
    out: tuple[list[int], list[list[int]], list[list[int]]] = ([], [], [])
    own = [texts[k] for k in at]
    for k, text, a, b in zip(at, own, first.encode(own), second.encode(own)):
        whole = b" " + text.encode()
        if b"".join(map(first.pieces.__getitem__, a)) == whole and b"".join(map(second.pieces.__getitem__, b)) == whole:
            for column, value in zip(out, (k, a, b)):
                column.append(value)
    return out


def align_texts(texts: list[str | None], first: ByteLevel, second: Pieces) -> Iterator[tuple[list[int], Aligned, int, int]]:
    """Bounded stretches lo..hi of the texts: which of them have tokens, and their alignment."""
    first_bytes, second_bytes = (np.array([len(p) for p in t.pieces], dtype=np.int64) for t in (first, second))
    for lo, hi in by_bytes(texts, ENCODE_BYTES):
        at, a, b = encoded_alike(texts[lo:hi], first, second)
        yield at, align(a, b, first_bytes, second_bytes), lo, hi


def alignment_groups(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """doc_id and the groups of every text as text (empty without tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tokenizers.open()
        names = _names(first.pieces, ",", "|"), _names(second.pieces, ",", ";")
        for batch in batches:
            for at, aligned, lo, hi in align_texts(batch.column("text").to_pylist(), first, second):
                groups = [""] * (hi - lo)
                for k, text in zip(at, written(aligned, *names)):
                    groups[k] = text
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(groups, pa.string())], names=["doc_id", "groups"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, groups string")


def _keys(aligned: Aligned) -> np.ndarray:
    """One number for the ids of each link; ids of the first tokenizer are spread, the second's stay together."""
    a, b = aligned.first_ids[aligned.linked[0]], aligned.second_ids[aligned.linked[1]]
    return ((a.astype(np.uint64) * np.uint64(_SPREAD)) & np.uint64(_MASK)) << np.uint64(ID_BITS) | b.astype(np.uint64)


def alignment_blocks(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Blocks of aligned documents: counts and digest of the groups of each, distinct pairs of ids with the number of documents that hold them, and
    the links of each document as places in those pairs, in ascending order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tokenizers.open()
        names = _names(first.pieces, ",", "|"), _names(second.pieces, ",", ";")
        for batch in batches:
            ids, values = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in by_bytes(values, BLOCK_BYTES):
                yield block(ids[lo:hi], values[lo:hi], first, second, names)

    def block(ids: list, texts: list, first: ByteLevel, second: Pieces, names: tuple[list[str], list[str]]) -> pa.RecordBatch:
        counts = np.zeros((4, len(ids)), dtype=np.int64)
        groups = [""] * len(ids)
        keys: list[np.ndarray] = []
        for at, aligned, lo, _ in align_texts(texts, first, second):
            own = np.array(at, dtype=np.int64) + lo
            for k, cuts in enumerate((aligned.first_at, aligned.second_at, aligned.group_at, aligned.link_at)):
                counts[k, own] = np.diff(cuts)
            for k, text in zip(own.tolist(), written(aligned, *names)):
                groups[k] = hashlib.sha256(text.encode()).hexdigest()
            keys.append(_keys(aligned))
        pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
        doc = np.repeat(np.arange(len(ids)), counts[3])
        links = np.sort(doc * max(1, len(pairs)) + place)
        held = np.bincount(links[np.append(True, np.diff(links) > 0)[: len(links)]] % max(1, len(pairs)), minlength=len(pairs))
        links %= max(1, len(pairs))
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (ids, *counts)]
        blobs = [pa.array([x], pa.binary()) for x in (asking.packed_keys(pairs), asking.packed(held), asking.packed_keys(links.astype(np.uint64)))]
        return pa.RecordBatch.from_arrays(
            [pa.array([asking.new_block()], pa.int64()), *lists, pa.array([groups], pa.list_(pa.string())), *blobs], names=[c.split()[0] for c in BLOCK.split(", ")]
        )

    return map_arrow(docs.select("doc_id", "text"), run, BLOCK)


def _totals(keys: list[np.ndarray], amounts: list[np.ndarray]) -> list[asking.Answer]:
    """Documents of each pair, times 2, plus 1 where no pair of the same first id has more."""
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate([a[0] for a in amounts]).astype(np.float64)).astype(np.uint64)
    head = every >> np.uint64(ID_BITS)
    first = np.flatnonzero(np.append(True, head[1:] != head[:-1]))
    highest = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(every))))
    told = total * np.uint64(2) + (total == highest)
    cuts = np.cumsum([0, *map(len, keys)])
    return [(asking.packed(told[place[lo:hi]]), []) for lo, hi in zip(cuts[:-1], cuts[1:])]


def alignments(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    blocks = asking.stored_blocks(alignment_blocks(docs, tokenizers), "alignments")
    parts = asking.parts_for(docs)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, keys, held in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "held"))):
                pairs = asking.unpacked_keys(keys)
                yield asking.request_rows(number, pairs, [asking.unpacked(held)], asking.part_bounds(pairs, parts, ID_BITS))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [c.split()[0] for c in BLOCK.split(", ")][1:7]
        for batch in batches:
            for row in range(batch.num_rows):
                own = {c: batch.column(c)[row].as_py() for c in [*columns, "links", "told"]}
                told = asking.joined(own["told"])
                links = asking.unpacked_keys(own["links"]).astype(np.int64)
                cuts = np.cumsum([0, *own["n_links"]])
                sums = []
                for values in (told & np.uint64(1), told >> np.uint64(1)):
                    upto = np.append(0, np.cumsum(values[links].astype(np.int64)))
                    sums.append(upto[cuts[1:]] - upto[cuts[:-1]])
                out = [pa.array(own[c], pa.int64()) for c in columns[:5]] + [pa.array(s, pa.int64()) for s in sums] + [pa.array(own["groups"], pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=[*columns[:5], "n_best", "count_sum", "groups_sha256"])

    told = asking.answers(map_arrow(blocks.select("block", "keys", "held"), ask, asking.REQUEST), _totals)
    with_totals = asking.with_answers(blocks.drop("keys", "held"), told=told)
    return map_arrow(
        with_totals, finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level and the piece tokenizer over all documents."""
    tokenizers = Tokenizers(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return alignments(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizers)
