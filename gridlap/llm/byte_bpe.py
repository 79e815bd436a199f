"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

An encoding is valid exactly when each pair of neighbouring tokens is: merging the bytes of the two by rank gives the two tokens back.
So every prefix of a piece has one valid encoding, and it ends with the one token whose left neighbour, the last token of the shorter
prefix, accepts it. The transducer reads bytes; its state holds, for each prefix that a longer token may still extend, the last token of
the prefix and the bytes since, so it looks back no further than the longest token. It gives the last token of each prefix, and the ids
are read from these backwards. In a long piece, what all those prefixes agree on is emitted every ``EMIT_AFTER`` bytes. States and
transitions are built when first met, and kept while their tables have room; beyond that they are built again for each use.

Edge cases: a null or empty text has no tokens; bytes that no token covers cannot occur because all 256 single bytes are tokens (checked);
texts of any length are encoded whole, piece by piece; repeated rows give repeated results; an empty table gives an empty result; extra
columns are ignored. Decoding ids whose bytes are not UTF-8 gives the bytes as they are, and U-FFFD per bad byte where text is asked for.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from gridlap.llm.common import by_bytes, map_arrow

STATE_LIMIT = 100_000
PAIR_LIMIT = 120_000
PIECE_LIMIT = 30_000
SPAN_LIMIT = 200_000
DECODED = 512  # tokens that the streaming decoder takes at a time
EMIT_AFTER = 4096  # bytes of a piece after which the ids that are settled are emitted
NONE = -1
_LONE_SPACE = regex.compile(r" (?!\S)")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} does not cover all single bytes")
    return ranks


class State(dict):
    """Where the transducer stands after some bytes; the entries are the moves met so far, by byte.

    ``alive`` lists, flat, the prefixes that a token may still end behind, longest bytes since first: for each the place of these bytes
    in the trie of tokens, and the last token of the prefix. The whole text read so far is the last of them; ``last`` is its last token.
    """

    __slots__ = ("alive", "last")

    def __init__(self, alive: tuple[int, ...]) -> None:
        self.alive = alive
        self.last = alive[-1]


class Transducer:
    """Encodes pieces of text; ``encode`` gives the ids of one piece."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.size = max(self.bytes_of) + 1
        self.length = [len(self.bytes_of.get(i, b"")) for i in range(self.size)]
        # The trie: where a byte leads from a place; the token that ends at a place, how deep it lies, whether tokens go on there.
        self.goto: dict[int, int] = {}
        self.token_at, self.depth, self.goes_on = [NONE], [0], [True]
        for text, token in ranks.items():
            place = 0
            for byte in text:
                self.goes_on[place] = True
                key = place << 8 | byte
                if key not in self.goto:
                    self.goto[key] = len(self.token_at)
                    self.token_at.append(NONE)
                    self.depth.append(self.depth[place] + 1)
                    self.goes_on.append(False)
                place = self.goto[key]
            self.token_at[place] = token
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.spans: dict[str, tuple[int, ...]] = {}
        self.start = State((0, NONE))
        self.states: dict[tuple[int, ...], State] = {self.start.alive: self.start}

    def merge(self, data: bytes, below: int) -> list[bytes]:
        """The defining procedure: join the neighbouring parts of lowest rank, as long as that rank is under ``below``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1)]
            rank, at = min(ranked)
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that are joined last when a token is put together. None if the merges never give this token."""
        if token not in self.splits:
            parts = self.merge(self.bytes_of[token], token)
            self.splits[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.splits[token]

    def spine(self, token: int, side: int) -> list[tuple[bytes, int]] | None:
        """The parts that stand at one edge of a token while it is put together, each with the rank at which it is used up.

        ``side`` 0 is the left edge, 1 the right one. None if the merges never give this token.
        """
        found, used = [], 1 << 60
        while True:
            found.append((self.bytes_of[token], used))
            if self.length[token] == 1:
                return found
            parts = self.split(token)
            if parts is None:
                return None
            token, used = parts[side], token

    def accepts(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` (NONE: begin a piece): no merge across the two comes before those inside them."""
        after = self.spine(right, 0)
        before = [] if left == NONE else self.spine(left, 1)
        if after is None or before is None:
            return False
        for a, a_used in before:
            for b, b_used in after:
                # Of merges of one rank the one further left comes first.
                rank = self.ranks.get(a + b)
                if rank is not None and rank < a_used and rank <= b_used:
                    return False
        return True

    def move(self, state: State, byte: int) -> State:
        """The state after ``byte``. Where the table is full, a new one serves this once and is not kept."""
        goto, token_at, goes_on, pairs, size = self.goto, self.token_at, self.goes_on, self.pairs, self.size
        alive, whole = [], None
        before = iter(state.alive)
        for place, left in zip(before, before):
            place = goto.get(place << 8 | byte)
            if place is None:
                continue
            token = token_at[place]
            if whole is None and token != NONE:
                pair = left * size + token
                fits = pairs.get(pair)
                if fits is None:
                    fits = self.accepts(left, token)
                    if len(pairs) < PAIR_LIMIT:
                        pairs[pair] = fits
                if fits:
                    whole = token
            if goes_on[place]:
                alive += (place, left)
        if whole is None:
            raise ValueError("the ranks leave a text without a valid encoding")
        key = (*alive, 0, whole)
        following = self.states.get(key)
        if following is None:
            following = State(key)
            if len(self.states) >= STATE_LIMIT:
                return following
            self.states[key] = following
        state[byte] = following
        return following

    def settled(self, last: list[int], state: State) -> int:
        """Up to which byte all prefixes that a token may still end behind have the same ids."""
        ends = {len(last) - self.depth[place] for place in state.alive[::2]}
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - self.length[last[end - 1]])
        return ends.pop()

    def emit(self, last: list[int], end: int) -> list[int]:
        """Ids of the prefix that ends at byte ``end``, from the last token of each prefix."""
        out, length = [], self.length
        while end:
            token = last[end - 1]
            out.append(token)
            end -= length[token]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        out, last, state = [], [], self.start
        for lo in range(0, len(piece), EMIT_AFTER):
            if lo:
                end = self.settled(last, state)
                out += self.emit(last, end)
                del last[:end]
            for byte in piece[lo : lo + EMIT_AFTER]:
                following = state.get(byte)
                state = self.move(state, byte) if following is None else following
                last.append(state.last)
        return out + self.emit(last, len(last))

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.encode(piece.encode("utf-8", "surrogatepass")))
        if len(self.pieces) < PIECE_LIMIT:
            self.pieces[piece] = ids
        return ids

    def encode_text(self, text: str | None, pattern: regex.Pattern) -> list[int]:
        """Ids of a text.

        The pattern always begins a match at a space that a character other than white space follows. Where all spaces are such
        ones, the text is cut at them, and the ids of what stands between two of them are kept.
        """
        if not text:
            return []
        known, new = self.pieces.get, self.piece_ids
        if pattern.pattern != public_tokenizers.PATTERN or _LONE_SPACE.search(text):
            return list(chain.from_iterable([known(p) or new(p) for p in pattern.findall(text)]))
        first, *rest = text.split(" ")
        known, new = self.spans.get, self.span_ids
        ids = list(chain.from_iterable([self.piece_ids(p) for p in pattern.findall(first)]))
        ids += chain.from_iterable([known(p) or new(p, pattern) for p in rest])
        return ids

    def span_ids(self, span: str, pattern: regex.Pattern) -> tuple[int, ...]:
        """Ids of a space and what follows it up to the next one. Its first piece, the one with the space, is a span as well."""
        first, *rest = pattern.findall(" " + span)
        if rest:
            known, new = self.pieces.get, self.piece_ids
            word = first[1:]
            ids = tuple(chain(self.spans.get(word) or self.span_ids(word, pattern), *[known(p) or new(p) for p in rest]))
        else:
            ids = tuple(self.encode(first.encode("utf-8", "surrogatepass")))
        if len(self.spans) < SPAN_LIMIT:
            self.spans[span] = ids
        return ids


class Utf8Stream:
    """Incremental UTF-8 decoding: bytes in, text out; a character cut off at the end of a chunk waits for the next one.

    The state is the bytes of an unfinished character, three at most.
    """

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete yet."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 2 if byte >> 5 == 0b110 else 3 if byte >> 4 == 0b1110 else 4 if byte >> 3 == 0b11110 else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data) - self._unfinished(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def decode_bytes(ids: Iterable[int], bytes_of: dict[int, bytes] | list[bytes]) -> bytes:
    return b"".join([bytes_of[i] for i in ids])


def decode_stream(ids: Sequence[int], bytes_of: dict[int, bytes] | list[bytes], step: int = 1) -> Iterator[str]:
    """Text of ids, ``step`` tokens at a time, with every character whole."""
    stream = Utf8Stream()
    for lo in range(0, len(ids), step):
        text = stream.feed(decode_bytes(ids[lo : lo + step], bytes_of))
        if text:
            yield text
    if rest := stream.finish():
        yield rest


_loaded: dict[tuple[str, str], tuple[Transducer, regex.Pattern]] = {}


def _transducer(path: str, pattern: str) -> tuple[Transducer, regex.Pattern]:
    """One transducer per worker process and vocabulary; its tables serve later tasks too."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Transducer(load_ranks(path)), regex.compile(pattern)
    return _loaded[path, pattern]


@contextmanager
def _uncollected() -> Iterator[None]:
    """No garbage collection while a task fills the tables, which hold many objects and no garbage. Afterwards the collector works as before, but for the tables."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        gc.freeze()
        if was_on:
            gc.enable()


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, split = _transducer(path, pattern)
        with _uncollected():
            for batch in batches:
                doc_ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
                for lo, hi in by_bytes(texts):
                    ids = [model.encode_text(t, split) for t in texts[lo:hi]]
                    yield pa.RecordBatch.from_arrays([doc_ids.slice(lo, hi - lo), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def round_trips(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: each text is encoded, and its ids alone are decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, split = _transducer(path, pattern)
        size = max(model.bytes_of) + 1
        bytes_of = [model.bytes_of.get(i, b"") for i in range(size)]
        text_of = [str(i) for i in range(size)]
        def row(text: str | None) -> tuple[int, str, str]:
            ids = model.encode_text(text, split)
            shown, decoded = " ".join([text_of[i] for i in ids]).encode(), hashlib.sha256()
            for part in decode_stream(ids, bytes_of, DECODED):
                decoded.update(part.encode())
            return len(ids), hashlib.sha256(shown).hexdigest(), decoded.hexdigest()

        with _uncollected():
            for batch in batches:
                doc_ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
                for lo, hi in by_bytes(texts):
                    n, ids_digest, decoded_digest = zip(*map(row, texts[lo:hi]))
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(ids_digest), pa.array(decoded_digest)],
                        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                    )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trips(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
