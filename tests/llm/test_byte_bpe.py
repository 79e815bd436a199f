from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gridlap.llm import byte_bpe as bb

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def model():
    return bb.Transducer(bb.load_ranks(PATH))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bb.load_ranks(PATH), special_tokens={})


@settings(max_examples=400, deadline=None)
@given(text=st.text(max_size=40) | st.lists(st.sampled_from(["a", "the", "ing", "Ö", "日本", "😀", " ", "  ", "\n", "12", "'s", "!!", "=", "\x00", "é"]), max_size=20).map("".join))
def test_same_ids_as_the_library(model, library, text):
    text = text.encode("utf-8", "replace").decode()
    ids = model.encode_text(text, regex.compile(PATTERN))
    assert ids == library.encode_ordinary(text)
    assert bb.decode_bytes(ids, model.bytes_of) == text.encode()
    assert "".join(bb.decode_stream(ids, model.bytes_of)) == text


def test_full_tables_change_nothing(library, prose, monkeypatch):
    monkeypatch.setattr(bb, "STATE_LIMIT", 20)
    monkeypatch.setattr(bb, "PIECE_LIMIT", 10)
    small, text = bb.Transducer(bb.load_ranks(PATH)), prose(3, 300)
    assert small.encode_text(text, regex.compile(PATTERN)) == library.encode_ordinary(text)
    assert len(small.states) <= 20 and len(small.pieces) <= 10


def test_every_byte_of_a_piece_goes_through_the_transducer(library, prose, monkeypatch):
    """Also when no state can be kept: then each byte is a move of its own."""
    for limit in ("PIECE_LIMIT", "SPAN_LIMIT", "PAIR_LIMIT"):
        monkeypatch.setattr(bb, limit, 0, raising=False)
    monkeypatch.setattr(bb, "STATE_LIMIT", 1)
    small, text, moves = bb.Transducer(bb.load_ranks(PATH)), prose(6, 400) + " don't 'll, (naïve) 's\n x", []
    monkeypatch.setattr(small, "move", lambda state, byte: moves.append(byte) or bb.Transducer.move(small, state, byte))
    pieces = [p.encode() for p in regex.findall(PATTERN, text)]
    for piece in pieces:
        assert small.encode(piece) == library.encode_ordinary(piece.decode())
    assert bytes(moves) == b"".join(p for p in pieces if p not in small.ranks)
    assert small.encode_text(text, regex.compile(PATTERN)) == library.encode_ordinary(text)


def test_rare_words_share_states(model, prose):
    """States know only what longer tokens may still need: 26,100 words need fewer than two each, and they fit the table."""
    fresh = bb.Transducer(model.ranks)
    for word in set(prose(7, 40_000).split()):
        fresh.encode(b" " + word.encode())
    assert len(fresh.states) < min(50_000, bb.STATE_LIMIT)


@pytest.mark.parametrize("block", [1, 8, 50])
def test_long_pieces_are_emitted_as_they_go(library, prose, monkeypatch, block):
    monkeypatch.setattr(bb, "EMIT_AFTER", block)
    own, waiting = bb.Transducer(bb.load_ranks(PATH)), []
    monkeypatch.setattr(own, "settled", lambda last, state: waiting.append(len(last)) or bb.Transducer.settled(own, last, state))
    for piece in (prose(8, 300).replace(" ", ""), "ÃÂ" * 300, "a" * 1000, "日本語" * 99, "=" * 300, " " * 300, "0123456789" * 40):
        assert own.encode(piece.encode()) == library.encode_ordinary(piece)
    assert max(waiting) <= block + 2 * max(own.length)


def test_all_tokens_of_the_vocabulary(model, library):
    for token, rank in bb.load_ranks(PATH).items():
        assert model.encode(token) == [rank]


@given(data=st.binary(max_size=30), cuts=st.lists(st.integers(0, 30), max_size=6))
def test_stream_gives_whole_characters(data, cuts):
    edges = [0, *sorted(min(c, len(data)) for c in cuts), len(data)]
    stream = bb.Utf8Stream()
    parts = [stream.feed(data[a:b]) for a, b in zip(edges, edges[1:])] + [stream.finish()]
    try:
        assert "".join(parts) == data.decode()
    except UnicodeDecodeError:
        assert len(stream.waiting) == 0


@pytest.mark.parametrize("step", [1, 2, 7])
def test_characters_cut_between_steps(model, library, step):
    text = "日本語 😀😃 ö\u0301 𝔘𝔫𝔦 ꙮ" * 9
    ids = library.encode_ordinary(text)
    parts = list(bb.decode_stream(ids, model.bytes_of, step))
    assert "".join(parts) == text and "\ufffd" not in "".join(parts)


def test_the_collector_is_on_again_after_a_task():
    import gc

    assert gc.isenabled()
    with bb._uncollected():
        assert not gc.isenabled()
    assert gc.isenabled()


def test_rows(frame, library, prose):
    rows = [(1, None), (2, ""), (3, "  two  spaces \n\n end "), (4, prose(4, 5_000)), (4, prose(4, 5_000)), (None, "<|endoftext|>")]
    out = bb.round_trips(frame(rows, extra="ids"), PATH, PATTERN).collect()
    for row, (doc_id, text) in zip(sorted(out, key=lambda r: (r.doc_id or 9, r.n_tokens)), sorted(rows, key=lambda r: (r[0] or 9, len(r[1] or "")))):
        ids = library.encode_ordinary(text or "")
        assert tuple(row) == (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert bb.round_trips(frame([]), PATH, PATTERN).count() == 0
