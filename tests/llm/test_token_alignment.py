"""Alignment against a brute-force search of overlaps, groups and counts, with the libraries' own encoders."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gridlap.llm import token_alignment as T

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FAST = T.Tokenizers(JSON, MODEL, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(JSON)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=MODEL), *FAST.open()


def brute(rows, libraries):
    """Answers by comparing all tokens of a text with each other."""
    model_a, model_b, first, second = libraries
    docs, holders = [], defaultdict(set)
    for k, (_, text) in enumerate(rows):
        a = model_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model_b.encode(text) if text else []
        sides = []
        for ids, pieces in ((a, first.pieces), (b, second.pieces)):
            at, spans = 0, []
            for i in ids:
                spans.append((at, at + len(pieces[i]), i))
                at += len(pieces[i])
            sides.append(spans)
        if b"".join(first.pieces[i] for i in a) != (" " + (text or "")).encode() or b"".join(second.pieces[i] for i in b) != (" " + (text or "")).encode():
            sides = [[], []]
        links = [(x[2], y[2]) for x in sides[0] for y in sides[1] if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in sides[0]} & {y[1] for y in sides[1]})
        groups = [
            ",".join(str(x[2]) for x in sides[0] if lo < x[1] <= hi) + "|" + ",".join(str(y[2]) for y in sides[1] if lo < y[1] <= hi) for lo, hi in zip([0, *cuts], cuts)
        ]
        docs.append((sides, links, groups))
        for pair in set(links):
            holders[pair].add(k)
    highest = Counter()
    for (x, _), held in holders.items():
        highest[x] = max(highest[x], len(held))
    out = []
    for (doc_id, _), (sides, links, groups) in zip(rows, docs):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(len(holders[p]) == highest[p[0]] for p in links)
        out.append((doc_id, len(sides[0]), len(sides[1]), len(groups), len(links), best, sum(len(holders[p]) for p in links), digest))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


ODD = [
    (900, None), (901, ""), (902, " "), (903, "\n\n\t  x  "), (904, "<|endoftext|> </s> <unk> <s>"), (905, "日本語のテキスト and Ελληνικά"), (906, "😀😃 é ▁x▁"),
    (907, "ﬁne № ½ ＡＢＣ"), (908, "a" * 700), (909, "1234567890 " * 9), (910, "\x00\x01 \x85 ​﻿"), (911, "<0x41> <0x0A>"), (None, "no id here"), (5, "again"), (5, "again"),
]


def test_rows_equal_brute_force(spark, frame, prose, libraries):
    rng = random.Random(1)
    rows = [(k, prose(k % 20, rng.choice([1, 3, 25, 60])) + rng.choice(["", ".\n", " isn't it?", " £5"])) for k in range(60)] + ODD
    assert rows_of(T.alignments(frame(rows, extra="block").repartition(5), FAST)) == brute(rows, libraries)


def test_query_on_given_rows(spark, frame, sf_dir, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 1200]
    assert len(rows) > 50
    assert rows_of(T.alignments(frame(rows), FAST)) == brute(rows, libraries)
    whole = rows_of(T.op13_token_alignment(spark, sf_dir))
    assert len(whole) == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and all(r[3] <= min(r[1], r[2]) and r[5] <= r[4] for r in whole)


def test_ranks_give_the_ids_of_the_tokenizer_file(spark, sf_dir, libraries):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + [t for _, t in ODD]
    texts += ["".join(chr(c) for c in range(lo, lo + 16)) for lo in range(0, 0x250, 16)] + [f"a{chr(c)}b {chr(c)} 1{chr(c)}" for c in range(0x250)]
    texts = [t for t in texts if t]
    assert libraries[2].encode(texts) == [libraries[0].encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert T.ByteLevel(JSON).encode(texts[:40]) == libraries[2].encode(texts[:40])


@pytest.mark.parametrize("seed", range(20))
def test_pointer_jumping_equals_common_boundaries(seed):
    rng = np.random.default_rng(seed)
    total = int(rng.integers(1, 400))
    cut = lambda: np.append(np.sort(rng.choice(np.arange(1, total), size=int(rng.integers(0, total)), replace=False)) if total > 1 else [], total).astype(np.int64)
    a, b = cut(), cut()
    common = np.intersect1d(a, b)
    last = np.searchsorted(a, common)
    first, second = T.groups_by_jumping(a, b)
    assert (first == last[np.searchsorted(common, a)]).all() and (second == last[np.searchsorted(common, b)]).all()


def test_long_texts_groups_and_an_empty_table(spark, frame, prose, libraries):
    long = prose(9, 60_000)
    assert len(long) > T.ENCODE_BYTES // 4
    rows = [(1, long), (2, "short one"), (3, None)]
    found = {r.doc_id: r.groups for r in T.alignment_groups(frame(rows, extra="groups"), FAST).collect()}
    digests = {r[0]: r[7] for r in rows_of(T.alignments(frame(rows, extra="groups"), FAST))}
    assert found[3] == "" == digests[3] and all(digests[k] == hashlib.sha256(found[k].encode()).hexdigest() for k in (1, 2))
    assert T.alignments(frame([]), FAST).count() == 0 and T.alignment_groups(frame([]), FAST).count() == 0
    assert rows_of(T.alignments(frame([(1, None)]), FAST)) == [(1, 0, 0, 0, 0, 0, 0, "")]
