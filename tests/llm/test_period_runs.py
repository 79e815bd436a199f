"""Runs against a brute-force search of all periods and starts."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from gridlap.llm import period_runs


def brute_runs(words, least=24, times=3):
    """Every maximal stretch of equal words a period apart, whose period is its smallest."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                part = words[i : j + q]
                if not any(all(part[k] == part[k + p] for k in range(len(part) - p)) for p in range(1, q)):
                    found.append((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_changed(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def runs_of(texts):
    return [sorted(zip(s, n, p)) for s, n, p, _ in period_runs.word_runs([[w.encode() for w in t] for t in texts])]


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        text = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.randint(0, 3)
            unit = [rng.choice("ab" if kind else "abcdefgh") for _ in range(rng.randint(1, 14))]
            text += unit * rng.randint(1, 30 if len(unit) < 4 else 6) + unit[: rng.randint(0, len(unit))]
        texts.append(text[: rng.randint(0, 160)])
    assert runs_of(texts) == [sorted(brute_runs(t)) for t in texts]


def test_runs_end_at_their_text():
    """Equal neighbouring texts, one-word texts and runs that overlap or lie in each other."""
    inner = ["a"] * 24 + ["b"]
    texts = [["x", "y"] * 12, ["x", "y"] * 12, ["x", "y"] * 11, [], ["z"] * 24, ["z"] * 23, inner * 4, (["p"] * 30) + (["p", "q"] * 15)]
    assert runs_of(texts) == [sorted(brute_runs(t)) for t in texts]
    assert runs_of([inner * 4])[0] == [(0, 24, 1), (0, 100, 25), (25, 24, 1), (50, 24, 1), (75, 24, 1)]


def test_long_text_in_bounded_time():
    unit = [str(k) for k in range(40_000)]
    assert runs_of([unit * 3 + ["end"]])[0] == [(0, 120_000, 40_000)]
    assert runs_of([["a"] * 300_000])[0] == [(0, 300_000, 1)]


def test_changed_words():
    words = [str(k).encode() for k in range(97)]
    changed = [i for i in range(400) if period_runs.repeated(words, i) != words]
    assert changed and all(period_runs.repeated(words, i) == brute_changed(words, i) for i in range(400))
    assert period_runs.repeated([], 8) == [] and period_runs.repeated(words, None) == words


def expected(doc_id, text):
    words = brute_changed([w for w in (text or "").encode().split()], doc_id) if doc_id is not None else (text or "").encode().split()
    found = brute_runs(words)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
    told = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_query_equals_brute_force(spark, frame, prose, tmp_path):
    rng = random.Random(3)
    rows = [(k, prose(k % 40, rng.choice([0, 1, 20, 60, 200]))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n\x0b\x0c\r"), (203, "ö ö " * 40), (None, "a b " * 20), (7, rows[7][1]), (7, "other " * 30), (204, "a\x1cb c d " * 12)]
    frame(rows, extra="start").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(period_runs.op12_period_runs(spark, str(tmp_path))) == sorted((expected(*r) for r in rows), key=str)


def test_query_on_given_rows(spark, sf_dir):
    small = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 2500]
    true = sorted((expected(r.doc_id, r.text) for r in small), key=str)
    ids = {r.doc_id for r in small}
    assert [r for r in rows_of(period_runs.op12_period_runs(spark, sf_dir)) if r[0] in ids] == true
    assert any(r[1] for r in true)


def test_operator_collapses_and_takes_an_empty_table(spark, frame, tmp_path):
    row = period_runs.periodic_runs(frame([(1, "x " + "a b c " * 9 + "y")], extra="n_words")).first()
    assert (row.starts, row.lengths, row.periods, row.collapsed) == ([1], [27], [3], "x a b c y")
    assert period_runs.periodic_runs(frame([])).count() == 0
    frame([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert period_runs.op12_period_runs(spark, str(tmp_path)).count() == 0
    starts, lengths, periods = period_runs.find_runs(np.zeros(0, dtype=np.int64), np.array([0]))
    assert len(starts) == len(lengths) == len(periods) == 0
