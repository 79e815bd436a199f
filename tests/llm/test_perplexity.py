"""Rules and scores against brute force on small tables; bands on the given documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridlap.llm import asking, perplexity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def brute_entropies(texts):
    """Modified Kneser-Ney with each document's own counts taken out, the discounts and the number of words those of all documents."""
    docs = [[("<begin>", *w)[k : k + 2] for k in range(len(w))] for w in (WORD.findall(t or "") for t in texts)]
    whole = Counter(b for d in docs for b in d)
    n = [sum(1 for c in whole.values() if c == k) for k in range(5)]
    share = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    off = [0.0] + [min(max(k - (k + 1) * share * (n[k + 1] / n[k] if n[k] else 0), 0.1), k - 0.1) for k in (1, 2, 3)]
    vocabulary = len({w for _, w in whole})
    out = []
    for doc in docs:
        rest = Counter(whole)
        rest.subtract(Counter(doc))
        rest = {b: c for b, c in rest.items() if c > 0}
        context, follow, before = Counter(), defaultdict(Counter), Counter()
        for (v, w), c in rest.items():
            context[v] += c
            follow[v][min(c, 3)] += 1
            before[w] += 1
        total = 0.0
        for v, w in doc:
            lowest = (max(before[w] - 0.75, 0) + 0.75 * vocabulary / (vocabulary + 1)) / max(1, len(rest))
            if context[v]:
                c = rest.get((v, w), 0)
                back = sum(off[k] * follow[v][k] for k in (1, 2, 3)) / context[v]
                total += math.log(max(c - off[min(c, 3)], 0) / context[v] + back * lowest)
            else:
                total += math.log(lowest)
        out.append(-total / len(doc) if doc else None)
    return out


EDGES = [None, "", " \n\t ", "one", "a b", "é ü\x1cñ  ö\x0bx", "#* $% <> | &&\n\nx\nx\n x\nx", "s s s s s s", "word\x00word \x85 b"]


def test_scores_equal_brute_force(spark, frame, prose):
    rng = random.Random(5)
    pool = [prose(k, 12) for k in range(12)]
    texts = [rng.choice([" ", "\n"]).join(rng.choice(pool) for _ in range(rng.randint(0, 9))) for _ in range(70)] + EDGES + ["never seen before at all"]
    texts += [texts[0], texts[1], texts[1]]
    rows = [(k if k != 3 else None, t) for k, t in enumerate(texts)] + [(5, "the same id again")]
    texts = [t for _, t in rows]
    found = perplexity.perplexities(frame(rows, extra="n_words").repartition(6)).collect()
    assert len(found) == len(rows)
    true = sorted(zip([r[0] if r[0] is not None else -1 for r in rows], [brute_rules(t)[:5] for t in texts], brute_entropies(texts)), key=str)
    got = sorted(((r.doc_id if r.doc_id is not None else -1, tuple(r[s] for s in perplexity.STATS), r.entropy) for r in found), key=str)
    assert [g[:2] for g in got] == [t[:2] for t in true]
    for g, t in zip(got, true):
        assert g[2] == t[2] if t[2] is None else g[2] == pytest.approx(t[2], rel=1e-9)


def test_documents_are_scored_alike_in_runs_of_any_size(monkeypatch):
    rng = np.random.default_rng(1)
    n_words = [0, 7, 0, 40, 1, 3, 0, 25, 60, 0]
    words = rng.integers(0, 9, sum(n_words))
    own = perplexity.Bigrams(asking.packed_keys(np.arange(5, 14, dtype=np.uint64)), asking.packed(words), n_words)
    total = own.counts + rng.integers(0, 5, len(own.counts))
    sums = np.stack([np.bincount(own.context(), total, own.size)] + [rng.integers(8, 12, own.size) for _ in range(4)], axis=1).astype(np.int64)
    scores = []
    for size in (1, 30, 1 << 19):
        monkeypatch.setattr(perplexity, "SCORED_WORDS", size)
        scores.append(perplexity.document_log_probs(own, total, sums, perplexity.discounts(9, 4, 3, 2), 500, 40))
    assert len(scores[0]) == len(n_words) and (scores[0] == scores[1]).all() and (scores[0] == scores[2]).all()
    assert [s == 0 for s in scores[0]] == [n == 0 for n in n_words]


def test_one_document_and_no_document(spark, frame):
    row = perplexity.perplexities(frame([(1, "a b a b")])).first()
    assert row.entropy == pytest.approx(brute_entropies(["a b a b"])[0])
    assert perplexity.judged(perplexity.perplexities(frame([]))).count() == 0
    alone = perplexity.judged(perplexity.perplexities(frame([(1, None)]))).first()
    assert alone.base_failed and not alone.kept and alone.perplexity is None


def test_rules_on_given_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = perplexity.op11_perplexity_rules(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    whole = [r for r in found if not r.base_failed]
    assert sum(r.kept for r in whole) > 0.97 * len(whole)


def test_text_of_another_kind_is_rejected(spark, prose):
    """Among texts of one kind, made-up words are too unlike them, and one sentence of copies too predictable; each language has its own band."""
    rng = random.Random(8)
    common = prose(1, 300).split()
    usual = [(k, " ".join(rng.choice(common) for _ in range(150)), "en") for k in range(150)]
    other = prose(2, 3000).split()
    wide = [(200 + k, " ".join(rng.choice(other) for _ in range(150)), None) for k in range(60)]
    gibberish = (300, " ".join(f"q{rng.random()}" for _ in range(150)), "en")
    again = " ".join(common[:90])
    copies = [(400 + k, again, "en") for k in range(60)]
    rows = [(*r, 1) for r in [*usual, *wide, gibberish, *copies]]
    found = {r.doc_id: r for r in perplexity.judged(perplexity.perplexities(spark.createDataFrame(rows, "doc_id long, text string, lang string, band int"))).collect()}
    assert all(found[k].kept for k, *_ in [*usual, *wide])
    assert not found[300].kept and found[300].perplexity > found[300].most_perplexity and not found[300].base_failed
    assert all(not found[k].kept and found[k].perplexity < found[k].least_perplexity for k, *_ in copies)


def test_discounts_stay_within_counts():
    assert perplexity.discounts(0, 0, 0, 0).tolist() == pytest.approx([0, 0.9, 1.9, 2.9])
    assert all(0 < d < k for k, d in enumerate(perplexity.discounts(100, 1, 50, 900)[1:], 1))
    assert perplexity.discounts(1000, 300, 140, 80)[1] == pytest.approx(1 - 2 * (1000 / 1600) * 0.3)
