from __future__ import annotations

import numpy as np
import pytest

from gridlap.llm import decontaminate as dc
from gridlap.llm.common import hashed_words, shingles


@pytest.fixture
def items(spark, prose):
    rows = [(k, prose(1000 + k, 15 + k)) for k in range(45)] + [(90, None), (91, ""), (92, "too few words"), (93, prose(1003, 18))]
    return spark.createDataFrame([(*r, 7) for r in rows], "item_id long, text string, doc_id int")


def test_planted_items_are_found_and_clean_texts_are_not(spark, frame, items, prose):
    texts = {r.item_id: r.text for r in items.collect()}
    rows = {k: prose(k, 300) for k in range(60)}
    for k in range(0, 30):
        rows[k] = rows[k][:200] + " " + texts[k] + " " + rows[k][200:]
    rows[30] = texts[30]
    rows[31] = texts[31].upper().replace(" ", ", ")
    rows[32] = " ".join(texts[32].split()[2:])  # the first two words are gone
    rows[33] = " ".join(texts[44].split()[:-3]) + " end of it"
    rows[34] = prose(34, 9_000) + " " + texts[34]
    rows |= {50: None, 51: "", 52: "word"}
    found = {(r.doc_id, r.item_id): r.similarity for r in dc.contaminated(frame(rows.items()), items).collect()}
    same = {(k, k): 1.0 for k in [*range(0, 32), 34]} | {(3, 93): 1.0}
    assert {p: s for p, s in found.items() if p in same} == same
    assert set(found) - set(same) == {(32, 32), (33, 44)}


def by_all_windows(texts, items):
    """{(text, item): (similarity, first word, words)} of the best of all windows."""
    words, at = hashed_words(texts)
    own, ends = hashed_words(items)
    out = {}
    for t in range(len(texts)):
        for k in range(len(items)):
            text, item = words[at[t] : at[t + 1]], own[ends[k] : ends[k + 1]]
            for first in range(len(text) - dc.WORDS + 1):
                window = text[first : first + len(item)]
                similarity = dc.weighted_similarity(shingles(window, dc.WORDS), shingles(item, dc.WORDS))
                if similarity >= dc.THRESHOLD - 1e-12 and (similarity, -first) > out.get((t, k), (0, 0))[:2]:
                    out[t, k] = (similarity, -first, len(window))
    return {pair: (similarity, -first, n) for pair, (similarity, first, n) in out.items()}


def test_truncated_items_that_stand_alone(spark, frame, prose):
    """Items of class sizes and others, less some words at the end, at the start, or on both sides, alone or at the end of a text."""
    sizes = (5, 6, 9, 19, 22, 26, 31, 37, 39, 44, 52, 55)
    items = [prose(2000 + n, n) for n in sizes] + ["again and " * 25, prose(2044, 44) + " and more"]
    texts = []
    for item in items:
        words = item.split()
        for cut in range(1, 8):
            texts += [" ".join(w) for w in (words[:-cut], words[cut:], words[cut // 2 : -cut], [*prose(cut, 30).split(), *words[:-cut]])]
    expected = by_all_windows(texts, items)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): (pytest.approx(r.similarity), r.first_word, r.n_words) for r in dc.contaminated(frame(enumerate(texts)), table).collect()}
    assert found == expected and len(expected) > 100


def test_several_passes_agree(frame, items, prose):
    texts = {r.item_id: r.text for r in items.collect()}
    docs = frame([(k, prose(k, 50) + " " + texts[k]) for k in range(10)])
    one = {tuple(r) for r in dc.contaminated(docs, items).collect()}
    assert one == {tuple(r) for r in dc.contaminated(docs, items, items_per_pass=7).collect()} and len(one) == 11


def test_a_repeated_item_is_searched_once_and_answered_each_time(spark, frame, prose):
    rows = [(k, prose(5, 30)) for k in range(40)] + [(7, prose(6, 30)), (None, prose(6, 30))]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = frame([(1, prose(1, 100) + " " + prose(5, 30)), (2, prose(6, 30)), (2, prose(6, 30))])
    found = sorted((r.doc_id, -1 if r.item_id is None else r.item_id) for r in dc.contaminated(docs, items, items_per_pass=1).collect())
    assert found == [(1, k) for k in range(40)] + [(2, -1), (2, -1), (2, 7), (2, 7)]


def test_words_changed_inside_an_item(frame, spark, prose):
    """One or two words replaced, removed or added inside an item, wherever the rest is still similar enough."""
    rng = np.random.default_rng(11)
    items = [prose(3000 + n, n) for n in range(15, 120, 5)]
    texts = []
    for item in items:
        for _ in range(6):
            words = item.split()
            for _ in range(rng.integers(1, 3)):
                at = int(rng.integers(1, len(words) - 1))
                words[at : at + int(rng.integers(0, 2))] = ["changed"] * int(rng.integers(0, 2))
            texts.append(" ".join([prose(len(texts), 20), *words, prose(len(texts) + 500, 20)]))
    expected = by_all_windows(texts, items)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): (pytest.approx(r.similarity), r.first_word, r.n_words) for r in dc.contaminated(frame(enumerate(texts)), table).collect()}
    assert set(found) <= set(expected) and len(expected) > 60
    assert len(found) >= 0.98 * len(expected)


def test_empty_tables(spark, frame, items):
    assert dc.contaminated(frame([]), items).count() == 0
    assert dc.contaminated(frame([(1, "some text of several words here")]), items.limit(0)).count() == 0


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(5)
    items = [rng.integers(0, 2**63, 14).astype(np.uint64) for _ in range(30)]
    index = dc.build_index(items)[14]
    prints = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    near = index.prints[rng.integers(0, len(index.prints), 3000)].copy()
    for k in range(len(near)):  # up to twelve flipped bits
        for bit in rng.choice(64, rng.integers(0, 13), replace=False):
            near[k] ^= np.uint64(1 << int(bit))
    both = np.concatenate([prints, near])
    apart = np.bitwise_count(both[:, None] ^ index.prints[None, :])
    expected = {(int(w), int(f)) for w, f in zip(*np.where(apart <= dc.RADIUS))}
    assert set(zip(*(x.tolist() for x in index.near(both)))) == expected and len(expected) > 2000


def test_weighted_similarity_counts_repeats():
    a, b = (shingles(hashed_words([t])[0], 1) for t in ("x x y", "x y y"))
    assert dc.weighted_similarity(a, b) == pytest.approx(2 / 4)
