from __future__ import annotations

import random

import numpy as np

from gridlap.llm import buckets
from gridlap.llm import jaccard_join as jj


def brute_force(texts):
    """{doc: (class, links)} by all pairs."""
    docs = list(texts)
    sets = {d: set(t.tolist()) for d, t in zip(docs, jj.token_sets([texts[d] for d in docs]))}
    near = {d: {e for e in docs if e != d and sets[d] and 5 * len(sets[d] & sets[e]) >= 4 * len(sets[d] | sets[e])} for d in docs}
    out = {}
    for d in docs:
        reached, todo = {d}, [d]
        while todo:
            for e in near[todo.pop()] - reached:
                reached.add(e)
                todo.append(e)
        out[d] = (min(reached), len(near[d]))
    return out


def test_same_as_brute_force(frame, prose):
    rng = random.Random(3)
    texts = {k: prose(k, 80) for k in range(60)}
    for k in range(60, 110):  # near copies with a few changed words, some of them below the threshold
        words = texts[rng.randrange(8)].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "changed"
        texts[k] = " ".join(words)
    texts |= {200: "one two three", 201: "one two three", 202: None, 203: "", 204: "!!!", 205: "!!!", 206: texts[0], 207: texts[0].upper()}
    found = {r.doc_id: (r.class_id, r.n_links) for r in jj.jaccard_classes(frame(texts.items())).collect()}
    expected = brute_force(texts)
    assert found == expected
    assert found[201] == (200, 1) and found[205] == (205, 0) and found[207][0] == found[0][0]


def test_large_group_in_blocks(frame, prose, monkeypatch):
    """A bucket of many blocks loses no link; the limits of the tasks' own process cannot be patched, so the group is large instead."""
    rng = random.Random(4)
    base = prose(9, 120).split()
    texts = {}
    for k in range(2 * buckets.BLOCK + 60):
        words = list(base)
        words[rng.randrange(len(words))] = f"w{k}"
        texts[k] = " ".join(words)
    found = {r.doc_id: (r.class_id, r.n_links) for r in jj.jaccard_classes(frame(texts.items())).collect()}
    assert found == {k: (0, len(texts) - 1) for k in texts}


def test_groups_over_the_limit_of_unequal_length(frame, prose):
    """Of the first five texts, no token of theirs was picked on all three levels when a set could pick none: their groups lost every link."""
    rng = random.Random(8)
    texts, expected = {}, {}
    for group, seed in enumerate((95, 477, 2388, 3662, 4506, 1, 2, 3)):
        ids = range(1000 * group, 1000 * group + jj.LIMIT + 20)
        for k in ids:
            texts[k] = prose(seed, 200) + "".join(f" own{k}x{n}" for n in range(rng.randint(0, 20)))
        sets = list(jj.token_sets([texts[k] for k in ids]))
        distinct = {s.tobytes(): set(s.tolist()) for s in sets}
        base = min(distinct.values(), key=len)
        assert all(base <= s and 5 * len(base) >= 4 * (len(base) + 2 * (len(s) - len(base))) for s in distinct.values())  # so all pairs link
        expected |= {k: (ids[0], len(ids) - 1) for k in ids}
    found = {r.doc_id: (r.class_id, r.n_links) for r in jj.jaccard_classes(frame(texts.items())).collect()}
    assert found == expected


def test_every_path_goes_on(prose):
    """Each path of a level has a path below it, for sets of any size, so that a bucket that is split leaves no set behind."""
    for tokens in jj.token_sets([prose(k, 5 + 7 * k) for k in range(60)]):
        first, second, third = jj.chosen_paths(tokens, jj.runs_for(0.99), jj.THRESHOLD)
        assert len(first) >= jj.runs_for(0.99)
        assert {p for p, _ in second} == set(first) and {p for p, _ in third} == {c for _, c in second}


def test_sets_of_unequal_size_meet_on_the_last_level():
    """Sets at the threshold of which the smaller lies in the larger, as if all their buckets were split to the end."""
    rng = np.random.default_rng(6)
    missed = 0
    for _ in range(400):
        tokens = rng.integers(0, 2**64, 200, dtype=np.uint64)
        a, b = (jj.chosen_paths(np.sort(t), jj.runs_for(0.99), jj.THRESHOLD)[2] for t in (tokens, tokens[:160]))
        missed += not {c for _, c in a} & {c for _, c in b}
    assert missed <= 4


def test_repeated_rows_null_ids_and_empty_table(frame, prose):
    text = prose(1, 50)
    rows = jj.jaccard_classes(frame([(4, text), (4, text), (6, text), (None, text)], extra="id")).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1, r.n_links) for r in rows) == [(-1, -1, 0), (4, 4, 1), (4, 4, 1), (6, 4, 1)]
    assert jj.jaccard_classes(frame([])).count() == 0


def test_runs_follow_the_recall():
    assert jj.runs_for(0.5) < jj.runs_for(0.9) < jj.runs_for(0.99)


def test_first_shared_bucket():
    paths = [np.array([1, 5, 9]), np.array([5, 9]), np.array([2, 9])]
    assert buckets.first_shared(paths, 9).tolist() == [[False, False, True], [False, False, True], [True, True, False]]
    assert buckets.first_shared(paths[:2], 5)[0, 1]
