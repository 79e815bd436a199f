from __future__ import annotations

import numpy as np

from gridlap.llm import suffix_dedup as sd


def by_doc(df):
    return {r.doc_id: tuple(r)[1:] for r in df.collect()}


def test_same_as_brute_force(spark, frame, prose):
    passage, other = prose(1, 60), prose(2, 30)
    texts = {k: prose(100 + k, 40 + k) for k in range(20)}
    texts[3] += " " + passage
    texts[7] = passage + " " + texts[7] + other
    texts[9] = texts[7]  # an exact copy
    texts[11] = texts[7][:200] + "x" + texts[7][201:]  # a near copy
    texts[12] = other[10:90] + passage[30:200]
    texts[13] = "ab " * 400  # repeats itself
    texts[14] = "ab " * 300
    texts[15] = None
    texts[16] = ""
    texts[17] = "short"
    texts[18] = passage.replace("ö", "o")[:50]
    texts[19] = passage.replace("ö", "o")[:49]
    texts[2] += passage.replace("ö", "o")
    expected = sd.by_brute_force(texts)
    assert by_doc(sd.removal_digests(frame(texts.items()))) == expected
    assert expected[9][1] == expected[9][0] and expected[18][1] == 50 and expected[19][1] == 0 and expected[13][1] == 0


def test_characters_stay_whole(frame, prose):
    passage = "ö" * 40
    rows = {1: "a" + passage + "b", 2: "é" + passage + "è", 3: "clean"}
    out = by_doc(sd.deduplicated(frame(rows.items())))
    assert out[1][0] == rows[1] and out[3][0] == "clean"
    assert "ö" not in out[2][0] and out[2][0] == "éè"


def test_ties_repeats_and_nulls(frame, prose):
    text = prose(5, 60)
    out = sd.removal_digests(frame([(1, text), (1, text), (2, text), (None, text)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed == r.n_bytes) for r in out) == [
        (False, 1, False), (False, 1, False), (False, 2, True), (True, 0, False),
    ]


def test_each_row_of_a_repeated_id_is_judged_by_its_own_text(frame, prose):
    passage, own = prose(1, 40), prose(2, 12)
    rows = [(1, passage), (2, passage), (2, own), (2, "short"), (2, own + passage), (2, own + passage), (2, None), (3, own + " " + passage[:60])]
    earlier = {2: [passage], 3: [passage, own]}
    out = sd.removal_digests(frame(rows)).collect()
    expected = []
    for doc, text in rows:
        texts = dict(enumerate(earlier.get(doc, []))) | {9: text}
        expected.append((doc, *sd.by_brute_force(texts)[9]))
    assert sorted(tuple(r) for r in out) == sorted(expected)
    assert all(r.n_removed <= r.n_bytes for r in out)


def test_a_text_longer_than_a_batch(frame, prose):
    passage, long = prose(1, 30), prose(3, 400_000)
    texts = {1: long + passage, 2: prose(4, 60_000) + passage + long[1_000_000:1_300_000], 3: passage}
    assert len(long) > sd.BATCH_BYTES
    out = by_doc(sd.removal_digests(frame(texts.items())))
    shared = len(passage.encode()) + len(long[1_000_000:1_300_000].encode())
    assert out[1][1] == 0 and out[3][1] == out[3][0] and shared <= out[2][1] <= shared + 8


def test_empty_table(frame):
    assert sd.removal_digests(frame([])).count() == 0


def test_nearest_smaller():
    rng = np.random.default_rng(1)
    for _ in range(20):
        v = rng.integers(0, 6, 200)
        slow = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(len(v))]
        assert sd.nearest_smaller(v).tolist() == slow


def test_previous_factors_against_all_pairs():
    rng = np.random.default_rng(2)
    rows, docs = rng.integers(0, 2, (120, 9)).astype(np.uint8), rng.integers(0, 12, 120)
    slow = [
        max((int(np.append(rows[i] != rows[j], True).argmax()) for j in range(len(rows)) if docs[j] < docs[i]), default=0) for i in range(len(rows))
    ]
    assert sd.previous_factors(rows, docs).tolist() == slow


def test_every_string_is_in_one_stretch(prose):
    raw = [prose(1, 300).encode(), b"", b"x" * 49, b"y" * 500, prose(2, 10).encode(), b"z" * 50]
    data, begins, starts, counts, least = sd.stretches(raw, 50)
    covered = [s for a, n in zip(starts, counts) for s in range(a, a + n)]
    expected = [b + k for b, r in zip(begins[:-1], raw) for k in range(len(r) - 49)]
    assert covered == expected and counts.max() <= sd.RUN
