"""Token counts, quality and language."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridlap.llm import language_id, quality, token_counts
from gridlap.llm.common import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def counts(df):
    return sorted(((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()))


def test_cache_is_used_and_filled(spark, frame, prose):
    cache, model = new_folder(spark, "test-cache"), Tokenizer.from_file(PATH)
    rows = [(1, prose(1, 30)), (2, prose(1, 30)), (3, None), (4, ""), (5, "<|endoftext|> ok"), (6, prose(6, 4_000)), (None, "é" * 10)]
    true = sorted((i or -1, len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False)), len(model.encode(t or "").ids) > 1024) for i, t in rows)
    assert counts(token_counts.cached_counts(frame(rows, extra="n_tokens"), PATH, cache)) == true
    stored = spark.read.parquet(cache)
    assert stored.count() == 5
    # A stored count wins, so nothing is encoded twice: change one and see it come back.
    other = new_folder(spark, "test-cache")
    stored.withColumn("n_tokens", token_counts.F.col("n_tokens") + 7).write.parquet(other)
    again = counts(token_counts.cached_counts(frame([*rows, (9, "a new one")]), PATH, other))
    assert [r[2] - 7 for r in again if r[0] != 9] == [r[2] for r in true]
    assert spark.read.parquet(other).count() == 6
    # Counts of another tokenizer version are not met.
    versioned = new_folder(spark, "test-cache")
    stored.withColumn("tokenizer_digest", token_counts.F.lit("old")).withColumn("n_tokens", token_counts.F.lit(0).cast("long")).write.parquet(versioned)
    assert counts(token_counts.cached_counts(frame(rows), PATH, versioned)) == true


def test_ranks_count_as_the_library(spark, sf_dir):
    plain, fast = token_counts._encoder(PATH), token_counts._encoder(PATH, token_counts.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
    end = "<|endoftext|>"
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["", end, f"a{end}", f" {end} b", f"{end}{end}x\n", f"a {end}  {end} ", "<|endof", "日本語 and Ελλ", "😀é", "a" * 900, "  \n\n  x", "1234567 it's I'LL"]
    texts += ["".join(chr(c) for c in range(lo, lo + 16)) for lo in range(0, 0x250, 16)] + [f"a{chr(c)}b {chr(c)} 1{chr(c)}" for c in range(0x250)]
    assert fast(texts) == plain(texts)


def test_counts_of_an_empty_table(spark, frame):
    cache = new_folder(spark, "test-cache")
    assert token_counts.cached_counts(frame([]), PATH, cache).count() == 0
    assert token_counts.cached_counts(frame([(1, "x")]), PATH, cache).count() == 1


def test_quality_on_held_out_rows(spark, sf_dir):
    found = quality.op5_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rows = found.where("held_out").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    assert sum(good) / len(good) > 0.9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_edge_cases(spark, frame, prose):
    labels = spark.createDataFrame([(k, k % 2, 0, 1) for k in range(40)] + [(None, 1, 0, 1), (3, None, 0, 1), (5, 9, 0, 1)], "doc_id long, quality int, toxic int, text int")
    docs = frame([(k, prose(k, 40) if k % 2 else "BUY!! NOW!! " * 30) for k in range(40)] + [(50, None), (51, ""), (52, prose(1, 9_000)), (53, "$"), (None, "x")])
    model = quality.fit(docs, labels)
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(scores) == 45 and all(0 <= s <= 1 for s in scores.values())
    assert min(scores[k] for k in range(1, 40, 2)) > max(scores[k] for k in range(0, 40, 2)) and scores[50] == scores[51]
    assert quality.score(frame([]), model).count() == 0
    plain = quality.fit(docs, labels.where("quality = 1"))
    assert {round(r.score, 3) for r in quality.score(docs, plain).collect()} == {1.0}
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}


ENGLISH = "the quick brown fox jumps over the lazy dog and then runs away from all the other animals in this wood "
GERMAN = "der schnelle braune fuchs springt über den faulen hund und läuft dann vor allen anderen tieren in diesem wald davon "


@pytest.fixture
def learned(spark):
    rows = [(ENGLISH * 5, "en", 1)] * 5 + [(GERMAN * 5, "de", 1)] * 5 + [(None, "fr", 1), (GERMAN, None, 1)]
    return language_id.learn(spark.createDataFrame(rows, "text string, lang string, bucket int"))


def test_mixtures(frame, learned):
    assert learned[0] == ["de", "en"]
    docs = [(1, ENGLISH), (2, GERMAN), (3, ENGLISH * 6 + GERMAN * 3), (4, None), (5, ""), (6, "12 34 !!"), (7, ENGLISH * 900), (8, "ENGLISH: " + ENGLISH.upper())]
    found = {r.doc_id: r for r in language_id.predict(frame(docs, extra="lang_pred"), *learned).collect()}
    assert [found[k].lang_pred for k in (1, 2, 4, 5, 6, 7, 8)] == ["en", "de", "und", "und", "und", "en", "en"]
    assert found[3].lang_pred == "en" and found[3].langs == ["en", "de"] and 0.5 < found[3].score < 0.8
    assert [found[k].score for k in (1, 4)] == [1.0, 0.0]


def test_nothing_learned_and_empty_table(spark, frame, learned):
    nothing = language_id.learn(spark.createDataFrame([], "text string, lang string"))
    assert [r.lang_pred for r in language_id.predict(frame([(1, ENGLISH)]), *nothing).collect()] == ["und"]
    assert language_id.predict(frame([]), *learned).count() == 0


def test_language_on_held_out_rows(spark, sf_dir):
    found = language_id.op4_language_id(spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9
