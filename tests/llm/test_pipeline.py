from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
from gridlap.llm import byte_bpe, decontaminate, jaccard_join, quality, suffix_dedup


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage of the pipeline returns on the small tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, sf_dir), "test")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_names(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[:5])


def test_quality_stage(spark, sf_dir, stages):
    before, after = texts(stages[0]), texts(stages[1])
    model = quality.fit(stages[0], spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_fold=(0, 5))
    scores = {r.doc_id: r.score for r in quality.score(stages[0], model).collect()}
    assert set(after) == {d for d, t in before.items() if not t or scores[d] >= quality.THRESHOLD}


def test_classes_stage(stages):
    before, after = texts(stages[1]), texts(stages[2])
    sets = {d: set(s.tolist()) for d, s in zip(before, jaccard_join.token_sets(list(before.values())))}
    near = {d: {e for e in before if e != d and sets[d] and 5 * len(sets[d] & sets[e]) >= 4 * len(sets[d] | sets[e])} for d in before}
    kept, seen = set(), set()
    for d in sorted(before):
        if d not in seen:
            kept.add(d)
            todo = [d]
            while todo:
                e = todo.pop()
                if e not in seen:
                    seen.add(e)
                    todo += near[e]
    assert set(after) == kept


def test_passages_stage(stages):
    before, after = texts(stages[2]), texts(stages[3])
    true = suffix_dedup.by_brute_force(before)
    for d, text in before.items():
        if true[d][1] == 0:
            assert after[d] == text
        elif true[d][1] == true[d][0]:
            assert d not in after
        else:
            assert len(text.encode()) - true[d][1] <= len(after[d].encode()) < len(text.encode())
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_leaks_stage(spark, sf_dir, stages):
    before, after = texts(stages[3]), texts(stages[4])
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = {d for d, t in before.items() if any(i in t for i in items)}
    hits = {r.doc_id for r in decontaminate.contaminated(stages[3], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert leaking <= hits and set(after) == set(before) - hits


def test_token_stage(stages):
    before = texts(stages[4])
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={}
    )
    assert {r.doc_id: list(r.ids) for r in stages[5].collect()} == {d: library.encode_ordinary(t) for d, t in before.items()}


def test_registered():
    assert {"pipeline", *(f"op{n}_" for n in range(1, 14))} == {q if q == "pipeline" else q.split("_")[0] + "_" for q in entry.queries() if q == "pipeline" or q.startswith("op")}


def test_edge_cases(spark, sf_dir, frame, prose):
    """Nulls, empty texts, repeated rows and an extra column pass through every stage."""
    docs = frame([(1, None), (2, ""), (3, prose(1, 80)), (3, prose(1, 80)), (4, prose(1, 80)), (None, prose(2, 50)), (5, "x")], extra="kept")
    for _, step in corpus_pipeline.STAGES[1:4]:
        docs = corpus_pipeline.stage(step(spark, docs, sf_dir), "test-edge")
        assert docs.columns == corpus_pipeline.COLUMNS
    assert sorted((r.doc_id or -1) for r in docs.collect()) == [-1, 1, 2, 3, 5]
    assert corpus_pipeline.token_ids(spark, docs, sf_dir).count() == 5


def test_empty_documents(spark, sf_dir, frame):
    docs = frame([])
    for _, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, sf_dir), "test-empty")
        assert docs.count() == 0
