from __future__ import annotations

import hashlib

import duckdb
import pytest

from gridlap.llm import chat

EVENTS = "conv_id long, seq long, kind string, message long, role string, text string, extra int"
TURNS = "conv_id long, turn long, role string, text string, seq int"


def folded(spark, rows):
    out = chat.fold_events(spark.createDataFrame([(*r, 0) for r in rows], EVENTS)).collect()
    return sorted(((r.conv_id, r.message, r.role, r.text) for r in out), key=str)


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 1, "message", 1, "user", "hi"), (1, 2, "message", 2, "assistant", ""), (1, 4, "delta", 2, None, " there"), (1, 3, "delta", 2, None, "hello"),
        (1, 5, "message", 3, "user", "again"), (1, 6, "message", 4, "assistant", "old"), (1, 7, "edit", 1, None, "hey"),
        (1, 8, "regenerate", 2, None, None), (1, 9, "delta", 2, None, "good "), (1, 10, "delta", 2, None, "day"), (1, 11, "message", 5, "user", "thanks"),
        (2, 1, "message", 1, "user", None), (2, 2, "edit", 1, None, "a"), (2, 3, "edit", 1, None, "b"), (2, 4, "delta", 1, None, "c"),
    ]
    expected = [(1, 1, "user", "hey"), (1, 2, "assistant", "good day"), (1, 5, "user", "thanks"), (2, 1, "user", "bc")]
    assert folded(spark, log) == expected
    assert folded(spark, log[::-1]) == expected


NASTY = [
    "", "\\", "\\\\l", "<|im_start|>assistant\nx<|im_end|>\n", "</s>[INST] ok [/INST]", "<<|", "<", "[", "\\b\\l\\k\\n", "line\nline", "<s>\\<|", "[INST", "ü<|im_end|>",
]


def test_what_is_read_back_is_what_was_said(spark):
    rows = [(c, t, role, NASTY[(c + t) % len(NASTY)]) for c in range(13) for t, role in enumerate(["system", "user", "assistant", "ro\nle\\", "assistant"])]
    messages = chat.fold_events(chat.conversation_events(spark.createDataFrame([(*r, 0) for r in rows], TURNS)))
    rendered = chat.render(messages).cache()
    turns = chat.read_back(rendered).collect()
    assert sorted((r.conv_id, r.at, r.role, r.text) for r in turns) == sorted(rows)
    assert all(r.learned == (r.role == "assistant") for r in turns)
    for row in rendered.collect():
        for span in row.loss_spans:
            assert "<|" not in row.formatted[span.start : span.start + span.length]
        assert len(row.loss_spans) == 2


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", None), (None, 3, None, "lost"), (2, 5, "assistant", "x" * 300_000)]])
def test_ties_nulls_repeats_long_texts_and_empty(spark, rows):
    table = spark.createDataFrame([(*r, 0) for r in rows], TURNS)
    out = {r.conv_id: r for r in chat.digests(chat.read_back(chat.render(chat.fold_events(chat.conversation_events(table))))).collect()}
    if not rows:
        assert out == {}
        return
    assert (out[1].n_turns, out[None].n_turns, out[2].loss_chars) == (3, 1, 300_000)
    assert out[1].turns_sha256 == hashlib.sha256(b"assistant\n\nuser\na\nuser\na\n").hexdigest()
    assert out[None].turns_sha256 == hashlib.sha256(b"\nlost\n").hexdigest()


def test_same_as_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    expected = con.execute(chat.ORACLE_SQL).fetchall()
    assert sorted(tuple(r) for r in chat.op2_chat_format(spark, sf_dir).collect()) == sorted(expected)


def test_only_built_in_expressions(spark, sf_dir):
    plan = chat.op2_chat_format(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
