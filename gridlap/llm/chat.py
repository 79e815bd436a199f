"""Chat formatting: event logs are folded into final messages, rendered with a template, and read back.

Events (conv_id, seq, kind, message, role, text) of one conversation are taken in the order of ``seq``. ``message`` starts a message with
its text; ``delta`` adds to a message; ``edit`` replaces its text; ``regenerate`` replaces its text by what follows and takes back all
messages with a higher number that were started before it. The last reset of a message decides, and the deltas after it are added in order.

The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles the first character of each control string is
written as a backslash and a letter, and a backslash as a backslash and ``b``. No second character is a backslash, so plain
replacements undo it, and no text can hold a mark.

Edge cases: a null text or role is the empty one; events of equal ``seq`` are taken in the order of kind, role and text; repeated rows of a
table of turns are messages of their own; a null turn comes first; a null conv_id is a conversation like others; an empty table gives an empty
result; extra columns are ignored. One conversation becomes one row, as the output asks, so it must fit in a string (2 GB).
Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlap.llm.common import stage

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
# Control strings of this and of other common templates, and how their first character is written.
ESCAPES = {"<|": "\\l|", "</s>": "\\l/s>", "<s>": "\\ls>", "[INST]": "\\kINST]", "[/INST]": "\\k/INST]"}


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for control, written in ESCAPES.items():
        out = F.replace(out, F.lit(control), F.lit(written))
    return out


def unescape(text: Column) -> Column:
    for written, char in (("\\l", "<"), ("\\k", "["), ("\\n", "\n"), ("\\b", "\\")):
        text = F.replace(text, F.lit(written), F.lit(char))
    return text


def escape_role(role: Column) -> Column:
    """A role stands on a line of its own, so its line ends are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text)."""
    rows = events.select(
        "conv_id", "seq", "kind", "message", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    per_message = rows.groupBy("conv_id", "message").agg(
        F.min("seq").alias("started"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.max(F.when(F.col("kind") == "message", F.struct("seq", "role"))).alias("opening"),
        F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    standing = per_message.withColumn("taken_back", F.max("regenerated").over(before)).where("taken_back IS NULL OR started > taken_back")
    reset = F.coalesce(F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i))), F.lit(0))
    return standing.withColumn("reset", reset).select(
        "conv_id", "message", F.coalesce(F.col("opening")["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(F.slice("log", F.col("reset") + 1, F.size("log")), lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, and loss_spans: array of (start, length) in code points of the escaped texts that are learned."""
    head = F.concat(F.lit(TURN_START), escape_role(F.col("role")), F.lit("\n"))
    turns = messages.select("conv_id", "message", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    turns = turns.withColumn("shown", F.concat("head", "body", F.lit(TURN_END + "\n")))
    so_far = F.sum(F.char_length("shown")).over(Window.partitionBy("conv_id").orderBy("message"))
    turns = turns.withColumn("start", so_far - F.char_length("body") - (len(TURN_END) + 1))
    span = F.struct("start", F.char_length("body").cast("long").alias("length"))
    grouped = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("message", "shown"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("role") == LEARNED_ROLE, span))).alias("loss_spans"),
    )
    return grouped.select("conv_id", F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns of rendered rows: conv_id, at, role, text, learned (the place of the text is a span of the loss mask), formatted_chars."""
    sections = F.split("formatted", r"<\|im_start\|>")
    sections = F.slice(sections, 2, F.size(sections))  # nothing stands before the first mark
    turns = formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), F.posexplode(sections).alias("at", "section"))
    so_far = F.sum(F.char_length("section") + len(TURN_START)).over(Window.partitionBy("conv_id").orderBy("at"))
    role = F.substring_index("section", "\n", 1)
    length = F.char_length("section") - F.char_length(role) - (len(TURN_END) + 2)
    placed = turns.select(
        "conv_id", "at", "formatted_chars", unescape(role).alias("role"),
        unescape(F.substring(F.col("section"), F.char_length(role) + 2, length)).alias("text"),
        (so_far - length - (len(TURN_END) + 1)).alias("start"), length.cast("long").alias("length"),
    )
    spans = formatted.select(F.col("conv_id").alias("span_conv"), F.explode("loss_spans").alias("span"))
    spans = spans.select("span_conv", F.col("span.start").alias("span_start"), F.col("span.length").alias("span_length"))
    same = F.col("conv_id").eqNullSafe(F.col("span_conv")) & (F.col("start") == F.col("span_start")) & (F.col("length") == F.col("span_length"))
    return placed.join(spans, same, "left").select(
        "conv_id", "at", "role", "text", F.col("span_start").isNotNull().alias("learned"), "formatted_chars"
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as events: each row opens a message, and its text streams in after it."""
    order = Window.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("message", F.row_number().over(order).cast("long"))
    none = F.lit(None).cast("string")
    opening = F.struct((F.col("message") * 2).alias("seq"), F.lit("message").alias("kind"), F.col("role").alias("role"), none.alias("text"))
    delta = F.struct((F.col("message") * 2 + 1).alias("seq"), F.lit("delta").alias("kind"), none.alias("role"), F.col("text").alias("text"))
    events = rows.select("conv_id", "message", F.explode(F.array(opening, delta)).alias("e"))
    return events.select("conv_id", "e.seq", "e.kind", "message", "e.role", "e.text")


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of what was read back."""
    grouped = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "role", "text", "learned"))).alias("turns"), F.max("formatted_chars").alias("formatted_chars")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: t["text"]), "")
    return grouped.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars",
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings only, through the log, the fold, the template and back from the written output."""
    probe = "</s>[INST] ok [/INST]"
    added = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{probe}'), (-1L, 1L, 'assistant', '{probe}') AS t(conv_id, turn, role, text)")
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").union(added)
    output = stage(render(fold_events(conversation_events(table))), "chat")
    return digests(read_back(output))


def _sql_escape(text: str) -> str:
    out = f"replace({text}, '\\', '\\b')"
    for control, written in ESCAPES.items():
        out = f"replace({out}, '{control}', '{written}')"
    return out


ORACLE_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), marked AS (
  SELECT *, '{TURN_START}' || replace({_sql_escape("role")}, chr(10), '\\n') || chr(10) || {_sql_escape("text")} || '{TURN_END}' || chr(10) AS shown FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{LEARNED_ROLE}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LEARNED_ROLE}'), '')) AS loss_sha256,
  sum(length(shown))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
