"""Chat formatting by prefix-target expansion, in DataFrame functions throughout.

Every assistant turn becomes an example of its own: all preceding turns are
context, and only that reply is trainable. A conversation that does not end with
the assistant gives one more example, of all its turns, with nothing trainable.

Template: a turn of the assistant is its text and ``</s>``; any other turn is
``[INST] role``, a newline, its text and `` [/INST]``. Control strings inside texts
get a backslash after their first character (one more where backslashes stand
there already), which undoes exactly; roles are percent-encoded.

An example has to hold its whole context, so a conversation's turns meet in one
row by nature; nothing larger than one conversation is gathered anywhere.

Defined cases: null texts and roles count as empty; rows are ordered by turn,
role and text, a null turn first, and equal rows stay as turns of their own; rows
without a conv_id form one conversation; an empty table gives no examples;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings, and the pattern that finds them with any backslashes put in.
BEGIN, END, STOP = "[INST] ", " [/INST]", "</s>"
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_CONTROL_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
_TURNS = r"(?s)\[INST\] .*? \[/INST\]|.*?</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL_ESCAPED, "$1$2$3")


def prefix_targets(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text): conv_id, example (from 0),
    formatted, loss_start, loss_chars (code points of ``formatted``), trainable."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = escape(text)
    own = role == "assistant"
    piece = F.when(own, F.concat(body, F.lit(STOP))).otherwise(F.concat(F.lit(BEGIN), F.url_encode(role), F.lit("\n"), body, F.lit(END)))
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text"), piece.alias("piece")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    n = F.size("t")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: (F.element_at("t", i)["role"] == "assistant") | (i == n))
    each = conv.select("conv_id", "t", F.posexplode(ends).alias("example", "k"))
    pieces = F.transform(F.slice("t", 1, F.col("k") - 1), lambda x: x["piece"])
    each = each.select("conv_id", "example", F.array_join(pieces, "").alias("context"), F.element_at("t", F.col("k")).alias("last"))
    trainable = F.col("last.role") == "assistant"
    return each.select(
        "conv_id", "example", F.concat("context", "last.piece").alias("formatted"),
        F.length("context").cast("long").alias("loss_start"),
        F.when(trainable, F.length("last.piece") - len(STOP)).otherwise(0).cast("long").alias("loss_chars"), trainable.alias("trainable"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted example: array of struct(role, text)."""

    def turn(p: Column) -> Column:
        line = F.instr(p, "\n")
        other = F.struct(F.url_decode(F.substring(p, F.lit(len(BEGIN) + 1), line - len(BEGIN) - 1)).alias("role"), unescape(F.substring(p, line + 1, F.length(p) - line - len(END))).alias("text"))
        own = F.struct(F.lit("assistant").alias("role"), unescape(F.substring(p, F.lit(1), F.length(p) - len(STOP))).alias("text"))
        return F.when(F.startswith(p, F.lit(BEGIN)), other).otherwise(own)

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURNS), F.lit(0)), turn)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. The longest example has all turns."""
    loss = unescape(F.expr("substring(formatted, int(loss_start) + 1, int(loss_chars))"))
    conv = examples.select("conv_id", "example", "formatted", F.when(F.col("trainable"), loss).otherwise("").alias("loss"))
    conv = conv.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("all"), F.sum(F.length("formatted")).alias("formatted_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
    )
    conv = conv.withColumn("turns", parse(F.col("all")))
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return conv.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, CASE role WHEN 'assistant' THEN 4 ELSE 16 + length(role) END + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) AS n,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS is_last
  FROM turns
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM sized
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR is_last)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""
