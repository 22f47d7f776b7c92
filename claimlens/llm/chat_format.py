r"""Chat formatting with a grammar round trip.

Grammar of the formatted text::

    conversation := turn*
    turn         := "### " ROLE ":\n" TEXT "\n</turn>\n"

``ROLE`` is the role with ``%`` and line ends percent-encoded.  Inside ``TEXT`` a control string (``</turn>``
or ``### word:``) counts as text if a backslash stands before it; the parser takes one backslash away.

A turn is first rendered as it is and reparsed.  If the parser refuses it or recovers another text, its
control strings get one more backslash each and the turn is rendered and reparsed again; a turn that still
differs is an error.  The digests of a conversation are read back from its finished text by the same parser.

Everything is DataFrame functions.  Rows shuffle once, by conversation; one row per conversation comes out,
so a conversation's turns must meet, but nothing else does.

Defined results: null role or text is the empty string; turns are ordered by turn (null first), then role, then text;
repeated rows are repeated turns; null conv_id is one conversation; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, END = "### ", "\n</turn>\n"
CONTROL = r"(### [A-Za-z_]+:|</turn>)"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")


def _header(role: Column) -> Column:
    name = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(OPEN), name, F.lit(":\n"))


def parse(formatted: Column) -> Column:
    """Turns ``array<struct<role, text>>``; a turn that breaks the grammar has null parts."""

    def turn(segment: Column) -> Column:
        head = F.substring_index(segment, "\n", 1)
        body = segment.substr(F.length(head) + 2, F.length(segment))
        valid = head.startswith(OPEN) & head.endswith(":") & F.contains(segment, F.lit("\n")) \
            & ~body.rlike(r"(?<!\\)" + CONTROL)
        name = head.substr(F.lit(len(OPEN) + 1), F.length(head) - len(OPEN) - 1)
        role = F.replace(F.replace(name, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
        return F.struct(F.when(valid, role).alias("role"), F.when(valid, unescape(body)).alias("text"))

    parts = F.split(formatted, END, -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def format_conversations(rows: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans, n_escaped, turns)``, one row per conversation.

    ``loss_spans`` are (start, length) in code points of ``formatted``, one per assistant turn; ``turns``
    are the source turns.
    """
    t = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def render(body: str) -> Column:
        return F.concat(F.col("head"), F.col(body), F.lit(END))

    def recovered(rendered: str) -> Column:
        got = parse(F.col(rendered))
        return (F.size(got) == 1) & F.col("role").eqNullSafe(got[0]["role"]) & F.col("text").eqNullSafe(got[0]["text"])

    t = (t.withColumn("head", _header(F.col("role")))
         .withColumn("plain", render("text"))
         .withColumn("fine", F.when(F.contains("text", F.lit("</turn>")) | F.contains("text", F.lit(OPEN)), recovered("plain"))
                     .otherwise(F.lit(True)))  # a text without either string has nothing to escape
         .withColumn("body", F.when(F.col("fine"), F.col("text")).otherwise(escape(F.col("text"))))
         .withColumn("rendered", render("body"))
         .withColumn("rendered", F.when(F.col("fine") | recovered("rendered"), F.col("rendered"))
                     .otherwise(F.raise_error(F.lit("a turn does not survive the round trip")).cast("string"))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("rendered")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = t.withColumn("n", F.row_number().over(order)).withColumn("start", before + F.length("head"))
    turns = F.array_sort(F.collect_list(F.struct("n", "role", "text", "body", "rendered", "start", (~F.col("fine")).cast("long").alias("esc"))))
    out = t.groupBy("conv_id").agg(turns.alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["role"] == LOSS_ROLE),
                        lambda x: F.struct(x["start"].alias("start"), F.length(x["body"]).alias("length")))
    return out.select(
        "conv_id", F.array_join("t.rendered", "").alias("formatted"), spans.alias("loss_spans"),
        F.aggregate("t.esc", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_escaped"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted text and loss mask alone, and whether the source was recovered."""
    f = formatted.withColumn("got", parse(F.col("formatted")))
    lines = F.array_join(F.transform("got", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    under = F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr(s["start"].cast("int") + 1, s["length"])))
    f = f.withColumn("loss", F.array_join(under, ""))
    return f.select(
        "conv_id", F.size("got").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_escaped",
        F.col("got").eqNullSafe(F.col("turns")).alias("round_trip"))


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, regexp_matches(text, '### [A-Za-z_]+:|</turn>') AS hit,
         length(regexp_replace(text, '(\\*)(### [A-Za-z_]+:|</turn>)', '\\\1\2', 'g')) AS len_escaped,
         length(replace(replace(role, '%', '%25'), chr(10), '%0A')) AS len_role
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + len_role + 2 + len_escaped + 9)::BIGINT AS formatted_chars,
       sum(hit::INT)::BIGINT AS n_escaped, true AS round_trip
FROM e GROUP BY conv_id"""
