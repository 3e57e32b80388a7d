r"""Chat formatting by a grammar that is read back.

    conversation = turn*
    turn         = "### " role ": " text "</turn>" line-end

Neither role nor text may hold ``###`` or ``</turn>``, the role no ``:``; a backslash makes the
next character plain. Each turn is first written as it is and reparsed; a turn that does not come
back as it was, or holds a control string, is written again with its conflicting strings escaped.
The whole conversation is then reparsed and compared with its source, and written with every
turn escaped should it still differ (``identical`` says if the result is).

Loss is taken on the texts of assistant turns. ``format_conversations`` gives the formatted text
and the mask as spans (start from 0, length) of it, in code points.

Everything is DataFrame functions. A conversation is one row of the result, so it has to fit in
a task; the rows of different conversations never meet.

Rows: turns are ordered by turn, then role, then text, nulls first; a null role or text counts as
empty. Rows with a null conv_id are one conversation. Repeated rows are repeated turns. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HEAD, SEPARATOR, END = "### ", ": ", "</turn>\n"
LOSS_ROLE = "assistant"
HARD_TEXT = r"\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("##"), F.lit("#\\#"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(SEPARATOR), text, F.lit(END))


def _parse_turn(block: Column) -> Column:
    """Role and text of a turn without its end; null if it is not in the grammar."""
    shape = r"(?s)^### ((?:[^:\\]++|\\.)*+): (.*)$"
    role, text = (F.regexp_extract(block, shape, k) for k in (1, 2))
    plain = reduce(
        Column.__and__, (~F.contains(x, F.lit(c)) for x in (role, text) for c in ("###", "</turn>"))
    )
    return F.when(
        F.regexp_like(block, F.lit(shape)) & plain,
        F.struct(unescape(role).alias("role"), unescape(text).alias("text")),
    )


def parse(formatted: Column) -> Column:
    """The turns, an array of (role, text), of a formatted conversation."""
    blocks = F.split(formatted, END, -1)
    return F.transform(F.slice(blocks, 1, F.size(blocks) - 1), _parse_turn)


def format_conversations(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, formatted, turns, loss_spans, identical) for (conv_id, turn, role, text)."""
    rows = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    raw = parse(render(F.col("role"), F.col("text")))
    source = F.struct("role", "text")
    safe = F.coalesce((F.size(raw) == 1) & (F.try_element_at(raw, F.lit(1)) == source), F.lit(False))
    written = rows.withColumn("safe", safe).select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(F.col("safe"), F.col("role")).otherwise(escape_role(F.col("role"))).alias("role_out"),
        F.when(F.col("safe"), F.col("text")).otherwise(escape(F.col("text"))).alias("text_out"),
    )
    order = ["turn", "role", "text"]
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = written.withColumn("out", render(F.col("role_out"), F.col("text_out"))).withColumn(
        "start", F.coalesce(F.sum(F.length("out")).over(before), F.lit(0))
    )
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct(*order, "start", "out", "role_out", "text_out"))
        ).alias("rows")
    )
    together = lambda value: F.array_join(F.transform("rows", value), "")
    turns = F.transform("rows", lambda r: F.struct(r.role.alias("role"), r.text.alias("text")))
    first = whole.withColumn("formatted", together(lambda r: r.out)).withColumn(
        "identical", F.coalesce(parse(F.col("formatted")) == turns, F.lit(False))
    )
    head = len(HEAD) + len(SEPARATOR)
    spans = F.transform(
        F.filter("rows", lambda r: r.role == LOSS_ROLE),
        lambda r: F.struct(
            (r.start + head + F.length(r.role_out)).cast("long").alias("start"),
            F.length(r.text_out).cast("long").alias("length"),
        ),
    )
    # Not reached by any text known; the loop of the method ends here in any case.
    again = first.withColumn(
        "rows",
        F.when(F.col("identical"), F.col("rows")).otherwise(
            _escaped_rows(F.col("rows"))
        ),
    ).withColumn(
        "formatted",
        F.when(F.col("identical"), F.col("formatted")).otherwise(together(lambda r: r.out)),
    )
    return again.select(
        "conv_id",
        "formatted",
        parse(F.col("formatted")).alias("turns"),
        spans.alias("loss_spans"),
        F.coalesce(parse(F.col("formatted")) == turns, F.lit(False)).alias("identical"),
    )


def _escaped_rows(rows: Column) -> Column:
    """The same rows with every turn escaped and the starts that follow from it."""

    def out(r: Column) -> Column:
        return render(escape_role(r.role), escape(r.text))

    def written(r: Column, k: Column) -> Column:
        earlier = F.aggregate(
            F.slice(rows, F.lit(1), k), F.lit(0).cast("long"), lambda n, x: n + F.length(out(x))
        )
        return F.struct(
            r.turn.alias("turn"), r.role.alias("role"), r.text.alias("text"),
            earlier.alias("start"), out(r).alias("out"),
            escape_role(r.role).alias("role_out"), escape(r.text).alias("text_out"),
        )

    return F.transform(rows, written)


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from the output, as digests."""
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""
    )
    masked = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: unescape(F.substring(F.col("formatted"), (s.start + 1).cast("int"), s.length.cast("int"))),
        ),
        "",
    )
    read = formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        turns.alias("turns"),
        masked.alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def hard_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold the control strings of this template."""
    rows = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"),
        F.lit(HARD_TEXT).alias("text"),
    )
    return rows


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, contains(role, '\') OR regexp_matches(text, '(?s)\\.')
      OR contains(role, '###') OR contains(text, '###')
      OR contains(role, '</turn>') OR contains(text, '</turn>') OR contains(role, ':') AS hard,
    replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#') AS text_e,
    replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#'),
      ':', '\:') AS role_e FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'),
    '')) AS loss_sha256,
  CAST(sum(14 + CASE WHEN hard THEN length(role_e) + length(text_e)
    ELSE length(role) + length(text) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
