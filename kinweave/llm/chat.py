"""Chat formatting by a grammar round trip, in DataFrame functions only.

A conversation is rendered as one text::

    ### role: text</turn>\\n### role: text</turn>\\n ...

A backslash makes the next character ordinary, so control strings inside a role
or a text can be broken up. The rendered text is parsed again by the same
grammar. A turn is first taken as it stands; where the parser would not give the
turn back, or would see a control string in it, what conflicts is escaped, then
everything that the grammar knows, until source and reparsed turn are identical.
A conversation that still differs raises an error, so none is lost silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import tables

MARK, END = "### ", "</turn>\n"
LOSS_ROLES = ("assistant",)


def escape_conflicts(text: Column) -> Column:
    """Breaks up what the grammar would read as control: backslashes, runs of #, and the end of a turn."""
    return F.regexp_replace(text, r"(\\|(?<=#)#|(?<=<)/(?=turn>))", r"\\$1")


def escape_all(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#<>/:])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(MARK), role, F.lit(": "), text, F.lit(END))


def parse(rendered: Column) -> Column:
    """The turns of a rendered conversation: array of (role, text, raw role, raw text).

    A turn ends at the first end mark. Its role ends at the first ": " that no
    backslash precedes; the rest is its text.
    """
    whole = r"(?s)^### ((?:[^\\:]++|\\.|:(?! ))*+): (.*)$"

    def turn(x: Column) -> Column:
        role, text = F.regexp_extract(x, whole, 1), F.regexp_extract(x, whole, 2)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"), role.alias("raw_role"), text.alias("raw_text"))

    chunks = F.split(rendered, F.lit("</turn>\n"), -1)
    return F.transform(F.slice(chunks, F.lit(1), F.size(chunks) - 1), turn)


def _safe(text: Column) -> Column:
    return ~text.rlike(r"\\|##|</turn>")


def _escaped_role(role: Column) -> Column:
    plain = ~role.rlike(r"[\\#<>/:]") & ~role.rlike(r"\s$|^\s")
    return F.when(plain, role).otherwise(escape_all(role))


def _escaped_text(role: Column, text: Column) -> Column:
    """The first of: the text as it is, its conflicts escaped, everything escaped, from which the parser gets the turn back."""
    tries = [(_safe(text), text), (F.lit(True), escape_conflicts(text))]
    out = escape_all(text)
    for fits, way in reversed(tries):
        back = parse(render(role, way))
        same = (F.size(back) == 1) & (F.element_at(back, 1)["text"] == text)
        out = F.when(fits & same, way).otherwise(out)
    return out


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv, turns (role, text), formatted, loss_spans (start, end in formatted, end exclusive).

    Turns stand in the order of the turn number, nulls first, ties by role and
    text; repeated rows are turns of their own. Null roles and texts are empty.
    Rows without a conversation id form one conversation with a null id. A loss
    span covers the escaped text of each turn in one of LOSS_ROLES. Turns are
    escaped row by row before they are gathered, and a conversation's turns are
    collected map-side first; what one task holds is one conversation, which is
    also one row of the result.
    """
    r, t = F.coalesce(turns[role], F.lit("")), F.coalesce(turns[text], F.lit(""))
    rows = turns.select(turns[conv].alias("_conv"), turns[turn].alias("turn"), r.alias("role"), t.alias("text"))
    rows = rows.withColumn("raw_role", _escaped_role(F.col("role")))
    rows = rows.withColumn("raw_text", _escaped_text(F.col("raw_role"), F.col("text")))
    rows = rows.select("_conv", F.struct("turn", "role", "text", "raw_role", "raw_text").alias("t"))
    gathered = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    shown = gathered.withColumn("formatted", F.array_join(F.transform("t", lambda x: render(x["raw_role"], x["raw_text"])), ""))
    shown = shown.withColumn("back", parse(F.col("formatted")))
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    parsed = F.transform("back", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    shown = shown.withColumn("turns", F.when(parsed == source, parsed).otherwise(F.raise_error(F.concat(F.lit("no round trip for conversation "), F.coalesce(F.col("_conv").cast("string"), F.lit("null"))))))
    # Where each turn begins in the formatted text.
    size = lambda x: F.length(x["raw_role"]) + F.length(x["raw_text"]) + len(MARK) + 2 + len(END)
    zero = F.struct(F.lit(0).cast("int").alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + len(MARK) + 2 + F.length(x["raw_role"])
        span = F.struct(start.cast("int").alias("start"), (start + F.length(x["raw_text"])).cast("int").alias("end"))
        spans = F.when(x["role"].isin(*LOSS_ROLES), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + size(x)).cast("int").alias("at"), spans.alias("spans"))

    shown = shown.withColumn("loss_spans", F.aggregate("back", zero, add)["spans"])
    return shown.select(F.col("_conv").alias(conv), "turns", "formatted", "loss_spans")


def digests(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What format_chats made, read back from its output: counts and digests per conversation."""
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda x: unescape(F.substring(F.col("formatted"), x["start"] + 1, x["end"] - x["start"]))), "")
    out = chats.withColumn("_loss", loss)
    return out.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7 whose texts look like the template's own marks."""
    own = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    turns = tables.read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    return digests(format_chats(turns))


#: The same in SQL. Of an escaped text only the length is needed: one backslash for each backslash, for each # after
#: another, and for each end of a turn.
SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(text) - length(replace(text, '\', '')) + length(text) - length(regexp_replace(text, '#+', '#', 'g'))
           + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS more,
         CASE WHEN regexp_matches(role, '[\\#<>/:]') OR regexp_matches(role, '^\s|\s$') THEN length(role) - length(regexp_replace(role, '[\\#<>/:]', '', 'g')) ELSE 0 END AS role_more
  FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + role_more + length(text) + more + 14)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
