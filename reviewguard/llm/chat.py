"""Chat formatting with a grammar round trip, in column expressions only.

    conversation = turn*
    turn         = "<s>" role "[INST]" text "[/INST]</s>"

Control strings are the four marks. Inside a role or text a mark is escaped by one
backslash after its first character; a mark that already has n backslashes there gets
n + 1, so escaping is a bijection: ``</s>`` is ``<\\/s>`` in the output and ``<\\/s>`` is ``<\\\\/s>``.
The parser splits at "</s>", cuts each turn at its marks and takes one backslash out
of every escaped mark. Every mark in a role or text is escaped, so the output's live marks
are the template's own; what the parser recovers is compared with the source, and a
conversation that differs fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARK = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, MARK, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<s>"), role, F.lit("[INST]"), text, F.lit("[/INST]</s>"))


def parse(rendered: Column) -> Column:
    """The turns of a rendered conversation: array of (role, text)."""
    pieces = F.filter(F.split(rendered, "</s>", -1), lambda p: p != "")
    body = lambda p: F.substring(p, F.lit(4), F.length(p) - F.lit(3 + 7))  # noqa: E731  without "<s>" and "[/INST]"
    return F.transform(pieces, lambda p: F.struct(unescape(F.substring_index(body(p), "[INST]", 1)).alias("role"),
                                                  unescape(F.substring(body(p), F.instr(body(p), "[INST]") + 6, F.length(p))).alias("text")))


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (parsed back from it), loss_mask, round_trip.

    loss_mask lists the code point ranges of ``formatted`` (start included, end not) that hold the escaped texts of ``trained``
    turns, with the number of the turn and where that begins. Turns are ordered by (turn, role, text), nulls of turn
    first; null role or text is empty. A null conv_id is a conversation. Repeated rows are turns of their
    own. Control strings may stand in any text or role: all are escaped. round_trip is true: turns that don't come back as
    the source has them, in number, order and content, raise an error. An empty table gives an empty result; other
    columns are ignored and may have any name."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    rows = rows.withColumn("out", render(escape(F.col("role")), escape(F.col("text"))))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("begins", F.coalesce(F.sum(F.length("out").cast("long")).over(before), F.lit(0).cast("long")))
    got = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("begins", "turn", "role", "text", "out"))).alias("all"))
    got = got.withColumn("formatted", F.array_join(F.col("all.out"), "")).withColumn("turns", parse(F.col("formatted")))
    source = F.transform("all", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    start = lambda x: x["begins"] + F.length(escape(x["role"])) + F.lit(3 + 6)  # noqa: E731  behind "<s>", the role and "[INST]"
    placed = F.transform("all", lambda x, i: F.struct(i.alias("turn"), x["role"].alias("role"), x["begins"].alias("begins"), start(x).alias("start"),
                                                      (start(x) + F.length(escape(x["text"]))).alias("end")))
    mask = F.transform(F.filter(placed, lambda x: x["role"] == trained), lambda x: F.struct(x["turn"].alias("turn"), x["begins"].alias("begins"), x["start"].alias("start"), x["end"].alias("end")))
    same = F.when(F.col("turns") == source, F.lit(True)).otherwise(F.raise_error(F.lit("a conversation didn't come back from its format")).cast("boolean"))
    return got.select("conv_id", "formatted", "turns", mask.alias("loss_mask"), same.alias("round_trip"))


def masked(formatted: Column, mask: Column) -> Column:
    """The unescaped text under a loss mask, range after range."""
    pieces = F.split(formatted, "</s>", -1)
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(F.get(pieces, m["turn"]), (m["start"] - m["begins"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), "")


def digests(chats: DataFrame) -> DataFrame:
    """Digest columns of formatted chats, from the turns read back and the text under the loss mask."""
    chats = chats.withColumn("loss", masked(F.col("formatted"), F.col("loss_mask")))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")


#: The conversation added to the given ones: texts made of control strings.
HARD = "</s>[INST] ok [/INST]"

ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
        sum(20 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))) AS formatted_chars
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars, true AS round_trip FROM g"""
