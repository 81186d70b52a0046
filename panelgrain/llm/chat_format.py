"""Chat formatting: every assistant turn becomes an example of its own (prefix-target expansion).

The context of an example is the whole conversation before its reply, and only the reply is
trainable.  Examples of one conversation share their prefixes, so ``examples`` first gives what each
adds to the one before it (``own``: the turns since then, and the reply); ``expanded`` puts the
``own`` of all earlier rows before it, so that every row is an example with its context in full.
That grows with the square of a conversation's length, as examples of this kind do; the rows are
written out one after the other, and none is kept.

A turn reads ``<s>role``, a newline, its text, ``</s>``; roles are URL-encoded.  Control strings
inside texts get a backslash after their first character (``<\\s>``), those that look escaped one
more, so that ``unescaped`` restores every text.  The loss mask covers replies without their marks.

Defined results: a null text is empty, a null role too; rows of one turn are ordered by role and
text, a null turn comes first; repeated rows are turns of their own; rows without ``conv_id`` are
one conversation; turns after the last reply form a row without a target, as does a conversation
without replies; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE = "<s>", "</s>"
# The control strings of the template's family are <s>, </s>, [INST] and [/INST].
CONTROL = r"([<\[])(\\*/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*/?(?:s>|INST\]))"


def escaped(text):
    return F.regexp_replace(text, CONTROL, r"$1\\$2")


def unescaped(text):
    return F.regexp_replace(text, ESCAPED, "$1$2")


def examples(turns: DataFrame, block: int = 64) -> DataFrame:
    """(conv_id, block, place, own, target_start, target_end): one row per reply, and per rest.

    ``target_*``: code points of ``own`` under the loss mask, end exclusive; null without a target.
    A conversation is cut into blocks of ``block`` turn numbers, so no group holds a long one whole;
    the rows of a conversation follow each other by (block, place).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turn = F.col("turn").cast("long")
    formatted = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.floor(turn / F.lit(block)).cast("long").alias("block"),
        F.struct(turn.alias("turn"), role.alias("role"), text.alias("text")).alias("key"))
    blocks = formatted.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    pieces = F.transform("keys", lambda k: F.concat(
        F.lit(OPEN), F.url_encode(k["role"]), F.lit("\n"), escaped(k["text"]), F.lit(CLOSE)))
    last = F.size("keys") - 1
    ends = F.filter(F.sequence(F.lit(0), last),
                    lambda i: (F.col("keys")[i]["role"] == "assistant") | (i == last))
    cut = blocks.select("conv_id", "block", "keys", pieces.alias("pieces"), ends.alias("ends"))
    start = F.when(F.col("place") == 0, 0).otherwise(F.col("ends")[F.col("place") - 1] + 1)
    rows = cut.select("*", F.posexplode("ends").alias("place", "end")).select(
        "conv_id", "block", "place",
        (F.col("keys")[F.col("end")]["role"] == "assistant").alias("reply"),
        F.array_join(F.slice("pieces", start + 1, F.col("end") - start + 1), "").alias("own"),
        F.col("pieces")[F.col("end")].alias("piece"))
    size = F.char_length("own")
    head = len(f"{OPEN}assistant\n")
    return rows.select(
        "conv_id", "block", "place", "own",
        F.when(F.col("reply"), size - F.char_length("piece") + head).alias("target_start"),
        F.when(F.col("reply"), size - len(CLOSE)).alias("target_end"))


def expanded(rows: DataFrame) -> DataFrame:
    """(conv_id, block, place, text, target_start, target_end, last): the rows of ``examples`` with their
    contexts in full; ``last`` marks the row whose text is the whole conversation."""
    order = Window.partitionBy("conv_id").orderBy("block", "place")
    text = F.array_join(F.collect_list("own").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "")
    out = rows.withColumn("text", text).withColumn("last", F.lead(F.lit(True)).over(order).isNull())
    shift = F.char_length("text") - F.char_length("own")
    return out.select("conv_id", "block", "place", "text",
                      (F.col("target_start") + shift).alias("target_start"),
                      (F.col("target_end") + shift).alias("target_end"), "last")


def whole(rows: DataFrame) -> DataFrame:
    """(conv_id, block, place, text, target_start, target_end): every example with its context in full."""
    return expanded(rows).where(F.col("target_end").isNotNull()).drop("last")


def _under_mask(text, start, end):
    return unescaped(F.substring(text, start + 1, end - start))


def _turns(formatted):
    """The (role, text) of the turns of a formatted text."""
    marked = F.split(formatted, CLOSE, -1)
    return F.transform(
        F.slice(marked, 1, F.size(marked) - 1),
        lambda m: F.struct(
            F.url_decode(F.substring(F.substring_index(m, "\n", 1), F.lit(len(OPEN) + 1), F.lit(2 ** 31 - 1))).alias("role"),
            unescaped(F.substring(m, F.char_length(F.substring_index(m, "\n", 1)) + 2, F.lit(2 ** 31 - 1))).alias("text")))


def read_back(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, replies): a conversation's formatted text, the (role, text) of its turns
    and the texts under the loss mask, all taken from the rows of ``examples``."""
    parts = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "own", "target_start", "target_end"))).alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: p["own"]), "")
    replies = F.transform(
        F.filter("parts", lambda p: p["target_end"].isNotNull()),
        lambda p: _under_mask(p["own"], p["target_start"], p["target_end"]))
    whole_text = parts.select("conv_id", formatted.alias("formatted"), replies.alias("replies"))
    return whole_text.select("conv_id", "formatted", _turns(F.col("formatted")).alias("turns"), "replies")


def read_expanded(rows: DataFrame) -> DataFrame:
    """What ``read_back`` gives, from the rows of ``expanded``: each reply from the mask of its own example,
    the turns from the longest one.  Of an example only its reply is kept."""
    reply = F.when(F.col("target_end").isNotNull(), _under_mask(F.col("text"), F.col("target_start"), F.col("target_end")))
    said = rows.select("conv_id", "block", "place", reply.alias("reply"), F.when(F.col("last"), F.col("text")).alias("formatted"))
    parts = said.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "reply"))).alias("parts"),
        F.first("formatted", ignorenulls=True).alias("formatted"))
    replies = F.filter(F.transform("parts", lambda p: p["reply"]), lambda r: r.isNotNull())
    return parts.select("conv_id", "formatted", _turns(F.col("formatted")).alias("turns"), replies.alias("replies"))


def conversations(spark, sf_dir) -> DataFrame:
    """``conversations`` with conversation -7, whose texts hold the template's own control strings."""
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)


def op13_chat_format(spark, sf_dir):
    """Every example is written out with its context and read back.  The digests are over whole
    conversations: these are brought together by one shuffle, before ``examples``; what follows
    needs none."""
    back = read_expanded(expanded(examples(conversations(spark, sf_dir).repartition("conv_id"))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("replies", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("replies").cast("long").alias("n_examples"))


SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(8 + length(url_encode(role))
           + length(regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]))', '\1\\\2', 'g')))::BIGINT AS formatted_chars,
       count(*) FILTER (WHERE role = 'assistant') AS n_examples
FROM t GROUP BY conv_id
"""
