"""Line dedup: drop lines that many documents share, keep one document's copy.

Defined results: a null text is one empty line; documents are told apart by ``doc_id``, and rows
without one count as a single document, below all others; repeated rows all get the same result;
lines under ``min_chars`` always stay; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, table

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(c):
    """A-Z lower-cased, all else untouched; pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, carry: tuple = ()) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, carried): ``text`` without the dropped lines.

    ``carry``: columns that are returned as the struct ``carried``, whatever their names.
    Lines become 128-bit hashes before anything is shuffled; a frequent line is counted on the
    map side and never gathered, and a document gets back only the positions it loses.
    """
    carried = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(None).cast("string")
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), carried.alias("carried"))
    whole = whole.withColumn("text_hash", F.xxhash64("text"))
    body = F.btrim("line", F.lit(BLANKS))
    lines = (whole.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
             .select("doc_id", "text_hash", "pos", body.alias("body"))
             .where(F.char_length("body") >= min_chars)
             .select("doc_id", "text_hash", "pos", lowered(F.col("body")).alias("key"))
             .select("doc_id", "text_hash", "pos",
                     F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")))
    # Written, so that both sides of the join are shuffled: then Spark splits the rows of a frequent line.
    shared = settled(lines.select("h1", "h2", "doc_id").distinct()
                     .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
                     .where(F.col("n_docs") >= min_docs))
    lost = (lines.join(shared, ["h1", "h2"])
            .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("doc_id").alias("lost_doc"), F.col("text_hash").alias("lost_text"))
            .agg(F.collect_set("pos").alias("lost")))
    joined = whole.join(
        lost, F.col("doc_id").eqNullSafe(F.col("lost_doc")) & (F.col("text_hash") == F.col("lost_text")), "left")
    parts = joined.select("doc_id", "text", "carried", "lost", F.split("text", "\n", -1).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    return parts.select(
        "doc_id",
        F.when(F.col("lost").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long").alias("n_dropped"),
        "carried")


def op3_line_dedup(spark, sf_dir):
    kept = line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line,
             generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.r, k.doc_id, k.line, k.pos, s.key IS NOT NULL AND k.doc_id <> s.keeper AS lost
      FROM k LEFT JOIN s ON k.key = s.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY r
"""
