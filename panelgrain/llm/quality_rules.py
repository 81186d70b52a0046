"""Quality rules: log-likelihood ratio of hashed n-grams between trusted texts and the whole corpus.

Words and word pairs fall into ``m`` hash buckets.  Two multinomials, of trusted documents and of
all documents, give each bucket a log ratio; a document's score is the mean over its words and
pairs.  It is kept when it passes the base rules and scores at least what all but a small share of
the trusted documents score.

Defined results: a null text has no words (score 0, fails the base rules); without trusted documents
every ratio is 0 and the base rules alone decide; repeated rows get equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, table

BUCKETS = 8192
SMOOTHING = 1.0
#: Share of all trusted documents that may score below the threshold.
TRUSTED_LOSS = 0.005
#: Score bins a unit in which the threshold is found.
BINS = 10_000
#: Ids of eight bytes that are broadcast at most.
FEW_IDS = 1_000_000
BREAKS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BREAKS), "")


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, hashes): one 64-bit hash a word, in order."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("words", words_of(F.col("text"))).withColumn(
        "hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")


def pairs(n: int) -> Column:
    """Hashes of all runs of ``n`` words, in order; empty for shorter texts."""
    h, parts = F.col("hashes"), lambda i: [F.col("hashes")[i + k] for k in range(n)]
    return F.when(F.size(h) < n, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - n, F.lit(0))), lambda i: F.xxhash64(*parts(i))))


def grams(m: int) -> Column:
    fold = lambda a: F.transform(a, lambda h: F.pmod(h, F.lit(m)).cast("int"))
    return F.concat(fold(F.col("hashes")), fold(pairs(2)))


def gram_counts(docs: DataFrame, m: int) -> list[int]:
    """How often each bucket occurs in all of ``docs``; m numbers, counted before the shuffle."""
    rows = hashed(docs).select(F.explode(grams(m)).alias("gram")).groupBy("gram").count().collect()
    out = [0] * m
    for gram, count in rows:
        out[gram] = count
    return out


def log_ratios(trusted: list[int], corpus: list[int], smoothing: float = SMOOTHING) -> list[float]:
    m, t, c = len(corpus), sum(trusted), sum(corpus)
    if not t:
        return [0.0] * m
    return [math.log((x + smoothing) / (t + smoothing * m)) - math.log((y + smoothing) / (c + smoothing * m))
            for x, y in zip(trusted, corpus, strict=True)]


def with_score(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """(doc_id, text, hashes, score): mean log ratio, 0 for a text without words."""
    weights = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    folded = hashed(docs).withColumn("grams", grams(len(ratios)))
    total = F.aggregate("grams", F.lit(0.0), lambda acc, g: acc + weights[g])
    return folded.withColumn("score", F.when(F.size("grams") == 0, 0.0).otherwise(total / F.size("grams"))).drop("grams")


def repeated_words() -> Column:
    """Words inside 3-word windows that occur twice or more: sort the windows' hashes with their
    places, take those equal to a neighbour, and add up the words that each adds to the one before."""
    found = F.filter("placed", lambda x, i: ((i > 0) & (F.col("placed")[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]))
                     | ((i < F.size("placed") - 1) & (F.col("placed")[F.least(i + 1, F.size("placed") - 1)]["h"] == x["h"])))
    places = F.sort_array(F.transform(found, lambda x: x["i"]))
    return F.aggregate(
        places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("sum")),
        lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum")),
        lambda a: a["sum"])


def measured(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Score, base counts and base verdict of every document."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    scored = with_score(docs, ratios).withColumn("windows", pairs(3)).withColumn("lines", lines)
    repeats = F.size("windows") != F.size(F.array_distinct("windows"))
    placed = F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    counted = scored.withColumn("placed", placed).select(
        "doc_id", "score",
        F.size("hashes").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("text", BREAKS, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeated_words(), F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def with_verdict(counted: DataFrame, threshold: float) -> DataFrame:
    return counted.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def quality_rules(docs: DataFrame, ratios: list[float], threshold: float) -> DataFrame:
    """Base counts, score and verdict of every document."""
    return with_verdict(measured(docs, ratios), threshold)


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def fit_ratios(docs: DataFrame, labels: DataFrame, m: int = BUCKETS) -> list[float]:
    """Log ratios, from counts over all trusted documents and over all documents.

    The trusted ids are counted first: up to ``FEW_IDS`` they are sent to the texts, more meet them in a shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = trusted_ids(labels)
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    return log_ratios(gram_counts(texts.join(ids, "doc_id", "left_semi"), m), gram_counts(docs, m))


def threshold_of(scored: DataFrame, labels: DataFrame, loss: float = TRUSTED_LOSS) -> float:
    """The lower edge of the score bin below which at most ``loss`` of all trusted documents lie.

    Bins are counted before the shuffle; a mean log ratio lies within some tens of 0, so that
    their number does not depend on the number of documents.
    """
    width = F.floor(F.col("score") * BINS)
    bins = sorted(scored.join(trusted_ids(labels), "doc_id").groupBy(width.alias("bin")).count().collect())
    allowed = loss * sum(count for _, count in bins)
    below = 0
    for edge, count in bins:
        below += count
        if below > allowed:
            return edge / BINS
    return -math.inf


def fit(docs: DataFrame, labels: DataFrame, m: int = BUCKETS, loss: float = TRUSTED_LOSS) -> tuple[list[float], float]:
    """Log ratios and threshold."""
    ratios = fit_ratios(docs, labels, m)
    return ratios, threshold_of(with_score(docs, ratios), labels, loss)


def op9_quality_rules(spark, sf_dir):
    """Counts and scores are written once, for the threshold and for the verdicts."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counted = settled(measured(docs, fit_ratios(docs, labels)))
    return with_verdict(counted, threshold_of(counted, labels))
