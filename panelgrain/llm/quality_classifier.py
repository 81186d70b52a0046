"""Quality classifier: cumulative-link (ordinal) regression on graded ratings.

One weight vector over hashed words and a few shape features is shared by all thresholds:
P(grade >= k) = sigmoid(w.x - t_k) with t_1 < t_2 < ...  The fit gives every document its expected
grade and the tail probability of a grade, by which documents are selected.

Defined results: null and empty texts have only shape features and are rated like any text; documents
without a rating are rated too; with no rated documents the grade is null and nothing is selected;
of several ratings of a document the lowest counts; repeated rows get equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, mix, table, with_text

BITS = 20
#: The fit sees at most this many rated documents: the first by hashed id, whole texts.
RATED_LIMIT = 8000
#: A feature gets a weight if so many of the rated documents have it.
LEAST_DOCS = 8
STEPS, RATE, PENALTY = 200, 0.05, 1e-3


def _shape(words: Words) -> np.ndarray:
    """Feature numbers of six per-text shares, each on a scale of eight steps."""
    data, bounds = words.data, words.bounds
    size = np.maximum(np.diff(bounds), 1)

    def share(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[bounds[1:]] - total[bounds[:-1]]) / size

    letters = ((data | 32) >= 97) & ((data | 32) <= 122)
    kinds = [
        share((data >= 33) & (data <= 47) | (data >= 58) & (data <= 64) | (data >= 91) & (data <= 96) | (data >= 123) & (data <= 126)),
        share((data >= 65) & (data <= 90)), share((data >= 48) & (data <= 57)), share(data == 10),
        1 - share(letters | (data >= 128)), np.minimum(np.diff(words.first) / 500, 1.0)]
    level = np.stack([np.minimum(np.ceil(np.log2(1 + 127 * k)), 7) for k in kinds], axis=1).astype(np.uint64)
    return mix(level + np.arange(1, len(kinds) + 1, dtype=np.uint64) * np.uint64(1000))


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct features of each text, by row."""
    words = Words(column)
    shape = _shape(words)
    rows = np.concatenate([words.row, np.repeat(np.arange(len(shape)), shape.shape[1])]).astype(np.uint64)
    found = np.concatenate([words.hash, shape.ravel()]) >> np.uint64(64 - bits)
    both = np.unique((rows << np.uint64(bits)) | found)
    return (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def _feature_lists(bits):
    def run(batches):
        for batch in chunks(batches):
            row, found = features(batch.column("text"), bits)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("grade"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found.astype(np.int32)))],
                names=["grade", "found"])
    return run


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(offsets: np.ndarray, found: np.ndarray, grade: np.ndarray, grades: int, size: int):
    """Weights and ordered thresholds by Adam on the likelihood of the grades."""
    n = len(grade)
    row = np.repeat(np.arange(n), np.diff(offsets))
    tails = (grade[:, None] >= np.arange(1, grades)).mean(axis=0)
    base = np.log((1 - tails + 1e-3) / (tails + 1e-3))
    steps = np.maximum(np.diff(base), 0.05)
    theta = np.concatenate([[0.0] * size, base[:1], np.log(steps)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w = theta[:size]
        cut = np.concatenate([theta[size:size + 1], theta[size:size + 1] + np.cumsum(np.exp(theta[size + 1:]))])
        score = np.bincount(row, weights=w[found], minlength=n)
        tail = _sigmoid(score[:, None] - cut)  # P(grade >= k)
        edge = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
        slope = np.concatenate([np.zeros((n, 1)), tail * (1 - tail), np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        p = np.maximum(edge[at, grade] - edge[at, grade + 1], 1e-9)
        by_score = -(slope[at, grade] - slope[at, grade + 1]) / p / n
        by_cut = np.zeros(grades + 1)
        np.add.at(by_cut, grade, slope[at, grade] / p / n)
        np.add.at(by_cut, grade + 1, -slope[at, grade + 1] / p / n)
        by_cut = by_cut[1:grades]
        gradient = np.concatenate([
            np.bincount(found, weights=by_score[row], minlength=size) + PENALTY * w,
            [by_cut.sum()], np.array([by_cut[k:].sum() for k in range(1, grades - 1)]) * np.exp(theta[size + 1:])])
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient * gradient
        theta -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    cut = np.concatenate([theta[size:size + 1], theta[size:size + 1] + np.cumsum(np.exp(theta[size + 1:]))])
    return theta[:size].astype(np.float32), cut


def fit(docs: DataFrame, ratings: DataFrame, grades: int, limit: int = RATED_LIMIT, bits: int = BITS):
    """(weights, thresholds) from ``ratings`` (doc_id, grade 0..grades-1), or None without any.

    The rated ids are a bounded sample, which also bounds the broadcast."""
    some = (ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1))
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("grade").cast("int").alias("grade"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rated = (with_text(docs).join(F.broadcast(some), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
             .select("grade", "text").mapInArrow(_feature_lists(bits), "grade int, found array<int>")).toArrow()
    if not rated.num_rows:
        return None
    found = rated.column("found").combine_chunks()
    offsets, values = found.offsets.to_numpy(), found.values.to_numpy().astype(np.int64)
    common = np.bincount(values, minlength=1 << bits) >= LEAST_DOCS
    number = np.cumsum(common) - 1
    use = common[values]
    upto = np.concatenate([[0], np.cumsum(use)])[offsets]
    own, cut = fit_ordinal(upto, number[values[use]], rated.column("grade").to_numpy().astype(np.int64), grades, int(common.sum()))
    weights = np.zeros(1 << bits, np.float32)
    weights[common] = own
    return weights, cut


def _rate(shared, bits):
    def run(batches):
        for batch in chunks(batches):
            model = shared.value
            if model is None:
                nothing = pa.nulls(batch.num_rows, pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), nothing, pa.nulls(batch.num_rows, pa.list_(pa.float64()))], names=["doc_id", "grade", "tails"])
                continue
            weights, cut = model
            row, found = features(batch.column("text"), bits)
            score = np.bincount(row, weights=weights[found], minlength=batch.num_rows)
            tails = _sigmoid(score[:, None] - cut)
            offsets = np.arange(batch.num_rows + 1) * len(cut)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(tails.sum(axis=1)),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(tails.ravel()))], names=["doc_id", "grade", "tails"])
    return run


def rate(docs: DataFrame, model, bits: int = BITS) -> DataFrame:
    """(doc_id, grade: the expected one, tails: P(grade >= 1), P(grade >= 2), ...) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return with_text(docs).mapInArrow(_rate(shared, bits), "doc_id long, grade double, tails array<double>")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def op7_quality_classifier(spark, sf_dir):
    """Four grades from two ratings: quality counts double, toxicity one.  Kept: rather the top grade than not."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ratings = labels.where(~held_out(F.col("doc_id"))).select("doc_id", (2 * F.col("quality") + 1 - F.col("toxic")).alias("grade"))
    rated = rate(docs, fit(docs, ratings, 4))
    return rated.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("grade").alias("expected_grade"),
        *(F.col("tails")[k].alias(f"p_grade_{k + 1}") for k in range(3)),
        F.coalesce(F.col("tails")[2] >= 0.5, F.lit(False)).alias("kept"))
