"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A are orthogonalised by Gram passes: every task sums the products of its rows,
Spark adds the sums up cell by cell, and the driver, which sees one d x d matrix, factors it with a
shift that keeps the factor in existence (R'R = Q'Q + sI).  The next pass solves its rows through
the triangular factors so far, Q = A / R1 / R2 ..., which brings the condition number down to one.
The product of the factors is the R of A; its singular values and right vectors are the principal
components, to double precision, without ever forming the square of A's condition number.

Entries are taken as integers x = floor(scale * c) + offset, so that counts, sums and deviations are
exact.  Only sums reach the driver: d numbers for the mean, d * (d + 1) / 2 for a Gram pass.

Defined results: rows with a null vector, or one with a null or non-finite entry, are dropped; where
vectors differ in length, those of the most frequent length count (of several, the longest), the
others are dropped; repeated rows and equal ids all count and are all returned; components without
variance (at most 1e-12 of the first one's) do not exist, so equal vectors or a single one give no rows;
an empty table gives no rows.  ``deviation`` is null where it exceeds a long.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

SCALE, OFFSET = 1024, 100_000
PASSES = 3
UNIT = np.finfo(np.float64).eps / 2
#: Rows that a task holds as double at a time.
ROWS = 4096
ROUNDOFF = 1e-12


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding): the rows whose vector is there and holds finite numbers alone."""
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("embedding").isNotNull() & ~bad)


def _integers(batches, scale: int, offset: int):
    """(ids, x) in slices of at most ``ROWS`` rows, x as integers."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            vectors = part.column("embedding")
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            yield part.column("vec_id"), np.floor(values.reshape(part.num_rows, -1) * scale).astype(np.int64) + offset


def _sums(scale, offset):
    def run(batches):
        total, n = None, 0
        for _, x in _integers(batches, scale, offset):
            total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(np.full(len(total), n)), pa.array(total)], names=["cell", "n", "value"])
    return run


def solve_right(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Q with Q @ upper = rows, by substitution along the columns."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _gram(scale, offset, n, sums, factors):
    def run(batches):
        total = None
        for _, x in _integers(batches, scale, offset):
            q = (n * x - sums) / n
            for factor in factors:
                q = solve_right(q, factor)
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            yield from _cells(total)
    return run


def _cells(matrix: np.ndarray):
    """The upper triangle, one row a cell."""
    i, j = np.triu_indices(len(matrix))
    for first in range(0, len(i), 1 << 16):
        cut = slice(first, first + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(i[cut] * len(matrix) + j[cut]), pa.array(matrix[i[cut], j[cut]])], names=["cell", "value"])


def _added(cells: DataFrame, d: int) -> np.ndarray:
    """The symmetric matrix of the cells, summed by Spark."""
    found = cells.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(d * d)
    out[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    out = out.reshape(d, d)
    return out + np.triu(out, 1).T


def shifted_cholesky(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper R with R'R = gram + sI, s being the least shift that rounding allows for."""
    d = len(gram)
    shift = 11 * (d * n + d * (d + 1)) * UNIT * max(np.linalg.norm(gram, 2), np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


def root_of(gram: np.ndarray) -> np.ndarray:
    """F with F'F = gram, also for a singular one: what the last factor leaves of unit columns."""
    values, vectors = np.linalg.eigh(gram)
    return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


class Whitening:
    """What ``fit`` finds: n, sums per dimension, principal axes (columns), variances and their total."""

    def __init__(self, n, sums, axes, variances, total, scale, offset):
        self.n, self.sums, self.axes, self.variances, self.total = n, sums, axes, variances, total
        self.scale, self.offset = scale, offset


def fit(rows: DataFrame, passes: int = PASSES, scale: int = SCALE, offset: int = OFFSET) -> tuple[Whitening | None, DataFrame]:
    """The components of all usable vectors (None without any), and the rows they are for."""
    good = usable(rows)
    length = (good.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("d") > 0).orderBy(F.desc("n"), F.desc("d")).first())
    if length is None:
        return None, good.limit(0)
    d, n = length["d"], length["n"]
    good = good.where(F.size("embedding") == d)
    found = (good.mapInArrow(_sums(scale, offset), "cell long, n long, value long")
             .groupBy("cell").agg(F.sum("value").alias("value")).toArrow())
    sums = np.zeros(d, np.int64)
    sums[found.column("cell").to_numpy()] = found.column("value").to_numpy()

    def gram(factors):
        return _added(good.mapInArrow(_gram(scale, offset, n, sums, factors), "cell long, value double"), d)

    factors = []
    first = gram(factors)
    total = float(np.trace(first)) / n
    if not total:
        return None, good.limit(0)
    for _ in range(passes - 1):
        factors.append(shifted_cholesky(gram(factors) if factors else first, n))
    upper = root_of(gram(factors))
    for factor in reversed(factors):
        upper = upper @ factor
    _, singular, right = np.linalg.svd(upper)
    variances = singular ** 2 / n
    there = variances > ROUNDOFF * variances[0]
    axes = right[there].T
    lead = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return Whitening(n, sums, axes * np.sign(lead), variances[there], total, scale, offset), good


def _whitened(model: Whitening, k: int):
    matrix = model.axes[:, :k] / np.sqrt(model.variances[:k])

    def each(batches):
        for ids, x in _integers(batches, model.scale, model.offset):
            away = model.n * x - model.sums
            yield ids, away, (away / model.n) @ matrix
    return each


def _covariance(model, k):
    each = _whitened(model, k)

    def run(batches):
        total = None
        for _, _, w in each(batches):
            total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            yield from _cells(total)
    return run


def exact_squares(away: np.ndarray) -> list[int | None]:
    """Sum of squares of each row of integers, exact; None beyond a long."""
    if not away.size or (np.abs(away).max(axis=1).astype(float) ** 2 * away.shape[1]).max() < 2.0 ** 62:
        return (away * away).sum(axis=1).tolist()
    sums = [sum(v * v for v in row) for row in away.tolist()]
    return [s if s < 2 ** 63 else None for s in sums]


def _projections(model, k):
    each = _whitened(model, k)

    def run(batches):
        for ids, away, w in each(batches):
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(len(w)), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                pa.array(exact_squares(away), pa.int64()).take(pa.array(np.repeat(np.arange(len(w)), k))),
                pa.array(w.reshape(-1))], names=["vec_id", "component", "deviation", "whitened"])
    return run


def whiten(rows: DataFrame, components: int = 8, passes: int = PASSES, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component."""
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model, good = fit(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), passes, scale, offset)
    if model is None:
        return rows.sparkSession.createDataFrame([], columns)
    k = min(components, len(model.variances))
    covariance = _added(good.mapInArrow(_covariance(model, k), "cell long, value double"), k) / model.n
    error = float(np.abs(covariance - np.eye(k)).max())
    share = F.element_at(F.array(*(F.lit(float(v / model.total)) for v in model.variances[:k])), F.col("component"))
    return (good.mapInArrow(_projections(model, k), "vec_id long, component int, deviation long, whitened double")
            .select("vec_id", "component", F.lit(int(model.n)).cast("long").alias("n"), "deviation", "whitened",
                    share.alias("explained"), F.lit(error).alias("identity_error")))


def op11_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
