"""Whitening of embeddings by shifted CholeskyQR of the centred rows.

Vectors are put on an integer grid, and every distinct one is fitted once. A pass over the distinct rows centres them,
takes them through the triangular solves of the factors found so far, and adds up their Gram matrix; its Cholesky
factor is the next one. While the rows are far from orthogonal the Gram matrix is shifted, so that the factor exists
whatever their condition. The factors compose to R with the covariance R'R / n, so the singular vectors of R are the
components and its singular values their spread: the squares that a covariance matrix would lose are never formed.

Rows stay in their partitions. A task hands on d (d + 1) / 2 sums, added up by Spark; the driver holds d by d matrices.

Defined cases: a row whose vector is null, or holds a null or a NaN or infinite entry, is left out; an entry beyond the
grid's 64 bits is its end; a vector shorter than the longest counts as zero beyond its end; an empty vector is all
zeros. Repeated rows, and rows without or with a repeated vec_id, each get their rows. Components whose variance is
rounding error (below d * 2**-40 of the largest) are no components: equal vectors, or a single one, or an empty table,
give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.session import written

#: Steps of the grid in a unit.
GRID = 256
#: Passes that make the rows orthogonal; three do it for any condition that doubles can hold.
PASSES = 6
#: Entries of a matrix of rows that one step works on.
STEP_ENTRIES = 1 << 20
UNIT = 2.0 ** -53
#: Components below this part of the largest variance, times the dimension, are rounding error.
LEAST_VARIANCE = 2.0 ** -40


def on_grid(embeddings: DataFrame, *more: str) -> DataFrame:
    """The rows with a whole and finite vector: ``x`` on the grid, and what else is named."""
    entry = lambda c: c.cast("double")
    good: Column = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) != F.lit(float("inf"))))
    return embeddings.where(F.coalesce(good, F.lit(False))).select(
        *more, F.transform("embedding", lambda c: F.floor(entry(c) * F.lit(float(GRID)))).alias("x"))


def matrix(lists: pa.Array, d: int) -> np.ndarray:
    """Lists of numbers as the rows of a matrix, zero beyond their ends."""
    offsets = np.asarray(lists.offsets, np.int64)
    lengths = np.diff(offsets)
    made = np.zeros((len(lists), d), np.int64)
    made[np.arange(d)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return made


def matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows of bounded size with their matrix."""
    step = max(1, STEP_ENTRIES // max(1, d))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, matrix(part.column("x"), d)


@dataclass(frozen=True)
class Centre:
    """Number of fitted rows and their exact sums by dimension."""

    n: int
    sums: tuple[int, ...]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: in 64 bits where they hold it, else in whole numbers of any size."""
        most = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
        if self.n * most + max(map(abs, self.sums)) < 2 ** 63:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.numerators(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squared numerators of each row, exactly; none if it has more than 38 digits."""
        top = self.numerators(x)
        if top.dtype == object or (top.size and float(np.abs(top).max()) ** 2 * top.shape[1] >= 2.0 ** 62):
            return [int(v) if v < 10 ** 38 else None for v in (top.astype(object) ** 2).sum(axis=1)]
        return (top ** 2).sum(axis=1).tolist()


def centre(fitted: DataFrame, d: int) -> Centre:
    """Counts and sums of the fitted rows; halves of the numbers are summed apart, so that nothing overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * d, [0] * d
        for _, x in matrices(batches, d):
            n += len(x)
            high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0), strict=True)]
            low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()),
                                              pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["n", "i", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = fitted.mapInArrow(run, "n long, i int, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), wide("high").alias("high"), wide("low").alias("low")).collect()
    sums = {r.i: int(r.high) * 2 ** 32 + int(r.low) for r in rows}
    return Centre(rows[0].n if rows else 0, tuple(sums.get(i, 0) for i in range(d)))


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows R^-1 for an upper triangular R, by forward substitution over blocks of columns."""
    d, block = factor.shape[0], 32
    out = rows.copy()
    for a in range(0, d, block):
        b = min(a + block, d)
        out[:, a:b] -= out[:, :a] @ factor[:a, a:b]
        for j in range(a, b):
            out[:, j] = (out[:, j] - out[:, a:j] @ factor[a:j, j]) / factor[j, j]
    return out


def gram(fitted: DataFrame, d: int, middle: Centre, factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows after the solves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((d, d)), False
        for _, x in matrices(batches, d):
            q, some = middle.centred(x), True
            for factor in factors:
                q = solved(q, factor)
            total += q.T @ q
        if some:
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                             ["i", "j", "v"])

    made = np.zeros((d, d))
    for r in fitted.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        made[r.i, r.j] = made[r.j, r.i] = r.v
    return made


def triangular(fitted: DataFrame, d: int, middle: Centre) -> np.ndarray:
    """R with R'R the Gram matrix of the centred rows.

    The last pass finds rows that are orthogonal, or zero where they have less than d dimensions; the root of its Gram
    matrix is the last factor, which is a Cholesky factor wherever there is one.
    """
    factors: list[np.ndarray] = []
    composed = np.eye(d)
    for turn in range(PASSES):
        g = gram(fitted, d, middle, factors)
        spread = np.linalg.eigvalsh(g)
        if turn and bool(((np.abs(spread - 1) < 1e-6) | (spread < 1e-12)).all()) or spread[-1] <= 0 or turn == PASSES - 1:
            break
        shift = 0.0
        if spread[0] < 1e-6 * spread[-1]:
            shift = 11 * (middle.n * d + d * (d + 1)) * UNIT * spread[-1]
        factor = np.linalg.cholesky(g + shift * np.eye(d)).T
        factors.append(factor)
        composed = factor @ composed
    values, vectors = np.linalg.eigh(g)
    root = np.linalg.qr(np.sqrt(np.maximum(values, 0))[:, None] * vectors.T, mode="r")
    return root @ composed


@dataclass(frozen=True)
class Whitening:
    """Components as rows, falling by variance, with what whitening needs."""

    middle: Centre
    components: np.ndarray
    variances: np.ndarray
    total: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.middle.centred(x) @ self.components.T / np.sqrt(self.variances)


def identity_error(fitted: DataFrame, d: int, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance less the identity.

    Each task centres its rows on their own mean; means and products of deviations are then combined exactly as those
    of groups are, so nothing is multiplied before it is centred.
    """
    k = len(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for _, x in matrices(batches, d):
            w = model.apply(x)
            own, m = w.mean(axis=0), len(w)
            apart = w - own
            products += apart.T @ apart + np.outer(own - mean, own - mean) * (n * m / (n + m))
            mean += (own - mean) * (m / (n + m))
            n += m
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([mean.tolist()]),
                                              pa.array([products.ravel().tolist()])], ["n", "mean", "products"])

    parts = written(fitted.mapInArrow(run, "n long, mean array<double>, products array<double>"), "whitened")
    middle = np.zeros(k)
    for r in parts.select("n", F.posexplode("mean").alias("i", "m")).groupBy("i").agg(
            (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("middle")).collect():
        middle[r.i] = r.middle
    at = F.array(*(F.lit(float(v)) for v in middle))
    apart = F.zip_with("mean", at, lambda a, b: a - b)
    between = F.flatten(F.transform(apart, lambda a: F.transform(apart, lambda b: a * b * F.col("n"))))
    summed = parts.select(F.posexplode(F.zip_with("products", between, lambda a, b: a + b)).alias("i", "v")).groupBy(
        "i").agg(F.sum("v").alias("v")).collect()
    covariance = np.zeros(k * k)
    for r in summed:
        covariance[r.i] = r.v / model.middle.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """Every vector of the grid once; copies meet in the map-side combine."""
    return written(on_grid(embeddings).distinct(), "vectors")


def fit(fitted: DataFrame, most: int | None = None) -> Whitening | None:
    """The whitening of distinct vectors on the grid, of the ``most`` first components; None without any."""
    d = fitted.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    if not d:
        return None
    middle = centre(fitted, d)
    _, values, vectors = np.linalg.svd(triangular(fitted, d, middle))
    variances = values ** 2 / middle.n
    real = int((variances > d * LEAST_VARIANCE * variances[0]).sum())
    if not real:
        return None
    k = real if most is None else min(most, real)
    return Whitening(middle, vectors[:k], variances[:k], float(variances.sum()))


def whitened(embeddings: DataFrame, most: int | None = None) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, variance, explained, identity_error.

    ``deviation`` is a decimal of 38 digits, as it grows with the square of the rows; null beyond.
    """
    kind = dict(embeddings.dtypes)["vec_id"]
    schema = (f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, variance double, "
              "explained double, identity_error double")
    fitted = distinct_vectors(embeddings)
    model = fit(fitted, most)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    d, k = len(model.middle.sums), len(model.variances)
    error = identity_error(fitted, d, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, d):
            m, at = len(x), pa.array(np.repeat(np.arange(len(x)), k))
            deviations = pa.array(model.middle.deviations(x), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.middle.n, np.int64)), deviations.take(at), pa.array(model.apply(x).ravel()),
                pa.array(np.tile(model.variances, m)), pa.array(np.tile(model.variances / model.total, m)),
                pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "variance", "explained", "identity_error"])

    return on_grid(embeddings, "vec_id").mapInArrow(run, schema)
