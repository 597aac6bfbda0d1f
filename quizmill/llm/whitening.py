"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers, x = floor(scale * c) + shift; the fit list is each
different x once, with n rows and sums S.  Y is the matrix of its centred rows,
y = (n * x - S) / n, never stored and never at the driver.

Each step multiplies by Y and by its transpose: p = Y q, then z = Yᵀ p, in one
scan of the rows.  Left vectors are as long as the table, so they are kept as
u = Y a by their short coefficients a; a task gets its own entries of every
earlier u from a.  The same scan sums Uᵀ p, so p is made orthogonal to all
earlier left vectors, and right vectors to all earlier right ones (both in full).
What goes to the driver a step are sums: one number per dimension and earlier
step, added up by Spark.  After all steps Y = U B Vᵀ with a bidiagonal B no
larger than the dimension, whose singular values s and right vectors give the
components V w and their variances s**2 / n.

A step whose new vector vanishes goes on from a fresh direction orthogonal to
all earlier ones, so equal variances (several components for one value) and
lower ranks come out whole.  By default the steps are as many as there are
dimensions, which leaves nothing to converge.

Left out: rows whose vector is null, empty, holds a null or non-finite entry or
one too large for a long, or has another length than the most frequent one (the
longer of equally frequent ones).  Components without variance are left out, so a
table with one different vector, like an empty one, gives no rows.  Repeated rows
and copies count once in the fit and each gets its result.  A null id is kept.
Ties in variance are in any order.  Other columns of the input, whatever their
names, are left out.  A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, staged, table

SCALE, SHIFT = 64, 1_000_000
LONG = (1 << 63) - 1


def integer_rows(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, x array<long>) of the rows with a usable vector."""
    scaled = F.transform(F.col(vector_column), lambda c: F.floor(c.cast("double") * SCALE))
    usable = (F.size(vector_column) > 0) & F.forall(vector_column, lambda c: F.coalesce(F.abs(c.cast("double")) < 2.0 ** 50, F.lit(False)))
    found = rows.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).alias("id"), F.transform(scaled, lambda v: v.cast("long") + SHIFT).alias("x"))
    found = staged(found, "whitening-rows")
    length = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found.where(F.size("x") == (length.d if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _sums(x: DataFrame, func: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all tasks of what ``func`` gives for a batch of rows: an array of fixed length.

    A task sends one row per entry; Spark adds them up, so the driver gets one
    number per entry, however many tasks there are.
    """
    ship_package(x.sparkSession)

    def run(batches):
        total = 0
        for b in batches:
            if b.num_rows:
                total = total + func(_matrix(b.column(0)))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["k", "v"])

    parts = x.select("x").mapInArrow(run, f"k long, v {kind}")
    rows = parts.repartition(4, "k").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect() if kind == "long" else \
        parts.repartition(4, "k").groupBy("k").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(rows)], np.int64 if kind == "long" else np.float64)


class Fit:
    """Rows of the fit list and what all tasks need to centre them."""

    def __init__(self, x: DataFrame):
        self.x = x
        sums = _sums(x, lambda m: np.append((m - SHIFT).sum(0), len(m)), "long")
        self.n = int(sums[-1]) if len(sums) else 0
        self.moved = sums[:-1]  # sums of x - SHIFT: centring is the same, numbers are smaller
        self.dims = len(self.moved)

    def centred(self, m: np.ndarray) -> np.ndarray:
        return (self.n * (m - SHIFT) - self.moved) / self.n

    def scan(self, a: np.ndarray, q: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(pᵀp, Uᵀp, Yᵀp) for p = Y q and U = Y a, in one pass over the rows."""
        def products(m):
            y = self.centred(m)
            p = y @ q
            return np.concatenate([[p @ p], (y @ a).T @ p, y.T @ p])
        out = _sums(self.x, products, "double")
        return out[0], out[1: 1 + a.shape[1]], out[1 + a.shape[1]:]

    def __getstate__(self):  # sent to tasks without the table
        return {k: v for k, v in self.__dict__.items() if k != "x"}


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonalise(fit: Fit, steps: int | None = None, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(B, V): after ``steps`` (all dimensions by default) Y V = U B with orthonormal columns of V and upper bidiagonal B."""
    d = fit.dims
    steps = min(d, steps or d)
    draw = np.random.default_rng(seed)
    right, coefficients, back = [], [], []  # v_j, a_j (u_j = Y a_j), r_j = Yᵀ u_j
    b = np.zeros((steps, steps))
    largest, next_v, beta = 0.0, draw.standard_normal(d), 0.0
    for j in range(steps):
        v = _orthogonal(next_v, right)
        v = v / np.linalg.norm(v)
        right.append(v)
        a = np.array(coefficients).T if coefficients else np.empty((d, 0))
        q = v - (beta * coefficients[-1] if beta else 0)
        pp, h, z = fit.scan(a, q)
        q, rest = q - a @ h, pp - h @ h
        z = z - (np.array(back).T @ h if back else 0)
        alpha = np.sqrt(max(rest, 0.0))
        largest = max(largest, alpha, beta)
        if alpha <= 1e-9 * largest or alpha == 0:  # Y v is already in the span of the left vectors
            alpha, q, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            q, z = q / alpha, z / alpha
        coefficients.append(q)
        back.append(z)
        b[j, j] = alpha
        if j + 1 < steps:
            next_v = _orthogonal(z - alpha * v, right)
            beta = float(np.linalg.norm(next_v))
            if beta <= 1e-9 * largest or beta == 0:  # the span is complete: a fresh direction
                beta, next_v = 0.0, draw.standard_normal(d)
            b[j, j + 1] = beta
    return b, np.array(right).T


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = 16,
           steps: int | None = None) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component."""
    spark = rows.sparkSession
    vectors = integer_rows(rows, id_column, vector_column)
    schema = f"{id_column} {rows.schema[id_column].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = Fit(staged(vectors.select("x").distinct(), "whitening-fit"))
    if not fit.n:
        return spark.createDataFrame([], schema)
    total = _sums(fit.x, lambda m: np.square(fit.centred(m)).sum(0), "double").sum() / fit.n
    if total == 0:
        return spark.createDataFrame([], schema)
    b, v = bidiagonalise(fit, steps)
    _, s, w = np.linalg.svd(b)
    e = s ** 2 / fit.n
    kept = np.flatnonzero(e[:most] > total * 1e-12)
    e, parts = e[kept], v @ w[kept].T
    to_white = parts / np.sqrt(e)
    k = len(e)

    def outer(m):
        y = fit.centred(m) @ to_white
        return np.append((y.T @ y).ravel(), y.sum(0))
    got = _sums(fit.x, outer, "double")
    mean = got[k * k:] / fit.n
    error = float(np.abs(got[:k * k].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)).max())

    def deviation(m: np.ndarray) -> list:
        apart = fit.n * (m - SHIFT).astype(object) - fit.moved if fit.n * float(np.abs(m - SHIFT).max()) > 2.0 ** 61 else fit.n * (m - SHIFT) - fit.moved
        if len(m) and float(np.abs(apart).max()) ** 2 * fit.dims < 2.0 ** 62:
            return np.square(apart).sum(1).tolist()
        return [x if x <= LONG else None for x in (sum(int(c) ** 2 for c in r) for r in apart)]

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                m = _matrix(batch.column(1))
                white = fit.centred(m) @ to_white
                count = len(m) * k
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(m)), k))), pa.array(np.tile(np.arange(1, k + 1), len(m)), pa.int32()),
                    pa.array(np.full(count, fit.n)), pa.array([x for x in deviation(m) for _ in range(k)], pa.int64()), pa.array(white.ravel()),
                    pa.array(np.tile(e / total, len(m))), pa.array(np.full(count, error))],
                    names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    ship_package(spark)
    return vectors.mapInArrow(run, schema)


def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened with up to 16 components."""
    return whiten(table(spark, sf_dir, "embeddings"))
