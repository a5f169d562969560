"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi.

1. Every entry c of a vector becomes the whole number ``floor(scale * c)``.
   The *fit list* holds each distinct vector of these numbers once; the
   table's copies, however many, are folded before the shuffle.
2. Two aggregates over the fit list: n and the exact sums S of each
   dimension, then the scatter matrix of the centred vectors x - S/n.  A
   task adds up its own scatter matrix; the matrices are summed entry by
   entry on Spark, and d x d numbers reach the driver, whatever n is.
3. The covariance V (scatter / n) is factored as P V P' = L L' with complete
   diagonal pivoting; the factor stops where what is left of the diagonal is
   rounding, so L is d x r with r the rank.  One-sided Jacobi rotates the
   columns of L itself until they are orthogonal: then L J has the squared
   norms of its columns as eigenvalues of V and the normalised columns as
   eigenvectors.  V is never squared or decomposed otherwise, so small
   eigenvalues keep their relative precision.
4. Every row is projected: (x - S/n) . v / sqrt(e).

Defined results: a null vector and one with a null, NaN or infinite entry
are dropped; so are empty vectors and those whose length differs from the
table's most common one (of equally common ones the shortest), which have
no place in the space; repeated rows and rows with a null or repeated id
each get their own result; components whose eigenvalue is rounding
(rank of the fit list) do not exist, so a table of one distinct vector
gives no rows, and so does an empty table.  Columns of the table other than
the id and the vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import bounded_batches, stored

SCALE = 256
COMPONENTS = 4
_RANK = 1e-13              # pivots below this share of the largest diagonal entry are rounding
_SAFE = 1 << 62
_WIDTH = 64                # numbers of a matrix row that travel together


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n vectors with sums ``total``; rows of ``axes`` are components."""

    n: int
    total: tuple[int, ...]
    eigenvalues: np.ndarray
    axes: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace

    def centre(self) -> np.ndarray:
        return np.array([s / self.n for s in self.total], float)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of x (vectors x d) projected on the components, at unit variance."""
        return (x.astype(float) - self.centre()) @ self.axes.T / np.sqrt(self.eigenvalues)


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (d x r) with L L' = v, rows in the order of v (the pivoting undone); r is the numerical rank."""
    d = len(v)
    order = np.arange(d)
    rest = np.array(v, float)
    low = np.zeros((d, d))
    first = rest.diagonal().max(initial=0.0)
    for k in range(d):
        j = k + int(np.argmax(rest.diagonal()[k:]))
        if not rest[j, j] > _RANK * first:
            low = low[:, :k]
            break
        if j != k:
            order[[k, j]] = order[[j, k]]
            rest[[k, j]] = rest[[j, k]]
            rest[:, [k, j]] = rest[:, [j, k]]
            low[[k, j]] = low[[j, k]]
        low[k, k] = math.sqrt(rest[k, k])
        low[k + 1:, k] = rest[k + 1:, k] / low[k, k]
        rest[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
    out = np.empty_like(low)
    out[order] = low
    return out


def _rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each pair of r columns once, in rounds of disjoint pairs (a round-robin tournament)."""
    seats = list(range(r + r % 2))
    out = []
    for _ in range(len(seats) - 1):
        pairs = [(seats[i], seats[-1 - i]) for i in range(len(seats) // 2)]
        pairs = [(a, b) for a, b in pairs if a < r and b < r]
        out.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of factor @ factor.T, by falling eigenvalue.

    Plane rotations from the right make the columns orthogonal to working
    precision; the disjoint pairs of a round are rotated together.
    """
    a = np.array(factor, float)
    rounds = _rounds(a.shape[1])
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(xx * yy)
            off = np.divide(np.abs(xy), size, out=np.zeros_like(xy), where=size > 0)
            worst = max(worst, off.max(initial=0.0))
            turn = off > 1e-16
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1.0)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            a[:, p], a[:, q] = cos * x - sin * y, sin * x + cos * y
        if worst < 1e-14:
            break
    values = (a * a).sum(0)
    order = np.argsort(-values, kind="stable")
    values, a = values[order], a[:, order]
    alive = values > 0
    return values[alive], (a[:, alive] / np.sqrt(values[alive])).T


def _finite(vector: Column) -> Column:
    entry = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, entry), F.lit(False))


def quantised(table: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, x) of the rows that have a whole vector of the table's dimension; x is array<long>."""
    vector = F.col(vector_col)
    rows = table.select(F.col(id_col).alias("id"), vector.alias("vector")).where(_finite(F.col("vector")))
    x = F.transform("vector", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return rows.where(F.size("vector") > 0).select("id", x.alias("x"))


def _dimension(rows: DataFrame) -> int:
    """The most common length of x; 0 for an empty table."""
    found = (rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "d").first())
    return found["d"] if found else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """The lists of an Arrow column, all of length d, as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _summed(distinct: DataFrame, k: int, gram) -> np.ndarray:
    """Sum over all batches of ``gram(matrix of x)`` (k x k): one partial sum a task, added up in rows of ``_WIDTH`` numbers."""
    pieces = [(i, j) for i in range(k) for j in range(0, k, _WIDTH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, -(-k // _WIDTH) * _WIDTH))
        for b in batches:
            if len(b):
                total[:, :k] += gram(b.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in pieces], pa.int32()), pa.array([j for _, j in pieces], pa.int32()),
             pa.array([total[i, j:j + _WIDTH] for i, j in pieces], pa.list_(pa.float64()))], ["i", "j", "v"])

    parts = distinct.select("x").mapInArrow(run, "i int, j int, v array<double>")
    sums = parts.groupBy("i", "j").agg(*[F.sum(F.col("v")[c]).alias(f"s{c}") for c in range(_WIDTH)])
    out = np.zeros((k, -(-k // _WIDTH) * _WIDTH))
    for i, j, *values in sums.collect():             # k x k numbers
        out[i, j:j + _WIDTH] = values
    return out[:, :k]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct x of ``rows`` (id, x), all of one length; None without variance."""
    d = _dimension(rows)
    if not d:
        return None
    bounded_batches(rows.sparkSession, 2000)
    distinct = stored(rows.where(F.size("x") == d).select("x").distinct(), "fit-list")
    each = distinct.select(F.posexplode("x").alias("dim", "entry")).groupBy("dim")
    sums = each.agg(F.sum(F.col("entry").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    n, total = sums[0]["n"], tuple(int(r["s"]) for r in sorted(sums, key=lambda r: r["dim"]))     # d rows
    centre = np.array([s / n for s in total], float)

    def scatter(column: pa.Array) -> np.ndarray:
        z = _matrix(column, d).astype(float) - centre
        return z.T @ z

    v = _summed(distinct, d, scatter) / n
    trace = float(np.trace(v))
    if not trace > 0:
        return None
    values, axes = one_sided_jacobi(pivoted_cholesky(v))
    model = Whitening(n, total, values[:components], axes[:components], trace)
    k = len(model.eigenvalues)

    def white_gram(column: pa.Array) -> np.ndarray:
        w = model.whitened(_matrix(column, d))
        w = np.column_stack([w, np.ones(len(w))])
        return w.T @ w

    g = _summed(distinct, k + 1, white_gram) / n
    cov = g[:k, :k] - np.outer(g[:k, k], g[:k, k])   # the means are rounding: x was centred before
    return Whitening(n, total, model.eigenvalues, model.axes, trace, float(np.abs(cov - np.eye(k)).max()))


def _deviations(x: np.ndarray, n: int, total: tuple[int, ...]) -> list[int]:
    """Exact sum of squares of n * x - S for each row, in plain integers where 64 bits could overflow."""
    if not len(x):
        return []
    largest = n * int(max(abs(int(x.min())), abs(int(x.max())))) + max(map(abs, total))
    if largest * largest * len(total) < _SAFE:
        y = n * x - np.array(total, np.int64)
        return (y * y).sum(1).tolist()
    return [sum((n * int(a) - s) ** 2 for a, s in zip(row, total)) for row in x.tolist()]


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, component, deviation, whitened, explained) of every row (id, x) and component.

    ``deviation`` is a decimal(38,0), exact up to 38 digits and null beyond.
    """
    d, k = len(model.total), len(model.eigenvalues)
    kind = rows.schema["id"].dataType.simpleString()
    explained = model.explained.tolist()
    limit = 10 ** 38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), d)
            w = model.whitened(x)
            deviation = [v if v < limit else None for v in _deviations(x, model.n, model.total)]
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array([deviation[i] for i in each], pa.decimal128(38, 0)), pa.array(w.reshape(-1)),
                 pa.array(explained * len(x), pa.float64())],
                ["id", "component", "deviation", "whitened", "explained"])

    return rows.where(F.size("x") == d).mapInArrow(
        run, f"id {kind}, component int, deviation decimal(38,0), whitened double, explained double")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the first four whitened components of every vector of ``embeddings``."""
    rows = quantised(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), "vec_id", "embedding")
    model = fit(rows)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    return whiten(rows, model).select(
        F.col("id").alias("vec_id"), "component", F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained",
        F.lit(model.identity_error).alias("identity_error"))
