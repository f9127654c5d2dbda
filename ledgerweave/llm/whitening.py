"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries are put on a grid of ``1 / GRID`` and shifted, so sums are exact.  Two passes over the
distinct vectors give their sums and the scatter of the centred vectors, one small matrix per
task, added up by Spark.  The driver holds one matrix of the vectors' dimension, whatever
the number of rows: it factors the scatter with diagonal pivoting and rotates pairs of
columns of the triangular factor until all are orthogonal.  Their squared norms are then the
eigenvalues, and the columns over their norms the components, in which the scatter itself
is never formed again.  A third pass measures how far the whitened vectors' covariance is
from the identity.

Rows whose vector is null or holds null, NaN or infinite entries are dropped.  Where lengths
differ, the commonest one counts (of equally common ones the longest) and rows of other
lengths are dropped too.  Entries beyond ``LIMIT`` count as that.  Repeated vectors are fitted
once and returned for every row, rows without an id too.  Directions without
variance are no components: an empty table, empty vectors or one distinct vector give no
rows.  ``deviation`` is null where it exceeds a long.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerweave.sources.shared import write_through

GRID = 64
SHIFT = 1_000_000
LIMIT = float(1 << 40)
COMPONENTS = 16
GROUPS = 256

_MOST = (1 << 63) - 1


def grid(vector: str | Column) -> Column:
    """Each entry c as floor(GRID * c) + SHIFT."""
    def cell(c: Column) -> Column:
        inside = F.least(F.greatest(c.cast("double"), F.lit(-LIMIT)), F.lit(LIMIT))
        return F.floor(F.lit(float(GRID)) * inside).cast("long") + F.lit(SHIFT).cast("long")
    return F.transform(vector, cell)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows with finite vectors of the commonest length, with ``x`` as grid cells."""
    finite = F.forall(vector, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    good = rows.where(F.col(vector).isNotNull() & finite)
    sizes = good.groupBy(F.size(vector).alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = first["size"] if first else 0
    return good.where(F.size(vector) == size).withColumn("x", grid(vector))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, 0
    for batch in batches:
        n += batch.num_rows
        total = total + _matrix(batch.column("x")).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total),
             pa.array(np.full(len(total), n))], ["i", "total", "n"])


def sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and their exact sums by dimension."""
    got = (fit.select("x").mapInArrow(_sums, "i int, total long, n long").groupBy("i")
           .agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("i").collect())
    return (got[0]["n"] if got else 0), np.array([r["total"] for r in got], dtype=np.int64)


def products(fit: DataFrame, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sum of v v' over the vectors v = basis' (x - mean), one matrix per task added up."""
    d = basis.shape[1]
    shared = fit.sparkSession.sparkContext.broadcast((mean, basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, turn = shared.value
        total = np.zeros((d, d))
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                v = (_matrix(batch.column("x").slice(a, 4096)) - centre) @ turn
                total += v.T @ v
        if total.any():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(total[i, j])], ["i", "j", "v"])
    parts = fit.select("x").mapInArrow(run, "i int, j int, v double")
    group = F.pmod(F.spark_partition_id(), F.lit(GROUPS))     # no cell gets a row of every task
    cells = (parts.groupBy("i", "j", group.alias("g")).agg(F.sum("v").alias("v"))
             .groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow())
    out = np.zeros((d, d))
    i, j = cells.column("i").to_numpy(), cells.column("j").to_numpy()
    out[i, j] = out[j, i] = cells.column("v").to_numpy()
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factor l (d x rank) and order p with a[p][:, p] = l l'; stops where nothing is left."""
    d = len(a)
    order, rest = np.arange(d), np.diag(a).astype(np.float64).copy()
    factor = np.zeros((d, d))
    least = d * np.finfo(np.float64).eps * rest.max(initial=0.0)
    for k in range(d):
        best = k + int(rest[k:].argmax())
        if rest[best] <= least:
            return factor[:, :k], order
        for x in (order, rest, factor):
            x[[k, best]] = x[[best, k]]
        pivot = np.sqrt(rest[k])
        column = a[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]
        factor[k, k], factor[k + 1:, k] = pivot, column / pivot
        rest[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def rotated(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor times rotations that make its columns orthogonal, by falling norm."""
    g = factor.T.copy()            # rows here are the columns of the factor
    for _ in range(sweeps):
        worst = 0.0
        for i in range(len(g) - 1):
            for j in range(i + 1, len(g)):
                alpha, beta, gamma = g[i] @ g[i], g[j] @ g[j], g[i] @ g[j]
                off = abs(gamma) / np.sqrt(alpha * beta) if alpha * beta > 0 else 0.0
                worst = max(worst, off)
                if off <= 1e-16:
                    continue
                zeta = (beta - alpha) / (2.0 * gamma)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.hypot(1.0, t)
                g[i], g[j] = c * (g[i] - t * g[j]), c * (t * g[i] + g[j])
        if worst <= 1e-15:
            break
    return g[np.argsort(-(g ** 2).sum(axis=1), kind="stable")].T


@dataclass
class Whitening:
    """What is needed to whiten a vector: ``components`` are columns."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / max(1, self.n)

    @property
    def basis(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)

    def identity_error(self, fit: DataFrame) -> float:
        """The largest entry of the whitened vectors' covariance minus the identity."""
        got = products(fit, self.mean, self.basis) / max(1, self.n)
        return float(np.abs(got - np.eye(len(got))).max(initial=0.0))


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """From distinct vectors ``x``; signs make each component's largest entry positive."""
    n, total = sums(fit)
    if n == 0 or len(total) == 0:
        return Whitening(n, total, np.zeros((len(total), 0)), np.zeros(0), 0.0)
    scatter = products(fit, total / n, np.eye(len(total)))
    factor, order = pivoted_cholesky(scatter / n)
    turned = rotated(factor)
    values = (turned ** 2).sum(axis=0)
    vectors = np.empty_like(turned)
    vectors[order] = turned / np.sqrt(values)
    vectors, kept = vectors[:, :components], values[:components]
    if len(kept):
        peak = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(kept))]
        vectors = vectors * np.sign(peak)
    return Whitening(n, total, vectors, kept, float(np.trace(scatter) / n))


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Exact sums of (n * x - total) ** 2 by row; None where a long can't hold one."""
    far = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + int(
        np.abs(total).max(initial=0))
    if x.shape[1] * far * far <= _MOST:
        return ((n * x - total) ** 2).sum(axis=1).tolist()
    wide = n * x.astype(object) - total.astype(object)
    return [v if v <= _MOST else None for v in (wide * wide).sum(axis=1).tolist()]


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component.

    key, component (from 1), n, deviation, whitened, explained, identity_error.
    """
    good = usable(rows.select(key, vector), vector)
    fit = write_through(good.select("x").distinct())
    model = fit_whitening(fit, components)
    error = model.identity_error(fit) if len(model.eigenvalues) else 0.0
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.eigenvalues)
        number, share = np.arange(1, k + 1, dtype=np.int32), m.eigenvalues / m.trace
        for batch in batches:
            for a in range(0, batch.num_rows if k else 0, 4096):
                some = batch.slice(a, 4096)
                x, r = _matrix(some.column("x")), some.num_rows
                each = pa.array(np.repeat(np.arange(r), k))
                far = pa.array(deviations(x, m.n, m.sums), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(key).take(each), pa.array(np.tile(number, r)),
                     pa.array(np.full(r * k, m.n)), far.take(each),
                     pa.array(((x - m.mean) @ m.basis).reshape(-1)),
                     pa.array(np.tile(share, r)), pa.array(np.full(r * k, error))],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    kind = rows.schema[key].dataType.simpleString()
    return good.select(key, "x").mapInArrow(
        run, f"`{key}` {kind}, component int, n long, deviation long, whitened double, "
             "explained double, identity_error double")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
