"""Whitening by FEAST: eigenvalues of the covariance by contour integration (operator 13).

The rows are only ever summed: exact component sums, then the centred second moments, a matrix of
dims x dims a task, added up by Spark. On that matrix V:

* inertia counts (signs of the pivots of a symmetric LDL' of V - s I) say how many eigenvalues lie above
  any s; bisection on them places the cut below the wanted components and slices the
  interval above it into pieces of a few eigenvalues;
* for a slice the projector onto its eigenspace is a contour integral of (z I - V)^-1 over a
  circle around it, taken by Gauss-Legendre quadrature: every node is one complex shifted solve, and the
  nodes of all slices are Spark tasks;
* Rayleigh-Ritz on the filtered block gives the slice's eigenpairs; the block is filtered again until as many
  residuals vanish inside the slice as the inertia counts found there, so none is missed.

V, the blocks and the solves' results are bounded by dims^2 numbers a slice, whatever the number of rows.

Defined results: rows with a NULL vector, or NULL or non-finite entries, are dropped by the caller
(:func:`adcredit.llm.vectors.usable`); missing last entries (shorter and empty vectors) take ``fill``; every
row counts for itself, also when ids repeat or are NULL; components without variance (eigenvalue
below 1e-12 of the trace) cannot be whitened and are not returned, so one row, or equal rows only, give
none; equal eigenvalues share their space in some orthonormal basis, the same for all rows; each
component's largest entry is positive; a deviation that does not fit a long is NULL; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adcredit.llm.common import discard, lean, written
from adcredit.llm.vectors import column_sums, matrix, padded

#: Residual of an eigenpair, as a share of V's norm.
ACCURACY = 1e-13
SLICE = 3


def inertia(a: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix: signs of Bunch-Kaufman pivots."""
    a = a.copy()
    positive, threshold = 0, (1 + 17 ** 0.5) / 8
    while len(a):
        column = np.abs(a[1:, 0])
        if not len(column) or not column.any():
            positive += a[0, 0] > 0
            a = a[1:, 1:]
            continue
        r = 1 + int(column.argmax())
        most = column[r - 1]
        if abs(a[0, 0]) >= threshold * most:
            swap, size = None, 1
        else:
            beyond = np.abs(a[:, r])
            beyond[r] = 0
            if abs(a[0, 0]) * beyond.max() >= threshold * most ** 2:
                swap, size = None, 1
            elif abs(a[r, r]) >= threshold * beyond.max():
                swap, size = (0, r), 1
            else:
                swap, size = (1, r), 2
        if swap is not None:
            i, j = swap
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
        pivot, left = a[:size, :size], a[size:, :size]
        # a 2 x 2 pivot is only chosen when its determinant is negative: one sign each
        positive += 1 if size == 2 else int(pivot[0, 0] > 0)
        a = a[size:, size:] - left @ np.linalg.solve(pivot, left.T)
    return int(positive)


class Spectrum:
    """How many eigenvalues of ``v`` lie above a number."""

    def __init__(self, v: np.ndarray):
        self.v, self.eye = v, np.eye(len(v))
        self.top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)      # Gershgorin: none above

    def above(self, s: float) -> int:
        return inertia(self.v - s * self.eye)

    def where(self, count: int, low: float) -> float:
        """The least s above ``low``, to a bisection's accuracy, with at most ``count`` eigenvalues above."""
        high = self.top
        for _ in range(60):
            s = (low + high) / 2
            if high - low <= 1e-13 * self.top or s in (low, high):
                break
            low, high = (low, s) if self.above(s) <= count else (s, high)
        return high

    def slices(self, k: int) -> list[tuple[float, float, int]]:
        """(low, high, eigenvalues inside) of intervals that hold the k largest eigenvalues."""
        floor = 1e-12 * float(np.trace(self.v))
        k = min(k, self.above(floor))
        if not k:
            return []
        next_one = max(self.where(k, 0.0), floor)               # at the (k+1)-th eigenvalue
        last = self.where(k - 1, next_one)                      # at the k-th
        cut = (next_one + last) / 2
        if last - next_one <= 1e-11 * self.top:                 # no gap: take the whole cluster
            cut = max(next_one - 1e-10 * self.top, floor)
        out, todo = [], [(cut, self.top, self.above(cut), 0)]
        while todo:
            low, high, above_low, above_high = todo.pop()
            n = above_low - above_high
            if not n:
                continue
            if n <= SLICE and high - low <= 0.1 * self.top or high - low <= 1e-8 * self.top:
                out.append((low, high, n))
                continue
            mid = (low + high) / 2
            above = self.above(mid)
            todo += [(low, mid, above_low, above), (mid, high, above, above_high)]
        return sorted(out)


def _solves(shared) -> callable:
    """``mapInPandas`` over (slice, node): weighted (z I - V)^-1 Y of each node."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, blocks = shared.value
        for df in frames:
            out = []
            for r in df.itertuples():
                x = np.linalg.solve((r.re + 1j * r.im) * np.eye(len(v)) - v, blocks[r.piece])
                out.append(((r.w_re + 1j * r.w_im) * x).real.tobytes())
            yield pd.DataFrame({"piece": df["piece"], "x": out})

    return lean(run)


def contour(low: float, high: float, nodes: int) -> list[tuple[complex, complex]]:
    """(z, weight) on the upper half of the circle through ``low`` and ``high``; the lower is its conjugate."""
    at, weight = np.polynomial.legendre.leggauss(nodes)
    radius = (high - low) / 2
    turn = radius * np.exp(1j * np.pi / 2 * (at + 1))
    return list(zip((low + high) / 2 + turn, weight * turn / 2))


def eigenpairs(spark: SparkSession, v: np.ndarray, k: int, nodes: int = 16,
               rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of the symmetric positive semidefinite ``v``, falling, and unit vectors."""
    dims, spectrum = len(v), Spectrum(v)
    pieces = spectrum.slices(k)
    rng = np.random.default_rng(0)
    blocks = {p: np.linalg.qr(rng.standard_normal((dims, min(dims, 2 * n + 6))))[0]
              for p, (_, _, n) in enumerate(pieces)}
    scale, found = float(np.linalg.norm(v, 2)) if pieces else 0.0, {}
    points = {p: contour(low, high, nodes) for p, (low, high, _) in enumerate(pieces)}
    for _ in range(rounds):
        left = [p for p in blocks if p not in found]
        if not left:
            break
        shared = spark.sparkContext.broadcast((v, {p: blocks[p] for p in left}))      # dims^2 numbers
        rows = [(p, float(z.real), float(z.imag), float(w.real), float(w.imag))
                for p in left for z, w in points[p]]
        work = spark.createDataFrame(rows, "piece int, re double, im double, w_re double, w_im double") \
            .repartition(min(len(rows), spark.sparkContext.defaultParallelism))
        sums = {p: np.zeros_like(blocks[p]) for p in left}
        for r in work.mapInPandas(_solves(shared), "piece int, x binary").collect():
            sums[r["piece"]] += np.frombuffer(r["x"]).reshape(blocks[r["piece"]].shape)
        shared.destroy()
        for p in left:
            q = np.linalg.qr(sums[p])[0]
            values, ritz = np.linalg.eigh(q.T @ v @ q)                                 # Rayleigh-Ritz
            blocks[p] = q @ ritz
            low, high, n = pieces[p]
            residual = np.linalg.norm(v @ blocks[p] - blocks[p] * values, axis=0)
            inside = (values > low) & (values <= high) & (residual <= ACCURACY * scale)
            if inside.sum() == n:                                                      # none is missed
                found[p] = blocks[p][:, inside]
    missing = [pieces[p] for p in blocks if p not in found]
    if missing:
        raise RuntimeError(f"contour integration did not find the eigenvalues of {missing}")
    if not pieces:
        return np.empty(0), np.empty((dims, 0))
    q = np.linalg.qr(np.hstack([found[p] for p in sorted(found)]))[0]
    values, ritz = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-values, kind="stable")[:k]
    u = (q @ ritz)[:, order]
    u /= np.linalg.norm(u, axis=0)
    u *= np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return values[order], u


def covariance(rows: DataFrame, column: str, dims: int, n: int, sums: np.ndarray) -> np.ndarray:
    """Centred second moments over n: one matrix a task, added element by element in Spark."""
    mean = sums / n

    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            c = matrix(b.column(0), dims) - mean
            total += c.T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(dims, dtype=np.int32), dims)),
             pa.array(np.tile(np.arange(dims, dtype=np.int32), dims)), pa.array(total.ravel())],
            ["i", "j", "s"])

    out = np.zeros((dims, dims))
    for r in rows.select(column).mapInArrow(lean(run), "i int, j int, s double") \
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect():            # dims^2 rows
        out[r["i"], r["j"]] = r["s"]
    return (out + out.T) / (2 * n)


def _whitener(dims: int, n: int, sums: np.ndarray, basis: np.ndarray):
    mean, limit = sums / n, 2 ** 63 - 1

    def deviations(x):
        largest = np.abs(x.astype(float)).max(initial=0.0) * n + np.abs(sums.astype(float)).max(initial=0.0)
        if dims * largest ** 2 < 2 ** 62:
            y = n * x - sums
            return (y * y).sum(axis=1).tolist()
        exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in x.tolist()]
        return [d if d <= limit else None for d in exact]

    def run(batches):
        for b in batches:
            x = matrix(b.column(1), dims)
            w = (x - mean) @ basis
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(deviations(x), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1],
                                                   pa.int32()), pa.array(w.ravel()))],
                ["id", "deviation", "w"])

    return lean(run)


def whiten(rows: DataFrame, k: int = 8, id_col: str = "vec_id", vector_col: str = "x", fill: int = 0,
           nodes: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), k rows an input row."""
    if k < 1 or nodes < 2:
        raise ValueError("k must be positive, nodes at least 2")
    spark = rows.sparkSession
    names = f"{id_col} long, component int, n long, deviation long, whitened double, " \
            "explained double, identity_error double"
    x = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x")).filter("x IS NOT NULL")
    n, dims = x.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n or not dims:
        return spark.createDataFrame([], names)
    x = written(x.withColumn("x", padded("x", dims, fill)), "whiten-rows")
    sums = column_sums(x, "x", dims)
    v = covariance(x, "x", dims, n, sums)
    values, u = eigenpairs(spark, v, k, nodes)
    if not len(values):
        discard(x)
        return spark.createDataFrame([], names)
    scores = written(x.mapInArrow(_whitener(dims, n, sums, u / np.sqrt(values)),
                                  "id long, deviation long, w array<double>"), "whiten-scores")
    discard(x)
    m = len(values)
    means = scores.agg(*(F.avg(F.col("w")[i]) for i in range(m))).first()
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    moments = scores.agg(*(F.sum((F.col("w")[i] - means[i]) * (F.col("w")[j] - means[j])) / n
                           for i, j in pairs)).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(moments, pairs))
    explained = F.array(*(F.lit(float(e / np.trace(v))) for e in values))
    return scores.select(F.col("id").alias(id_col), F.lit(n).cast("long").alias("n"), "deviation",
                         F.posexplode("w").alias("at", "whitened")) \
        .select(id_col, (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                explained[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"))
