"""Whitening of embeddings: streaming covariance, symmetric QR, projection.

Each task runs Welford's rank-one update over its rows. The tasks' moments are merged by the
parallel update formula, first in MERGE groups and then in one, so that no task gets more
than one part in MERGE of them and the driver gets a single row. The driver solves the
``dims x dims`` eigenproblem by symmetric QR: Householder reflections to tridiagonal form,
then implicit QR steps with Wilkinson's shift.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.vectors import grid_vectors, matrix
from lumenpath.session import checkpoint

COMPONENTS, MERGE = 16, 256
EPS = np.finfo(float).eps


class Moments:
    """Count, exact sums (of integers), mean and centred second moments of the rows seen."""

    def __init__(self, dims: int) -> None:
        self.n, self.mean, self.m2 = 0, np.zeros(dims), np.zeros((dims, dims))
        self.sums = np.zeros(dims, dtype=object)

    def add(self, rows: np.ndarray) -> None:
        """One rank-one update a row."""
        mean, m2, step = self.mean, self.m2, np.empty_like(self.m2)
        for row in rows.astype(float):
            self.n += 1
            off = row - mean
            mean += off / self.n
            np.multiply.outer(off, row - mean, out=step)
            m2 += step
        if rows.dtype == np.int64:
            self.sums = self.sums + rows.sum(0).astype(object)

    def merge(self, other: Moments) -> Moments:
        """Take in what another task saw."""
        n = self.n + other.n
        if other.n:
            off = other.mean - self.mean
            self.m2 += other.m2 + np.multiply.outer(off, off) * (self.n * other.n / n)
            self.mean += off * (other.n / n)
            self.n, self.sums = n, self.sums + other.sums
        return self

    def covariance(self) -> np.ndarray:
        return (self.m2 + self.m2.T) / (2 * max(self.n, 1))


def moments(rows: DataFrame, dims: int, kernel: Callable[[np.ndarray], np.ndarray] | None = None, width: int | None = None) -> Moments:
    """The moments of ``kernel`` (None: as they are) of the vectors ``x`` of a table, in whatever order tasks see them."""
    width = width or dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Moments(width)
        for batch in batches:
            x = matrix(batch.column(0), dims)
            own.add(kernel(x) if kernel else x)
        if own.n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % MERGE], pa.int32()), pa.array([pickle.dumps(own)], pa.binary())], names=["slot", "made"])

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        total = Moments(width)
        for made in frame["made"]:
            total.merge(pickle.loads(made))
        return pd.DataFrame({"slot": [0], "made": [pickle.dumps(total)]})

    parts = rows.select("x").mapInArrow(run, "slot int, made binary")
    for _ in range(2):
        parts = parts.groupBy("slot").applyInPandas(merged, "slot int, made binary")
    got = parts.collect()
    return pickle.loads(got[0]["made"]) if got else Moments(width)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with ``q.T @ a @ q`` tridiagonal, by Householder reflections."""
    a, n = a.copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix.

    An off-diagonal entry within rounding of its neighbours counts as zero and splits the
    problem. A vector's sign is such that its largest entry is positive.
    """
    d, e, q = tridiagonal(np.asarray(a, dtype=float))
    q, high, steps = np.ascontiguousarray(q.T), len(d) - 1, 0
    while high > 0:
        small = np.abs(e[:high]) <= EPS * (np.abs(d[:high]) + np.abs(d[1 : high + 1]))
        e[:high][small] = 0
        if e[high - 1] == 0:
            high, steps = high - 1, 0
            continue
        low = int(np.flatnonzero(e[:high] == 0)[-1]) + 1 if (e[:high] == 0).any() else 0
        steps += 1
        if steps > 100:
            raise ArithmeticError("the QR iteration does not converge")
        half = (d[high - 1] - d[high]) / 2
        under = half + np.copysign(np.hypot(half, e[high - 1]), half)
        x, z = d[low] - (d[high] - e[high - 1] ** 2 / under), e[low]
        for k in range(low, high):
            r = np.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > low:
                e[k - 1] = r
            dk, dn, ek = d[k], d[k + 1], e[k]
            d[k] = c * c * dk + 2 * c * s * ek + s * s * dn
            d[k + 1] = s * s * dk - 2 * c * s * ek + c * c * dn
            e[k] = c * s * (dn - dk) + (c * c - s * s) * ek
            q[k : k + 2] = np.array([[c, s], [-s, c]]) @ q[k : k + 2]
            if k < high - 1:
                x, z = e[k], s * e[k + 1]
                e[k + 1] *= c
    order = np.argsort(-d, kind="stable")
    vectors = q[order]
    if len(vectors):
        vectors *= np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)])[:, None]
    return d[order], vectors.T


@dataclass
class Whitener:
    """A fitted projection: ``dims`` of its vectors, their number ``n`` and exact ``sums``, eigenvalues and eigenvectors, and how far the result is from white."""

    dims: int
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: int64 if that is wide enough, else Python's integers."""
        wide = self.n * int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0)) >= 1 << 62
        return x.astype(object) * self.n - self.sums if wide else x * self.n - self.sums.astype(np.int64)

    def alive(self) -> np.ndarray:
        """Components with a variance beyond rounding."""
        return self.values > self.dims * EPS * max(self.values.max(initial=0), 0)

    def project(self, offsets: np.ndarray) -> np.ndarray:
        """The centred vectors on the components with a variance, each over the root of its eigenvalue."""
        live = self.alive()
        return (offsets.astype(float) / self.n) @ (self.vectors[:, live] / np.sqrt(self.values[live]))

    def deviations(self, offsets: np.ndarray) -> pa.Array:
        """The squared lengths of the offsets, exact, as decimals."""
        if offsets.dtype == object or int(np.abs(offsets).max(initial=0)) ** 2 * self.dims >= 1 << 62:
            return pa.array([Decimal(sum(int(v) ** 2 for v in row)) for row in offsets], pa.decimal128(38, 0))
        return pa.array((offsets**2).sum(1)).cast(pa.decimal128(38, 0))


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on the distinct vectors of ``x(x array<int>)``; of the length that most of them have (ties: the longer one). None if there are none."""
    once = checkpoint(x.select("x").distinct())
    common = once.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if not common or not common["dims"]:
        return None
    dims = common["dims"]
    once = once.where(F.size("x") == dims)
    seen = moments(once, dims)
    values, vectors = symmetric_qr(seen.covariance())
    made = Whitener(dims, seen.n, seen.sums, values[:components], vectors[:, :components], float(np.trace(seen.covariance())))
    live = int(made.alive().sum())
    if live:
        white = moments(once, dims, lambda rows: made.project(made.offsets(rows)), live)
        made.identity_error = float(np.abs(white.covariance() - np.eye(live)).max())
    return made


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Whitener | None]:
    """(``vec_id, deviation, whitened array<double>`` of every vector, the fitted Whitener).

    Entries become integers ``floor(64 c)`` (adding a constant to them changes nothing here).
    Rows whose vector is null or has a null or non-finite entry are left out, and so are those
    of another length than most distinct vectors have: they share no covariance. The fit counts
    each distinct vector once; every row is whitened, repeated ones and null ids too. A component
    without variance (constant or dependent dimensions, fewer vectors than dimensions) has null.
    An empty table gives no rows and None; extra columns are ignored. Beyond 2**21 an entry is
    an error. ``deviation`` is the exact sum of ``(n x - S)**2`` as decimal.
    """
    vectors = grid_vectors(df, id_col, vector_col)
    made = fit(vectors, components)
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    if made is None:
        return df.sparkSession.createDataFrame([], schema), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = made.alive()
        for batch in batches:
            off = made.offsets(matrix(batch.column("x"), made.dims))
            out = np.zeros((len(off), len(live)))
            out[:, live] = made.project(off)
            flat = pa.array(out.ravel(), mask=np.tile(~live, len(off)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(off) + 1) * len(live), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), made.deviations(off), lists], names=["vec_id", "deviation", "whitened"])

    return vectors.where(F.size("x") == made.dims).mapInArrow(run, schema), made


def components_of(df: DataFrame, components: int = COMPONENTS, **columns) -> DataFrame:
    """``whiten`` with one row for each vector and component, and the fit's figures beside them; a deviation beyond a long is null."""
    rows, made = whiten(df, components, **columns)
    each = rows.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    share = [] if made is None or not made.trace else [float(v / made.trace) for v in made.values]
    explained = F.get(F.array(*[F.lit(v) for v in share]).cast("array<double>"), F.col("at"))
    said = [F.lit(made.n if made else 0).cast("long").alias("n"), F.lit(made.identity_error if made else None).cast("double").alias("identity_error")]
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), said[0], "deviation", "whitened", explained.alias("explained"), said[1])
