"""Whitening of embeddings by an incremental eigendecomposition of their covariance.

A spectrum holds the number of vectors, their mean, and the eigenvalues and eigenvectors of
their scatter around it. A partition starts with an empty one and takes its vectors in blocks.
A block is centred on its own mean and rotated into triangular form, which keeps its scatter
and leaves at most one row a dimension; each of these rows, and the step between the means,
is a centred rank-one update: the new eigenvalues are the roots of the secular equation,
after tiny components and equal eigenvalues have been deflated. Two spectra are combined the
same way, by the eigenvectors of one as successive updates of the other, in a tree of small
groups. At last one distributed pass projects the covariance on the combined eigenvectors
(Rayleigh-Ritz) and the small projected matrix rotates them to full precision.

Defined results: rows whose vector is null or holds nulls or non-finite components are left
out, all others are returned, repeated rows each; vectors shorter than the longest one are
padded with zeros. A component without variance (fewer distinct vectors than components, or
constant ones) has a null ``whitened`` value and is not part of ``identity_error``, which is
null when no component has variance. ``explained`` is null when nothing varies. ``deviation``
is null where it exceeds 64 bits. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.centroid_clusters import integers, usable
from barloom.llm.common import durable

SCALE = 256
COMPONENTS = 4
BLOCK = 4096
GROUP = 16
PARTIAL = "part long, state binary"
WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)
EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z^T as (pole, offset from it) for rising d, z without zeros.

    Root j lies between pole j and pole j + 1, the last one at most |z|^2 above its pole. Each
    is measured from the nearer pole, so that differences to all poles keep their digits.
    Both halves of the secular function are replaced by one pole each, with equal value and
    slope; where that step leaves the bracket, it is halved.
    """
    k = len(d)
    z2 = z * z
    gap = np.append(np.diff(d), z2.sum())
    j = np.arange(k)
    middle = d + gap / 2
    value = 1 + (z2 / (d[None, :] - middle[:, None])).sum(axis=1)
    right = (value < 0) & (j < k - 1)
    pole = np.where(right, j + 1, j)
    delta = d[None, :] - d[pole][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap)
    inner = (value >= 0) & (j < k - 1)
    high[inner] = gap[inner] / 2
    if value[-1] < 0:
        low[-1] = gap[-1] / 2
    else:
        high[-1] = gap[-1] / 2
    left = j[None, :] <= j[:, None]
    d1 = delta[j, j]
    d2 = np.where(j < k - 1, delta[j, np.minimum(j + 1, k - 1)], np.inf)
    t = (low + high) / 2
    with np.errstate(all="ignore"):
        for _ in range(100):
            away = delta - t[:, None]
            term = z2 / away
            slope = term / away
            psi, phi = (term * left).sum(axis=1), (term * ~left).sum(axis=1)
            f = 1 + psi + phi
            low = np.where(f < 0, t, low)
            high = np.where(f >= 0, t, high)
            a1, a2 = d1 - t, np.where(np.isinf(d2), 1.0, d2 - t)
            dpsi, dphi = (slope * left).sum(axis=1), (slope * ~left).sum(axis=1)
            q, s = dpsi * a1 * a1, dphi * a2 * a2
            c = 1 + psi - dpsi * a1 + phi - dphi * a2
            # c + q / (a1 - x) + s / (a2 - x) = 0 for the step x
            b = c * (a1 + a2) + q + s
            e = f * a1 * a2
            root = np.sqrt(np.maximum(b * b - 4 * c * e, 0))
            step = np.where(b >= 0, 2 * e / (b + root), (b - root) / (2 * c))
            step[-1] = a1[-1] + q[-1] / c[-1]
            fresh = t + step
            half = (low + high) / 2
            inside = (fresh > low) & (fresh < high)
            fresh = np.where(inside, fresh, half)
            exact = np.abs(f) <= 4 * EPS * (1 + np.abs(psi) + np.abs(phi))
            done = exact | (np.abs(fresh - t) <= 2 * EPS * np.abs(fresh))
            t = np.where(exact, t, fresh)
            if done.all():
                break
    return pole, t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray):
    """Eigenvalues (rising) and eigenvectors of vectors diag(values) vectors^T + v v^T."""
    z = vectors.T @ v
    norm = np.linalg.norm(z)
    if not norm:
        return values, vectors
    tiny = 4 * EPS * max(values[-1], norm * norm)
    moving = np.abs(z) * norm > tiny
    # Equal eigenvalues: a rotation moves the weight of one onto its neighbour.
    vectors, z = vectors.copy(), z.copy()
    last = -1
    for i in np.flatnonzero(moving):
        if last >= 0 and values[i] - values[last] <= tiny:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            a, b = vectors[:, last].copy(), vectors[:, i].copy()
            vectors[:, last], vectors[:, i] = c * a - s * b, s * a + c * b
            z[last], z[i] = 0.0, r
            moving[last] = False
        last = i
    at = np.flatnonzero(moving)
    if not len(at):
        return values, vectors
    d = values[at]
    pole, t = secular_roots(d, z[at])
    # differences d_i - root_j, then the weights for which the roots are exact
    away = (d[:, None] - d[pole][None, :]) - t[None, :]
    spread = d[:, None] - d[None, :]
    np.fill_diagonal(spread, 1.0)
    ratio = -away / np.where(spread == 0, 1.0, -spread)
    diagonal = np.diagonal(away).copy()
    np.fill_diagonal(ratio, 1.0)
    weight = np.sqrt(np.abs(np.prod(ratio, axis=1) * diagonal)) * np.sign(z[at])
    small = weight[:, None] / np.where(away == 0, EPS * tiny, away)
    small /= np.linalg.norm(small, axis=0)
    out = values.copy()
    out[at] = d[pole] + t
    vectors[:, at] = vectors[:, at] @ small
    order = np.argsort(out, kind="stable")
    return out[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean and eigendecomposition of the scatter of some vectors; exact sums beside."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    total: list[int]
    squares: int

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d), [0] * d, 0)

    def _shift(self, n: int, mean: np.ndarray) -> None:
        """Count ``n`` further vectors with this mean; the step between the means is a rank-one
        part of the scatter."""
        step, both = mean - self.mean, self.n + n
        if self.n:
            self._update(step * np.sqrt(self.n * n / both))
        self.mean = self.mean + step * (n / both)
        self.n = both

    def _update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def add(self, x: np.ndarray) -> None:
        """Take in a block of integer vectors."""
        own = x.astype(float)
        mean = own.mean(axis=0)
        if len(x) > 1:
            for row in np.linalg.qr(own - mean, mode="r"):
                self._update(row)
        self._shift(len(x), mean)
        self.total = [a + int(b) for a, b in zip(self.total, x.sum(axis=0), strict=True)]
        self.squares += _sum_of_squares(x)

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self._update(np.sqrt(value) * vector)
        self._shift(other.n, other.mean)
        self.total = [a + b for a, b in zip(self.total, other.total, strict=True)]
        self.squares += other.squares


def _sum_of_squares(x: np.ndarray) -> int:
    most = int(np.abs(x).max()) if x.size else 0
    if most * most * x.size < 1 << 63:
        return int((x * x).sum())
    return sum(v * v for v in x.ravel().tolist())


def vector_blocks(
    batches: Iterator[pa.RecordBatch], dimensions: int, rows: int = BLOCK
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors ``x`` as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, dimensions)


def padded(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows whose vectors ``x`` all have the length of the longest, and that length."""
    sizes = rows.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    low, high = sizes["low"] or 0, sizes["high"] or 0
    if low < high:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(high) - F.size("x"))
        rows = rows.withColumn("x", F.concat("x", zeros))
    return rows, high


def reduced(
    rows: DataFrame, dimensions: int, start: Callable, take: Callable, merge: Callable
) -> object:
    """One state from all rows: a state a task, then groups of ``GROUP`` states at a time.

    ``start()`` makes a state, ``take(state, x)`` and ``merge(state, other)`` return a new one.
    No task holds more than a few states, whatever the number of partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), False
        for _, x in vector_blocks(batches, dimensions):
            state, seen = take(state, x), True
        if seen:
            part = TaskContext.get().partitionId()
            yield pa.record_batch(
                [pa.array([part]), pa.array([pickle.dumps(state)])], ["part", "state"]
            )

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = pdf.sort_values("part")
        state = None
        for raw in parts["state"]:
            other = pickle.loads(raw)
            state = other if state is None else merge(state, other)
        return pd.DataFrame({"part": [parts["part"].iloc[0] // GROUP], "state": [pickle.dumps(state)]})

    states = durable(rows.mapInArrow(run, PARTIAL))
    while states.count() > GROUP:
        states = durable(states.groupBy(F.expr(f"part div {GROUP}")).applyInPandas(join, PARTIAL))
    left = states.orderBy("part").collect()
    if not left:
        return None
    state = pickle.loads(left[0]["state"])
    for row in left[1:]:
        state = merge(state, pickle.loads(row["state"]))
    return state


@dataclass
class Whitener:
    """What the projection needs: exact sums and the leading eigenpairs, falling."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Centred vectors on the components, over the root of the eigenvalue."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return (_centred(x, self.n, self.total) @ self.vectors) / np.sqrt(self.values)


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - total / n, where the whole part of the mean is subtracted exactly."""
    whole = np.array([s // n for s in total], np.int64)
    rest = np.array([(s % n) / n for s in total])
    return (x - whole) - rest


def fit(x: DataFrame, dimensions: int, components: int = COMPONENTS) -> tuple[Whitener, DataFrame]:
    """(whitener, fit list) of integer vectors ``x`` that all have this length; not empty."""
    distinct = durable(x.select("x").distinct())

    def take(state: Spectrum, block: np.ndarray) -> Spectrum:
        state.add(block)
        return state

    def merge(state: Spectrum, other: Spectrum) -> Spectrum:
        state.combine(other)
        return state

    found = reduced(distinct, dimensions, lambda: Spectrum.empty(dimensions), take, merge)
    n, total, basis = found.n, found.total, found.vectors

    def project(state: np.ndarray, block: np.ndarray) -> np.ndarray:
        y = _centred(block, n, total) @ basis
        return state + y.T @ y

    def zeros() -> np.ndarray:
        return np.zeros((dimensions, dimensions))

    small = reduced(distinct, dimensions, zeros, project, lambda a, b: a + b) / n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = basis @ turn[:, ::-1]
    vectors /= np.linalg.norm(vectors, axis=0)
    values = values[::-1]
    # the trace is exact up to its division: n * sum of squares - squares of the sums
    trace = (n * found.squares - sum(s * s for s in total)) / (n * n)
    kept = min(components, dimensions)
    flat = values[:kept] <= dimensions * EPS * max(values[0], 0.0)
    values = np.where(flat, 0.0, values[:kept])
    vectors = vectors[:, :kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    return Whitener(n, total, values, vectors * signs, trace), distinct


def identity_error(model: Whitener, distinct: DataFrame, dimensions: int) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, in size."""
    varying = np.flatnonzero(model.values > 0)
    if not len(varying):
        return None

    def take(state: tuple, block: np.ndarray) -> tuple:
        y = model.whiten(block)[:, varying]
        return state[0] + y.sum(axis=0), state[1] + y.T @ y

    def start() -> tuple:
        return np.zeros(len(varying)), np.zeros((len(varying), len(varying)))

    sums, squares = reduced(
        distinct, dimensions, start, take, lambda a, b: (a[0] + b[0], a[1] + b[1])
    )
    mean = sums / model.n
    cov = squares / model.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(len(varying))).max())


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - total)^2, exact; null beyond 64 bits."""
    low, high = x.min(axis=0).tolist(), x.max(axis=0).tolist()
    reach = sum(
        max(abs(n * a - s), abs(n * b - s)) ** 2
        for a, b, s in zip(low, high, total, strict=True)
    )
    if reach < 1 << 63:
        away = n * x - np.array(total, np.int64)
        return (away * away).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(r, total, strict=True)) for r in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whitened_rows(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for every usable vector and component; columns as in ``WHITENED``."""
    kept = embeddings.filter(usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"), integers(SCALE).alias("x")
    )
    kept, dimensions = padded(kept)
    if not dimensions:
        return embeddings.sparkSession.createDataFrame([], WHITENED)
    model, distinct = fit(kept, dimensions, components)
    error = identity_error(model, distinct, dimensions)
    count = len(model.values)
    explained = [float(v) / model.trace if model.trace else None for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in vector_blocks(batches, dimensions):
            rows = len(x)
            y = model.whiten(x)
            flat = np.broadcast_to(model.values == 0, y.shape).ravel()
            deviation = pa.array(_deviations(x, model.n, model.total), pa.int64())
            again = pa.array(np.repeat(np.arange(rows), count))
            yield pa.record_batch(
                [
                    part.column("vec_id").take(again),
                    pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                    pa.array(np.full(rows * count, model.n)),
                    deviation.take(again),
                    pa.array(y.ravel(), mask=flat),
                    pa.array(explained * rows, pa.float64()),
                    pa.array([error] * (rows * count), pa.float64()),
                ],
                [c.split()[0] for c in WHITENED.split(", ")],
            )

    return kept.mapInArrow(run, WHITENED)
