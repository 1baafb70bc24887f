"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every word stands for two tokens: a bucket of its bytes and a bucket of its shape (kinds
of characters, length, whether it repeats the word before). Each token owns a sparse
ternary index vector. The vector of a token is the sum of the index vectors that occur
next to it in the labelled sample, so tokens used alike lie close together. A document is
the mean of its token vectors; a small network scores it, and a temperature fitted on
rows that the network has not seen calibrates the probability.

Labels are learnt from at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash
of the identifier. Scoring covers whole texts of all rows.

Defined results: an empty or null text has zero vectors and gets the score the network
gives them. Without labels of both kinds every score is the share of good rows (0.5
without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import (
    bounds_of,
    durable,
    mix,
    owners,
    string_buffers,
    text_slices,
    word_bounds,
    word_hashes,
)

TRAIN_ROWS = 8_000
DIM = 48
WORDS, SHAPES = 1 << 14, 1 << 12
NONZERO = 8
HIDDEN = 24
EPOCHS = 30
THRESHOLD = 0.3
FEATURES = 2 * DIM + 1
SLICE = 1 << 19

_KIND = np.full(256, 1, np.uint8)  # letters beyond ASCII and the rest
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[97:123] = 2
_KIND[65:91] = 4
_KIND[48:58] = 8
_KIND[[46, 44, 59, 58, 39, 34, 45, 40, 41, 63]] = 16
_KIND[[33, 35, 36, 37, 38, 42, 60, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] = 32


def index_vectors() -> np.ndarray:
    """A ternary vector with few entries for every token, from its number alone."""
    rows = np.arange(WORDS + SHAPES, dtype=np.uint64)
    out = np.zeros((WORDS + SHAPES, DIM), np.float32)
    for k in range(NONZERO):
        h = mix(rows * np.uint64(NONZERO) + np.uint64(k + 1))
        sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
        np.add.at(out, (rows.astype(np.int64), (h % np.uint64(DIM)).astype(np.int64)), sign)
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of the word, bucket of its shape, row) of every word."""
    data, offsets = string_buffers(column)
    starts, ends = word_bounds(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none
    rows = owners(offsets, starts)
    hashes = word_hashes(data, starts, ends)
    kinds = _KIND[data]
    present = np.bitwise_or.reduceat(kinds, starts).astype(np.uint64)
    length = np.minimum(ends - starts, 15).astype(np.uint64) // np.uint64(3)
    repeats = np.zeros(len(starts), np.uint64)
    repeats[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    shape = present
    for part, width in ((kinds[starts], 6), (kinds[ends - 1], 6), (length, 3), (repeats, 1)):
        shape = (shape << np.uint64(width)) | part.astype(np.uint64)
    words = (hashes % np.uint64(WORDS)).astype(np.int64)
    shapes = (mix(shape) % np.uint64(SHAPES)).astype(np.int64) + WORDS
    return words, shapes, rows


def neighbours(words: np.ndarray, shapes: np.ndarray, rows: np.ndarray, index: np.ndarray):
    """Sum of the index vectors of the words one before and one behind, in the same row."""
    own = index[words] + index[shapes]
    near = np.zeros_like(own)
    same = (rows[1:] == rows[:-1])[:, None]
    near[1:] += own[:-1] * same
    near[:-1] += own[1:] * same
    return near


def _partial_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Context sums of one task, for the tokens it saw."""
    index = index_vectors()
    sums = np.zeros((WORDS + SHAPES, DIM), np.float32)
    for part in text_slices(batches, SLICE):
        words, shapes, rows = tokens(part.column("text"))
        if not len(words):
            continue
        near = neighbours(words, shapes, rows, index)
        for ids in (words, shapes):
            order = np.argsort(ids, kind="stable")
            first = np.flatnonzero(np.diff(ids[order], prepend=-1))
            sums[ids[order][first]] += np.add.reduceat(near[order], first)
    seen = np.flatnonzero(np.abs(sums).sum(axis=1))
    yield pa.record_batch(
        [pa.array(seen), pa.array([sums[i].tobytes() for i in seen], pa.binary())],
        ["token", "sums"],
    )


def _added_up(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((WORDS + SHAPES, DIM), np.float32)
    values = np.frombuffer(b"".join(pdf["sums"]), np.float32).reshape(-1, DIM)
    np.add.at(total, pdf["token"].to_numpy(), values)
    seen = np.unique(pdf["token"])
    return pd.DataFrame({"token": seen, "sums": [total[i].tobytes() for i in seen]})


def token_vectors(sample: DataFrame) -> np.ndarray:
    """One vector per token from the sample; a table of fixed size, 4 MB."""
    partial = sample.select("text").mapInArrow(_partial_contexts, "token long, sums binary")
    group = F.expr("token div 512")
    summed = partial.groupBy(group).applyInPandas(_added_up, "token long, sums binary")
    vectors = index_vectors() * np.float32(0.5)
    for row in summed.collect():
        context = np.frombuffer(row.sums, np.float32)
        vectors[row.token] += context / (np.linalg.norm(context) + 1e-6)
    return vectors


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector and log length of every row."""
    words, shapes, rows = tokens(column)
    out = np.zeros((len(column), FEATURES), np.float32)
    if len(words):
        edges = bounds_of(rows, len(column))
        counts = np.diff(edges)
        full = np.flatnonzero(counts)
        for k, ids in enumerate((words, shapes)):
            sums = np.add.reduceat(vectors[ids], edges[full])
            out[full, k * DIM : (k + 1) * DIM] = sums / counts[full, None]
        out[:, -1] = np.log1p(counts) / 8
    return out


@dataclass(frozen=True)
class Network:
    """Two layers with a temperature; ``base`` answers alone when nothing could be learnt."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float
    base: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.mean) / self.scale) @ self.hidden + self.hidden_bias, 0)
        return h @ self.out + self.out_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(x), self.base)
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Adam on the log loss over four fifths of the rows, the temperature on the rest."""
    rng = np.random.default_rng(seed)
    none = np.zeros(0)
    if len(np.unique(y)) < 2:
        base = float(y.mean()) if len(y) else 0.5
        return Network(none, none, none, none, none, 0.0, 1.0, base)
    order = rng.permutation(len(x))
    cut = max(1, len(x) * 4 // 5)
    fit, rest = order[:cut], order[cut:]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    z, target = (x[fit] - mean) / scale, y[fit]
    params = [
        rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
        np.zeros(1),
    ]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(z))
        for begin in range(0, len(z), 128):
            rows = shuffled[begin : begin + 128]
            a, b = z[rows], target[rows]
            raw = a @ params[0] + params[1]
            h = np.maximum(raw, 0)
            error = (sigmoid(h @ params[2] + params[3]) - b) / len(rows)
            back = np.outer(error, params[2]) * (raw > 0)
            grads = [a.T @ back, back.sum(axis=0), h.T @ error, error.sum(keepdims=True)]
            grads[0] = grads[0] + 1e-4 * params[0]
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    plain = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if not len(rest):
        return plain
    logits = plain.logits(x[rest])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 41))

    def loss(t: float) -> float:
        p = np.clip(sigmoid(logits / t), 1e-9, 1 - 1e-9)
        return float(-np.mean(y[rest] * np.log(p) + (1 - y[rest]) * np.log(1 - p)))

    best = float(min(grid, key=loss))
    return Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), best)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, quality of a bounded number of labelled rows that are not held out.

    The labels chosen are ``rows`` at most, a bounded table, and so may be broadcast.
    """
    chosen = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel:
    """Fit on a bounded sample; what reaches the driver is bounded by ``rows`` and the
    token table: one pooled vector for each sampled row and one vector for each token."""
    spark = docs.sparkSession
    sample = durable(training_sample(docs, labels, rows))
    vectors = token_vectors(sample)
    shared = spark.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE):
            x = pooled(part.column("text"), shared.value)
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    part.column("quality").cast(pa.int32()),
                    pa.array([row.tobytes() for row in x], pa.binary()),
                ],
                ["doc_id", "quality", "x"],
            )

    got = sample.select("doc_id", "quality", "text").mapInArrow(
        features, "doc_id long, quality int, x binary"
    )
    table = got.toPandas().sort_values(["doc_id", "x"])
    x = np.frombuffer(b"".join(table["x"]), np.float32).reshape(-1, FEATURES)
    return QualityModel(vectors, fit_network(x.astype(np.float64), table["quality"].to_numpy()))


def score(docs: DataFrame, model: QualityModel, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default) and ``score``, the probability of good quality.

    A column ``score`` that the documents already have is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = "text" if "text" in keep else "_body"
    given = docs.select(*keep) if "text" in keep else docs.select(*keep, F.col("text").alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in text_slices(batches, SLICE, body):
            p = own.network.probability(pooled(part.column(body), own.vectors))
            columns = [part.column(c) for c in keep]
            yield pa.record_batch([*columns, pa.array(p.astype(np.float64))], [*keep, "score"])

    return given.mapInArrow(run, docs.select(*keep, F.lit(0.0).alias("score")).schema)
