"""Exact integer k-means over dictionary-encoded blocks of dimensions.

Vectors become integers and are gathered into chunks. In a chunk every block of dimensions
is replaced, without loss, by a dictionary of its distinct subvectors and one code a vector.
Blocks start as single dimensions; neighbours are joined into wider ones while the joined
dictionary stays a small part of the chunk, so repeated vectors and coarse values end in few
wide blocks and continuous values in many narrow ones. Chunks are stored once.

In each round a chunk computes the squared distances of its distinct subvectors to the
centroids once and adds them up by code; sums of the members follow from counts of codes.
Only the centroids travel to the tasks and only one sum a cluster travels back, so memory and
traffic do not grow with the number of vectors and a lost task repeats its own chunks.

Defined results: vectors that are null, have another number of components, or hold nulls or
non-finite components are left out; all other rows are returned, repeated ones each. A null
identifier counts as empty text in the seed hash; ties of that hash go by the vector. With
fewer vectors than clusters every vector is a seed. An empty table gives an empty result.
All arithmetic is exact; vectors so far apart that a squared distance exceeds 64 bits raise
``ArithmeticError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
CHUNK = 32768
# A wider block pays while its dictionary has at most this part of the chunk's vectors.
DENSITY = 16
CHUNKS = "vec_ids array<long>, entries array<array<long>>, codes array<binary>"
SUMS = "cluster int, n long, sums array<long>"
ASSIGNED = "vec_id long, cluster int, distance long"


def usable(vector: str = "embedding", dimensions: int | None = None) -> Column:
    """Whether a vector is there, has the number of components, and all are finite."""
    column = F.col(vector)
    good = F.forall(
        column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    if dimensions is not None:
        good = (F.size(column) == dimensions) & good
    return F.coalesce(column.isNotNull() & good, F.lit(False))


def integers(scale: float, vector: str = "embedding") -> Column:
    """floor(scale * component) of every component, computed in double precision."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))


def encoded_blocks(x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(distinct subvectors, codes) of each block of dimensions of the rows of ``x``."""
    blocks = []
    for d in range(x.shape[1]):
        values, codes = np.unique(x[:, d], return_inverse=True)
        blocks.append((values[:, None], codes))
    most = max(1, len(x) // DENSITY)
    while len(blocks) > 1:
        wider, joined = [], False
        for k in range(0, len(blocks) - 1, 2):
            (e1, c1), (e2, c2) = blocks[k : k + 2]
            both, codes = np.unique(c1 * len(e2) + c2, return_inverse=True)
            if len(both) <= most:
                entries = np.concatenate([e1[both // len(e2)], e2[both % len(e2)]], axis=1)
                wider.append((entries, codes))
                joined = True
            else:
                wider += blocks[k : k + 2]
        wider += blocks[len(blocks) - len(blocks) % 2 :]
        if not joined:
            break
        blocks = wider
    return [e for e, _ in blocks], [c for _, c in blocks]


def _code_type(entries: int):
    return np.uint8 if entries <= 256 else np.uint16 if entries <= 65536 else np.uint32


def chunks(vectors: DataFrame, rows: int = CHUNK) -> DataFrame:
    """``vec_id`` and integer vectors ``x`` as dictionary-encoded chunks, one a row."""

    def encode(ids: list, x: list) -> pa.RecordBatch:
        ids = pa.concat_arrays(ids)
        found = np.concatenate(x)
        entries, codes = encoded_blocks(found)
        packed = [
            c.astype(_code_type(len(e))).tobytes() for e, c in zip(entries, codes, strict=True)
        ]
        return pa.record_batch(
            [
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([[e.ravel() for e in entries]], pa.list_(pa.list_(pa.int64()))),
                pa.array([packed], pa.list_(pa.binary())),
            ],
            ["vec_ids", "entries", "codes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x, held = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - held)
                flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
                ids.append(part.column("vec_id").cast(pa.int64()))
                x.append(flat.reshape(part.num_rows, -1))
                at, held = at + part.num_rows, held + part.num_rows
                if held == rows:
                    yield encode(ids, x)
                    ids, x, held = [], [], 0
        if held:
            yield encode(ids, x)

    return vectors.select("vec_id", "x").mapInArrow(run, CHUNKS)


class Chunk:
    """One stored chunk."""

    def __init__(self, entries: pa.Array, codes: pa.Array, rows: int):
        packed = [c.as_py() for c in codes]
        # Codes are as wide as the number of dictionary entries asks for.
        kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32}
        self.rows = rows
        self.codes = [np.frombuffer(c, kinds[len(c) // rows]) for c in packed]
        self.entries = [
            e.values.to_numpy().reshape(int(c.max()) + 1, -1)
            for e, c in zip(entries, self.codes, strict=True)
        ]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of every vector; ties go to the smaller number."""
        total = np.zeros((self.rows, len(centroids)), np.int64)
        at, reach = 0, 0
        for entries, codes in zip(self.entries, self.codes, strict=True):
            own = centroids[:, at : at + entries.shape[1]]
            low = np.minimum(entries.min(axis=0), own.min(axis=0))
            high = np.maximum(entries.max(axis=0), own.max(axis=0))
            reach += sum((int(b) - int(a)) ** 2 for a, b in zip(low, high, strict=True))
            if reach >= 1 << 63:
                raise ArithmeticError("a squared distance exceeds 64 bits")
            partial = np.zeros((len(entries), len(centroids)), np.int64)
            for d in range(entries.shape[1]):
                step = entries[:, d, None] - own[None, :, d]
                partial += step * step
            total += partial[codes]
            at += entries.shape[1]
        cluster = np.argmin(total, axis=1)
        return cluster, total[np.arange(self.rows), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of the vectors of each cluster."""
        out = []
        for entries, codes in zip(self.entries, self.codes, strict=True):
            keys = cluster * len(entries) + codes
            counts = np.bincount(keys, minlength=k * len(entries)).reshape(k, -1)
            out.append(counts @ entries)
        return np.concatenate(out, axis=1)


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Chunk]]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids = batch.column("vec_ids")[k].values
            yield ids, Chunk(batch.column("entries")[k].values, batch.column("codes")[k].values, len(ids))


def _round(stored: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; empty clusters keep theirs."""
    k, width = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = np.array(centroids, np.int64)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _, chunk in _chunks_of(batches):
            cluster, _ = chunk.nearest(now)
            counts += np.bincount(cluster, minlength=k)
            sums += chunk.sums(cluster, k)
        full = np.flatnonzero(counts)
        yield pa.record_batch(
            [
                pa.array(full, pa.int32()),
                pa.array(counts[full]),
                pa.array(list(sums[full]), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "sums"],
        )

    # One row a cluster and task goes in, one row a cluster comes to the driver.
    wide = [F.sum(F.col("sums")[d].cast("decimal(20,0)")).alias(f"s{d}") for d in range(width)]
    found = stored.mapInArrow(run, SUMS).groupBy("cluster").agg(F.sum("n").alias("n"), *wide)
    after = list(centroids)
    for row in found.collect():
        after[row["cluster"]] = [int(row[f"s{d}"]) // row["n"] for d in range(width)]
    return after


def seeds(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """Vectors with the smallest hashes of ``seed:vec_id``, in order of the hash."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(name, 256).alias("hash"), "x").orderBy("hash", "x")
    return [list(r["x"]) for r in first.limit(clusters).collect()]


def centroid_clusters(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    chunk: int = CHUNK,
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every row; the final centroids).

    ``vectors`` has ``vec_id`` and integer vectors ``x`` of one length.
    """
    centroids = seeds(vectors, clusters, seed)
    if not centroids:
        empty = vectors.sparkSession.createDataFrame([], ASSIGNED)
        return empty, []
    stored = durable(chunks(vectors, chunk))
    for _ in range(rounds):
        centroids = _round(stored, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = np.array(centroids, np.int64)
        for ids, part in _chunks_of(batches):
            cluster, distance = part.nearest(now)
            yield pa.record_batch(
                [ids, pa.array(cluster, pa.int32()), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return durable(stored.mapInArrow(run, ASSIGNED)), centroids


def cluster_report(embeddings: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable row."""
    kept = embeddings.filter(usable(dimensions=DIMENSIONS)).select(
        F.col("vec_id").cast("long").alias("vec_id"), integers(SCALE).alias("x")
    )
    found, centroids = centroid_clusters(kept)
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(total).collect()}

    def by_cluster(values: list, kind: str) -> Column:
        if not values:
            return F.lit(None).cast(kind)
        return F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")]

    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([sums.get(k, 0) for k in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        by_cluster(names, "string").alias("centroid_sha256"),
    )
