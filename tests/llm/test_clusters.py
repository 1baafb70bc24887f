"""Centroid clustering against whole-number k-means, and its lossless dictionaries."""

from collections import Counter

import brute
import numpy as np
import pytest

from barloom.llm import centroid_clusters as cc
from barloom.llm import queries as q

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("kind", ["sf", "odd", "empty"])
def test_op11(spark, kind, sf_dir, odd_dir, empty_dir):
    folder = {"sf": sf_dir, "odd": odd_dir, "empty": empty_dir}[kind]
    got = q.op11(spark, folder).select(*COLUMNS).collect()
    assert Counter(map(tuple, got)) == Counter(brute.clusters(folder))


def test_chunks_do_not_change_the_result(spark, sf_dir):
    kept = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", cc.integers(cc.SCALE).alias("x")
    )
    few = kept.filter("vec_id < 200").repartition(3)
    small, a = cc.centroid_clusters(few, 5, 4, chunk=7)
    large, b = cc.centroid_clusters(few, 5, 4)
    assert a == b and sorted(small.collect()) == sorted(large.collect())


def test_empty_clusters_keep_their_centroid(spark):
    rows = [(n, [n % 2 * 10, 0]) for n in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    found, centroids = cc.centroid_clusters(df, 8, 3)
    assert len(centroids) == 8 and {tuple(c) for c in centroids} == {(0, 0), (10, 0)}
    # equal centroids: all vectors go to the one with the smaller number
    assert len({r["cluster"] for r in found.collect()}) == 2


@pytest.mark.parametrize("rows", [1, 5, 40, 2000])
def test_blocks_are_lossless(rows):
    rng = np.random.default_rng(rows)
    kinds = rng.integers(-(1 << 40), 1 << 40, (max(1, rows // 50), 9))
    x = kinds[rng.integers(0, len(kinds), rows)]
    x[:, 4] = rng.integers(-5, 5, rows)
    entries, codes = cc.encoded_blocks(x)
    assert np.array_equal(np.concatenate([e[c] for e, c in zip(entries, codes, strict=True)], axis=1), x)
    if rows == 2000:
        assert len(entries) < 9
    assert all(len(np.unique(e, axis=0)) == len(e) for e in entries)


def test_distances_beyond_64_bits_are_refused(spark):
    rows = [(1, [1 << 32, 0]), (2, [-(1 << 32), 0])]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    with pytest.raises(Exception, match="64 bits"):
        cc.centroid_clusters(df, 2, 1)
