"""Whitening against a plain eigendecomposition; rank-one updates against their definition."""

from collections import Counter

import brute
import numpy as np
import pytest

from barloom.llm import queries as q
from barloom.llm.whitening import Spectrum, fit, rank_one, whitened_rows


def plain(sf_dir):
    """Per row: id, n, deviation; and (rows, components) of whitened values, explained."""
    kept = brute.usable_vectors(sf_dir)
    width = max((len(v) for _, v in kept), default=0)
    x = [tuple([int(np.floor(256 * c)) for c in v] + [0] * (width - len(v))) for _, v in kept]
    fitted = sorted(set(x))
    n = len(fitted)
    total = [sum(c) for c in zip(*fitted, strict=True)]
    own = np.array(fitted, float) - np.array(total) / n
    values, vectors = np.linalg.eigh(own.T @ own / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(r, total, strict=True)) for r in x]
    y = (np.array(x, float) - np.array(total) / n) @ vectors / np.sqrt(values)
    ids = [i for i, _ in kept]
    return ids, n, deviation, y, values / np.trace(own.T @ own / n)


@pytest.mark.parametrize("kind", ["sf", "odd"])
def test_op12(spark, kind, sf_dir, odd_dir):
    folder = {"sf": sf_dir, "odd": odd_dir}[kind]
    ids, n, deviation, y, explained = plain(folder)
    got = q.op12(spark, folder).toPandas()
    assert set(got["n"]) == {n} and got["identity_error"].max() <= 1e-9
    assert got["identity_error"].nunique() == 1
    for component in range(1, 5):
        own = got[got["component"] == component]
        assert Counter(own["vec_id"].fillna(-1)) == Counter(-1 if i is None else i for i in ids)
        assert np.allclose(own["explained"], explained[component - 1], rtol=1e-9)
        have = sorted(zip(own["deviation"], own["whitened"], strict=True))
        flipped = [(d, -w) for d, w in have]
        want = sorted(zip(deviation, y[:, component - 1], strict=True))
        assert [d for d, _ in have] == [d for d, _ in want]
        assert any(
            np.allclose(sorted(a), sorted(want), rtol=1e-8, atol=1e-8) for a in (have, flipped)
        )


def test_values_by_row(spark, sf_dir):
    ids, _, _, y, _ = plain(sf_dir)
    got = q.op12(spark, sf_dir).toPandas().pivot(index="vec_id", columns="component", values="whitened")
    have = got.loc[ids].to_numpy()
    assert np.allclose(have * np.sign((have * y).sum(axis=0)), y, rtol=1e-9, atol=1e-9)


def test_empty(spark, empty_dir):
    got = q.op12(spark, empty_dir)
    assert got.count() == 0 and got.columns[0] == "vec_id"


def test_components_without_variance(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])]
    df = spark.createDataFrame(rows[:2], "vec_id long, embedding array<float>")
    got = whitened_rows(df).collect()
    assert len(got) == 4 and all(r["whitened"] is None and r["identity_error"] is None for r in got)
    assert all(r["n"] == 1 and r["deviation"] == 0 and r["explained"] is None for r in got)
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], "vec_id long, embedding array<float>")
    got = {(r["vec_id"], r["component"]): r for r in whitened_rows(df).collect()}
    assert abs(got[1, 1]["whitened"]) == 1 and got[1, 2]["whitened"] is None
    assert got[1, 1]["explained"] == 1 and got[1, 2]["explained"] == 0
    empty = spark.createDataFrame(rows[2:], "vec_id long, embedding array<float>")
    assert whitened_rows(empty).count() == 0


def test_many_partitions_are_combined_in_groups(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-400, 400, (900, 6)) * np.array([9, 5, 3, 2, 1, 1])
    rows = [(x_.tolist(),) for x_ in x]
    df = spark.createDataFrame(rows, "x array<long>").repartition(300)
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        model, distinct = fit(df, 6)
        assert distinct.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    own = np.unique(x, axis=0)
    own = own - own.mean(axis=0)
    want = np.linalg.eigvalsh(own.T @ own / len(own))[::-1][:4]
    assert np.allclose(model.values, want, rtol=1e-10)


CASES = {
    "spread": lambda rng, d: np.sort(rng.exponential(size=d)),
    "zero": lambda rng, d: np.zeros(d),
    "equal": lambda rng, d: np.ones(d),
    "wide": lambda rng, d: np.sort(10.0 ** rng.uniform(-14, 6, d)),
    "close": lambda rng, d: np.sort(1 + 1e-15 * rng.integers(0, 4, d)),
}


@pytest.mark.parametrize("d", [1, 2, 7, 64])
@pytest.mark.parametrize("case", CASES)
def test_rank_one(case, d):
    rng = np.random.default_rng(d)
    values = CASES[case](rng, d)
    vectors = np.linalg.qr(rng.normal(size=(d, d)))[0]
    for v in (rng.normal(size=d), vectors[:, 0] * 3, 1e-9 * rng.normal(size=d), np.zeros(d)):
        want = vectors @ np.diag(values) @ vectors.T + np.outer(v, v)
        w, u = rank_one(values, vectors, v)
        scale = max(np.abs(want).max(), 1e-300)
        assert np.abs(u @ np.diag(w) @ u.T - want).max() <= 1e-13 * scale
        assert np.abs(u.T @ u - np.eye(d)).max() <= 1e-13
        assert (np.diff(w) >= 0).all()


def test_blocks_single_rows_and_combination_agree():
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (400, 10))
    x[:, 3] = x[:, 2]
    x[:, 4] = 7
    own = x - x.mean(axis=0)
    want = own.T @ own
    whole, rows, halves = Spectrum.empty(10), Spectrum.empty(10), Spectrum.empty(10)
    whole.add(x)
    for k in range(len(x)):
        rows.add(x[k : k + 1])
    for part in (x[:1], x[1:37], x[37:]):
        other = Spectrum.empty(10)
        other.add(part)
        halves.combine(other)
    for s in (whole, rows, halves):
        assert s.n == 400 and s.total == x.sum(axis=0).tolist() and s.squares == (x * x).sum()
        assert np.allclose(s.vectors @ np.diag(s.values) @ s.vectors.T, want, atol=1e-9 * want.max())
