"""Whitening against the eigenvectors of the exact covariance."""

import numpy as np
import pytest

from stationflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(n, d, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * np.linspace(0.4, 0.05, d) + rng.standard_normal(d)).astype(np.float32)


def exact(x, most):
    """(n, deviations, eigenvalues, whitened, share) by brute force, from whole numbers."""
    x = np.floor(64 * x.astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    big = x.astype(object)
    v = np.array(n * (big.T @ big) - np.outer(s.astype(object), s.astype(object)), float) / n**2
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    return n, ((n * x - s) ** 2).sum(1), e, (x - s / n) @ (q / np.sqrt(e)), e / np.trace(v)


@pytest.mark.parametrize(("n", "d"), [(400, 64), (300, 90), (200, 12)])
def test_equals_the_exact_covariance(spark, n, d):
    x = made(n, d)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(5)
    got = whitening.whitened(df).toPandas()
    most = min(32, d)
    count, deviation, values, want, share = exact(x, most)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    assert wide.shape == (n, most) and set(got.n) == {count}
    assert np.abs(wide * np.sign((wide * want).sum(0)) - want).max() < 1e-9
    assert got.groupby("vec_id").deviation.first().sort_index().tolist() == deviation.tolist()
    assert got.groupby("component").explained.first().to_numpy() == pytest.approx(share, rel=1e-10)
    assert set(got.identity_error) == {got.identity_error.iloc[0]} and got.identity_error.iloc[0] < 1e-12
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(most)).max() < 1e-10


def test_odd_rows(spark):
    x = made(50, 4)
    nan, inf = float("nan"), float("inf")
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(None, x[0].tolist(), 0), (3, x[3].tolist(), 0)]
    bad = [(90, None, 0), (91, [1.0, None, 0.0, 0.0], 0), (92, [nan, 0.0, 0.0, 0.0], 0), (93, [inf, 0.0, 0.0, 0.0], 0), (94, [], 0), (95, [1.0], 0)]
    df = spark.createDataFrame(rows + bad, SCHEMA)
    got = whitening.whitened(df.selectExpr("*", "label AS x", "label AS n", "label AS component")).toPandas()
    assert len(got) == 52 * 4 and set(got.n) == {52} and got.vec_id.isna().sum() == 4
    _, _, _, want, _ = exact(np.vstack([r[1] for r in rows]).astype(np.float32), 4)
    twice = got[got.vec_id == 3].sort_values("component").whitened.abs().tolist()
    assert twice == pytest.approx(sorted(np.abs(want[3]).tolist() * 2, key=lambda y: np.argmin(np.abs(np.abs(want[3]) - y))))


def test_no_extent_and_no_rows(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25], 0) for i in range(5)], SCHEMA)
    assert whitening.whitened(same).count() == 0
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 0.25], 0) for i in range(5)], SCHEMA)
    assert {r.component for r in whitening.whitened(line).collect()} == {1}


def test_deviation_beyond_64_bits_is_null():
    x = np.array([[0], [1 << 40]])
    assert whitening.deviations(x, 2, x.sum(0)) == [None, None]
    assert whitening.deviations(np.array([[0], [4]]), 2, np.array([4])) == [16, 16]
