"""Whitening against eigenvectors of the exact covariance."""

import numpy as np
import pytest
from pyspark.sql import types as T

from changeflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, width int"


def frame(spark, vectors):
    rows = [(i, v, 1, "own", 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(vectors, most=16):
    """Whitened rows, shares and exact deviations from integers and a plain eigenvalue problem."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, sums = len(fit), fit.sum(axis=0)
    off = ((n * fit - sums) / n).astype(float)
    values, axes = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)[:most]
    rows = ((n * x - sums) / n).astype(float) @ axes[:, order] / np.sqrt(values[order])
    return n, ((n * x - sums) ** 2).sum(axis=1).tolist(), rows, values[order] / values.sum()


def check(df, vectors, ids, most=16, close=1e-6):
    n, deviation, rows, explained = brute(vectors, most)
    got = df.collect()
    assert len(got) == len(vectors) * rows.shape[1]
    place = {i: k for k, i in enumerate(ids)}
    seen = np.zeros_like(rows)
    for r in got:
        k = place[r.vec_id]
        seen[k, r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, deviation[k])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-6)
        assert r.identity_error < 1e-9
    for c in range(rows.shape[1]):
        sign = np.sign(seen[:, c] @ rows[:, c])
        assert np.allclose(seen[:, c], sign * rows[:, c], atol=close)


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 24)) * np.linspace(0.2, 3, 24)
    vectors = [*base.tolist(), *base[:150].tolist(), *[base[7].tolist()] * 200]
    got = whitening.whiten(frame(spark, vectors))
    check(got, vectors, range(len(vectors)))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_unusable_vectors_go(spark):
    rng = np.random.default_rng(4)
    good = rng.normal(size=(60, 5)).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4, [3e38] * 5, [1.0, 2.0]]
    check(whitening.whiten(frame(spark, good + bad)), good, range(60))


def test_nearly_dependent_entries_keep_their_digits(spark):
    # The third entry is the sum of two that are 10^6 times larger, give or take one unit.
    rng = np.random.default_rng(5)
    a, b = rng.integers(-(1 << 22), 1 << 22, (2, 500)) * 4
    noise = rng.integers(-1, 2, 500)
    schema = T.StructType.fromDDL("vec_id long, embedding array<double>")
    vectors = np.stack([a, b, a + b + noise / 64], axis=1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], schema)
    got = [r for r in whitening.whiten(df).collect() if r.component == 3]
    # On the small direction rows lie at what the two large entries leave of the noise.
    x = np.floor(64 * vectors).astype(np.int64)
    off = (x[:, 0] + x[:, 1] - x[:, 2]).astype(float)
    off -= off.mean()
    large = x[:, :2] - x[:, :2].mean(axis=0)
    off -= large @ np.linalg.lstsq(large, off, rcond=None)[0]
    seen = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id)])
    want = off / off.std()
    assert np.allclose(seen, want * np.sign(seen @ want), atol=1e-3)
    assert got[0].identity_error < 1e-6


def test_directions_without_variance_are_left_out(spark):
    rng = np.random.default_rng(6)
    half = rng.integers(-50, 50, (80, 3)).astype(float)
    vectors = np.concatenate([half, half[:, :1], np.ones((80, 1))], axis=1).tolist()
    got = whitening.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in got} == {1, 2, 3} and len(got) == 240
    few = rng.normal(size=(4, 9)).tolist()
    assert {r.component for r in whitening.whiten(frame(spark, few)).collect()} == {1, 2, 3}


def test_no_rows_and_one_vector(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(frame(spark, [None, None])).count() == 0


def test_null_ids_and_large_values(spark):
    rows = [(None, [1e12, 0.0]), (None, [1e12, 5.0]), (3, [-1e12, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got)
    assert sum(r.vec_id is None for r in got) == 4
