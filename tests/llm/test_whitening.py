"""Whitening beside a dense eigendecomposition, and its edge cases."""

import math

import numpy as np
import pytest

from chatloom.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n int, component string, x string, ids int"


def table_of(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "c", "x", 2) for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def run(spark, vectors, ids=None, k=8):
    blocks, d = whitening.embedding_blocks(table_of(spark, vectors, ids))
    model = whitening.fit_whitening(blocks, d, k)
    return model, whitening.whiten(blocks, model)


def dense(vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(int) + 100_000
    n, s = len(x), x.sum(0)
    a = (n * x - s) / n
    e, p = np.linalg.eigh(a.T @ a / n)
    return x, n, s, a, e[::-1], p[:, ::-1]


@pytest.mark.parametrize(("n", "d", "spread"), [(300, 12, "even"), (500, 20, "steep"), (40, 30, "even"), (9, 5, "even")])
def test_whitening_is_the_eigendecomposition(spark, n, d, spread):
    draw = np.random.default_rng(n)
    vectors = draw.normal(size=(n, d)) * (1.0 if spread == "even" else np.logspace(0, -3, d)) + draw.normal(size=d)
    model, out = run(spark, vectors)
    x, n, s, a, e, p = dense(vectors)
    k = min(8, d)
    rows = out.orderBy("vec_id", "component").collect()
    assert len(rows) == n * k and [r.component for r in rows[:k]] == list(range(1, k + 1))
    assert [r.deviation for r in rows[::k]] == [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s, strict=True)) for row in x]
    got, want = np.array([r.whitened for r in rows]).reshape(n, k), a @ p[:, :k] / np.sqrt(e[:k])
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-8
    assert np.allclose([r.explained for r in rows[:k]], e[:k] / e.sum(), rtol=1e-9)
    assert rows[0].n == n and max(r.identity_error for r in rows) < 1e-8 and len({r.identity_error for r in rows}) == 1
    assert np.abs(model.components.T @ model.components - np.eye(k)).max() < 1e-12


def test_values_met_several_times_and_missing_directions(spark):
    # three equal variances, one smaller, the rest constant: a single Lanczos sequence sees each value once
    axes = np.vstack([2.0 * np.eye(6)[:3], -2.0 * np.eye(6)[:3], np.eye(6)[3:4], -np.eye(6)[3:4]])
    model, out = run(spark, np.vstack([axes] * 3) + 5)
    assert len(model.variances) == 4 and np.allclose(model.variances[:3], model.variances[0]) and np.isclose(model.variances[3], model.variances[0] / 4)
    assert out.first().identity_error < 1e-12 and np.isclose(sum(model.variances), model.trace)
    assert {r.component for r in out.collect()} == {1, 2, 3, 4}


def test_rows_that_take_no_part_and_tables_without_variance(spark):
    nan, inf = math.nan, math.inf
    vectors = [[1, 2], [2, 1], None, [1, None], [nan, 1], [inf, 0], [], [1, 2, 3], [1, 2], [0, 0]]
    ids = [7, None, 1, 2, 3, 4, 5, 6, 7, 9]
    _, out = run(spark, vectors, ids)
    rows = out.collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in rows) == sorted([(False, 7)] * 4 + [(True, 0)] * 2 + [(False, 9)] * 2)
    assert len({(r.component, round(r.whitened, 9)) for r in rows if r.vec_id == 7}) == 2
    for same in ([[1, 2]] * 5, [], [None], [[3, 4]]):
        model, out = run(spark, same)
        assert len(model.variances) == 0 and out.count() == 0


def test_deviations_beyond_longs():
    x = np.array([[2**40, -(2**40)], [0, 0]])
    assert whitening._deviations(x, 2, [2**40, -(2**40)]) == [None, None]
    assert whitening._deviations(x // 2**20, 2, [2**20, -(2**20)]) == [2**41, 2**41]
