"""Whitening against exact sums and numpy's own decomposition."""

import numpy as np
import pytest
from pyspark.sql import Row

from millrace.llm import whitening


def frame(spark, vectors, extra=()):
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")


def account(vectors):
    """n, exact deviations, variances and components of the distinct whole-number vectors."""
    x = [tuple(int(np.floor(64 * c)) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    moved = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in fit], float) / n
    _, s, vt = np.linalg.svd(moved, full_matrices=False)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    every = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in x], float) / n
    return n, deviation, s * s / n, every @ vt.T / (s / np.sqrt(n)), fit


def compare(spark, vectors, k):
    n, deviation, variances, white, _ = account(vectors)
    out = whitening.whiten(frame(spark, vectors)).toPandas().sort_values(["vec_id", "component"])
    assert len(out) == len(vectors) * k
    got = out["whitened"].to_numpy().reshape(len(vectors), k)
    assert set(out["n"]) == {n}
    if max(deviation) < 1 << 63:
        assert out["deviation"].tolist() == [d for d in deviation for _ in range(k)]
    assert out["component"].tolist() == list(range(1, k + 1)) * len(vectors)
    for j in range(k):
        sign = np.sign(got[:, j] @ white[:, j])
        assert np.abs(got[:, j] * sign - white[:, j]).max() < 1e-6
    assert np.allclose(out["explained"].to_numpy()[:k], (variances / variances.sum())[:k], rtol=1e-9)
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9
    return got


def test_whitening_equals_numpy(spark):
    draw = np.random.default_rng(1)
    vectors = (draw.standard_normal((300, 24)) * np.geomspace(40, 0.5, 24)) @ np.linalg.qr(draw.standard_normal((24, 24)))[0] + 3
    vectors = np.concatenate([vectors, vectors[:50], np.repeat(vectors[:1], 100, axis=0)])  # repeated vectors weigh once
    compare(spark, vectors.tolist(), 16)


def test_fewer_dimensions_than_components_and_no_full_rank(spark):
    draw = np.random.default_rng(2)
    v = draw.standard_normal((200, 3)) * [5, 3, 2]
    compare(spark, v.tolist(), 3)
    # a constant, a repeated and a summed column add no component; whole numbers keep the sum exact
    w = np.round(v * 8) / 8
    same = np.column_stack([w, np.full(200, 0.25), w[:, 0], w[:, 0] + w[:, 1]])
    compare(spark, same.tolist(), 3)


def test_small_variances_keep_their_digits(spark):
    draw = np.random.default_rng(3)
    vectors = draw.standard_normal((400, 6)) * [3e6, 3e4, 300, 30, 10, 3]
    vectors[:, 1] += vectors[:, 0]  # far from orthogonal
    compare(spark, vectors.tolist(), 6)


def test_triangle_in_three_factors(spark):
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((500, 8)) * np.geomspace(1e5, 1, 8)
    rows = whitening.quantised(frame(spark, vectors.tolist()))
    mid = whitening.centre(rows.select("x"))
    r, far = whitening.triangle(rows.select("x"), mid, 8)
    a = mid.rows(np.array([row.x for row in rows.select("x").collect()]))
    assert np.allclose(r.T @ r, a.T @ a, rtol=1e-10, atol=1e-10 * np.abs(a.T @ a).max())
    assert far[-1] < 1e-12 and len(far) <= 5


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = np.random.default_rng(5).standard_normal((40, 2)).tolist()
    odd = [(100, None, "x"), (101, [1.0, None], "x"), (102, [nan, 1.0], "x"), (103, [inf, 1.0], "x"), (104, [], "x"),
           (105, [1e300, 1.0], "x"), (None, [0.5, 0.25], "x"), (None, [0.5, 0.25], "x"), (7, [0.5, 0.5], "x"), (106, [1.0, 2.0, 3.0], "x")]
    out = whitening.whiten(frame(spark, good, odd))
    ids = [r.vec_id for r in out.where("component = 1").collect()]
    assert sorted(i for i in ids if i is not None) == sorted([*range(40), 7]) and ids.count(None) == 2
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).collect() == []  # one distinct vector
    two = whitening.whiten(frame(spark, [[0.0, 0.0], [1.0, 0.0]])).collect()
    assert {(r.vec_id, r.component, round(abs(r.whitened), 12)) for r in two} == {(0, 1, 1.0), (1, 1, 1.0)}
    assert isinstance(two[0], Row)


@pytest.mark.parametrize("size", [1 << 40, 1 << 55])
def test_exact_beyond_longs(spark, size):
    vectors = [[float(size), 0.0], [0.0, 1.0], [-float(size), 5.0], [float(size // 2), 2.0]]
    n, deviation, *_ = account(vectors)
    out = whitening.whiten(frame(spark, vectors)).where("component = 1").orderBy("vec_id").collect()
    assert [r.deviation for r in out] == [d if d < 1 << 63 else None for d in deviation] and out[0].n == n
