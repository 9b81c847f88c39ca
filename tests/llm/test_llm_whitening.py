"""Whitening: against numpy's decomposition of all rows, and awkward rows."""

import math
import random

import numpy as np
import pytest

from crawlprism.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, component int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "a", "b", 2) for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(3)


def whole(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def check(got, vectors, most=32):
    x = whole(vectors)
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    a = np.array([[(n * r[i] - sums[i]) / n for i in range(d)] for r in x])
    # Of the rows themselves: their covariance would lose the small components.
    _, values, axes = np.linalg.svd(a, full_matrices=False)
    values, axes = values**2 / n, axes.T
    rows = {(r.vec_id, r.component): r for r in got}
    k = max(r.component for r in got)
    assert len(rows) == len(got) == n * k and k <= most
    dev = [sum((n * r[i] - sums[i]) ** 2 for i in range(d)) for r in x]
    want = a @ axes[:, :k] / np.sqrt(values[:k])
    have = np.array([[rows[i, j + 1].whitened for j in range(k)] for i in range(n)])
    signs = np.sign((want * have).sum(axis=0))
    assert np.abs(want * signs - have).max() < 1e-6
    for (i, j), r in rows.items():
        assert (r.n, r.deviation) == (n, dev[i])
        assert abs(r.explained / (values[j - 1] / values.sum()) - 1) < 1e-6
        assert r.identity_error < 1e-9
    return k


@pytest.mark.parametrize(("n", "d"), [(400, 40), (300, 5), (40, 12)])
def test_whitening_against_decomposition(spark, n, d):
    draw = np.random.RandomState(n)
    scale = 3.0 ** -np.arange(d) if d < 12 else 1 + np.arange(d)
    vectors = (draw.randn(n, d) * scale * 4).astype(np.float32).tolist()
    assert check(whitening.whiten(frame(spark, vectors)).collect(), vectors) == min(d, 32)


def test_ill_conditioned_and_dependent_columns(spark):
    draw = np.random.RandomState(3)
    a = draw.randint(-(2**20), 2**20, (500, 4)) / 64
    b = np.column_stack([a, a[:, 0] + draw.randint(0, 2, 500) / 64]).astype(np.float32)
    assert check(whitening.whiten(frame(spark, b.tolist())).collect(), b.tolist()) == 5
    # A constant column and one that is twice another leave three components.
    c = (draw.randint(-50, 50, (300, 3)) / 64).astype(np.float32)
    c = np.column_stack([c, 2 * c[:, 1], np.full(300, 7)]).tolist()
    assert check(whitening.whiten(frame(spark, c)).collect(), c) == 3


def test_bad_rows_are_dropped(spark):
    draw = random.Random(4)
    good = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(60)]
    bad = [None, [], [1.0, None] * 3, [float("nan")] + [0.0] * 5, [float("-inf")] + [0.0] * 5, [1.0] * 5, [None]]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    assert check(got, good) == 6
    # Repeated ids and rows, null ids.
    got = whitening.whiten(frame(spark, good + good, [None] * 60 + [5] * 60)).collect()
    assert len(got) == 720 and {r.n for r in got} == {120} and got[0].identity_error < 1e-9


def test_nothing_to_whiten(spark):
    assert whitening.whiten(frame(spark, [[1.0, 2.0]])).isEmpty()
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 9)).isEmpty()
    assert whitening.whiten(frame(spark, [None, []])).isEmpty()
    empty = whitening.whiten(frame(spark, [[1.0]]).filter("false"))
    assert empty.isEmpty() and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries(spark):
    got = whitening.whiten(frame(spark, [[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0], [1.0, 5.5]])).collect()
    assert {r.n for r in got} == {4} and all(math.isfinite(r.whitened) for r in got)
    assert {r.deviation for r in got if r.vec_id < 2} == {None}
