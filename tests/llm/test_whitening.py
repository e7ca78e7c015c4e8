"""Whitening against dense eigenvalue routines, exact integers and all odd rows."""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import whitening
from tickloom.llm.queries import QUERIES

RNG = np.random.default_rng(13)
U, _ = np.linalg.qr(RNG.standard_normal((64, 64)))
V, _ = np.linalg.qr(RNG.standard_normal((64, 64)))


def spread(values):
    return U @ np.diag(np.r_[values, np.zeros(64 - len(values))]) @ V.T


ONE_ROW = np.zeros((64, 64))
ONE_ROW[0, 32:] = RNG.standard_normal(32)
WILKINSON = np.diag(np.abs(np.arange(-10.0, 11.0)) + 2) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
MATRICES = {
    "one": np.array([[3.0]]),
    "two": RNG.standard_normal((2, 2)),
    "random": RNG.standard_normal((64, 64)),
    "identity": np.eye(64),
    "orthogonal": 3 * U,
    "graded columns": np.triu(RNG.standard_normal((64, 64))) * np.logspace(0, -12, 64),
    "graded rows": np.triu(RNG.standard_normal((64, 64))) * np.logspace(0, -12, 64)[:, None],
    "few rows": np.vstack([RNG.standard_normal((5, 64)), np.zeros((59, 64))]),
    "one row": ONE_ROW,
    "nothing": np.zeros((4, 4)),
    "clusters": spread(np.r_[[5.0] * 4, [5 - 1e-9] * 4, [5 - 1e-13] * 4, np.linspace(4, 1, 52)]),
    "one direction": spread(np.r_[1.0, [1e-20] * 63]),
    "wilkinson": np.linalg.cholesky(WILKINSON).T,
    "large": 1e12 * RNG.standard_normal((30, 30)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_principal_directions(name):
    r = MATRICES[name]
    values, directions = whitening.principal(r, 8)
    singular = np.linalg.svd(r, compute_uv=False)[: len(values)] ** 2
    size = max(singular[0], 1e-300)
    assert np.abs(values - singular).max() <= 1e-13 * size
    assert np.abs(r.T @ (r @ directions) - directions * values).max() <= 1e-13 * size
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() <= 1e-12


def test_bidiagonal():
    r = MATRICES["random"]
    a, b, v = whitening.bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(64), atol=1e-13)
    left = r @ v  # u b, so its product with itself is b'b
    full = np.diag(a) + np.diag(b, 1)
    assert np.allclose(left.T @ left, full.T @ full, atol=1e-11)


def test_dqds_keeps_relative_accuracy():
    """Values 24 orders of magnitude apart, against exact rational characteristic roots by bisection (Sturm counts)."""
    a, b = np.array([1.0, 1e-4, 1e-8, 1e-12]), np.array([1e-2, 1e-6, 1e-10])
    found = whitening.dqds(a, b)
    q, e = [Fraction(x) ** 2 for x in a.tolist()], [Fraction(x) ** 2 for x in b.tolist()]

    def below(value):  # eigenvalues of b'b under a value, by exact pivots
        count, d = 0, q[0] - value
        for k in range(1, 5):
            count += d < 0
            if k < 4:
                d = q[k] + e[k - 1] - value - q[k - 1] * e[k - 1] / (d or Fraction(1, 10**60))
        return count

    for k, value in enumerate(sorted(found.tolist())):
        low, high = Fraction(value) * (1 - Fraction(1, 10**13)), Fraction(value) * (1 + Fraction(1, 10**13))
        assert below(low) <= k < below(high)


def expected(vectors):
    x = np.array([[int(np.floor(1024.0 * float(c))) + 100_000 for c in v] for v in vectors], object)
    n, total = len(x), x.sum(axis=0)
    deviation = [int(sum(v * v for v in row)) for row in x * n - total]
    centred = (x * n - total).astype(float) / n
    return x, n, deviation, centred


def check(rows, vectors, k):
    """rows: (vector position, result row); against numpy's own eigenvectors, signs aside."""
    _, n, deviation, centred = expected(vectors)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    plain = centred @ directions / np.sqrt(values)
    found = np.full((n, k), np.nan)
    for at, r in rows:
        found[at, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[at]
        assert abs(r.explained / (values[r.component - 1] / np.trace(centred.T @ centred / n)) - 1) < 1e-9
        assert r.identity_error < 1e-9
    signs = np.sign((found * plain).sum(axis=0))
    assert np.abs(found * signs - plain).max() < 1e-8
    assert np.abs(np.cov(found.T, bias=True) - np.eye(k)).max() < 1e-9


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    at = {r.vec_id: i for i, r in enumerate(table)}
    found = QUERIES["op13_whitening"](spark, sf_dir).collect()
    assert len(found) == 8 * len(table)
    check([(at[r.vec_id], r) for r in found], [r.embedding for r in table], 8)


def frame(spark, rows, kind="float", partitions=5):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(partitions)
    return df.select("*", *[F.lit("clash").alias(c) for c in ("id", "vector", "n", "component", "part", "state", "dim")])


def test_odd_rows(spark):
    good = [(i, RNG.standard_normal(5).tolist()) for i in range(40)]
    good += [(7, good[7][1]), (None, [0.0, 1.0, -1.0, 1e-9, -1e-9]), (3, [9.0] * 5)]
    bad = [
        (90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [float("nan")] * 5), (94, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
        (95, [0.0, float("-inf"), 0.0, 0.0, 0.0]),
    ]
    found = whitening.whitened(frame(spark, good + bad, "double")).collect()
    assert len(found) == 5 * len(good)  # five dimensions, so five components
    by = defaultdict(list)
    for r in found:
        by[r.vec_id, r.deviation, r.component].append(r)
    _, _, deviation, _ = expected([v for _, v in good])
    rows = [(k, by[i, deviation[k], c].pop()) for k, (i, _) in enumerate(good) for c in range(1, 6)]
    check(rows, [v for _, v in good], 5)


def test_without_variance(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None), (2, [float("nan")])])).collect() == []
    one = whitening.whitened(frame(spark, [(1, [0.5, 0.25])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None),
    ]
    line = whitening.whitened(frame(spark, [(i, [i / 4, 1.0, -i / 4]) for i in range(9)])).collect()
    assert {r.component for r in line if r.whitened is None} == {2, 3}
    assert all(abs(r.explained - (r.component == 1)) < 1e-12 and r.identity_error < 1e-12 for r in line)
    assert abs(np.std([r.whitened for r in line if r.component == 1]) - 1) < 1e-12


def test_large_entries_are_exact_or_an_error(spark):
    rows = [(i, [float(i % 3) * 360_000, 0.25 * i]) for i in range(6)]  # their bound passes a long, the sums do not
    found = whitening.whitened(frame(spark, rows, "double")).collect()
    _, _, deviation, _ = expected([v for _, v in rows])
    assert {r.vec_id: r.deviation for r in found} == dict(enumerate(deviation))
    with pytest.raises(Exception, match="does not fit a long"):
        whitening.whitened(frame(spark, [(1, [2.0**40]), (2, [0.0])], "double")).collect()
    with pytest.raises(Exception, match="different lengths"):
        whitening.whitened(frame(spark, [(1, [1.0]), (2, [0.0, 1.0])])).collect()


def test_states_are_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_MERGED", 3)
    rows = [(i, RNG.standard_normal(4).tolist()) for i in range(200)]
    found = whitening.whitened(frame(spark, rows, "double", 40), components=2).collect()
    check([(r.vec_id, r) for r in found], [v for _, v in rows], 2)
