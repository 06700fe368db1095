import math

import numpy as np
import pytest

from gaugeflow.llm import whitening
from gaugeflow.llm.queries import QUERIES
from gaugeflow.llm.whitening import quantised, whiten

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(rows, k=8):
    """Id to (deviation, whitened coordinates), and the shares, by a dense eigenvalue solver."""
    x = np.array([r for _, r in rows], dtype=np.int64)
    n = len(x)
    sums = [sum(int(v) for v in column) for column in x.T]
    centred = x - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(k, int((values > 1e-9 * values[0]).sum()))
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
    return deviation, centred @ vectors[:, :kept] / np.sqrt(values[:kept]), values[:kept] / values.sum()


def compare(out, rows, k=8):
    assert out.columns == COLUMNS
    deviation, coordinates, shares = brute(rows, k)
    got = {}
    for r in out.collect():
        assert r.n == len(rows) and abs(r.identity_error) < 1e-9
        assert math.isclose(r.explained, shares[r.component - 1], rel_tol=1e-9)
        got.setdefault(r.vec_id, {})[r.component] = (r.deviation, r.whitened)
    assert set(got) == {i for i, _ in rows}
    signs = None
    for (i, _), exact, y in zip(rows, deviation, coordinates):
        assert sorted(got[i]) == list(range(1, len(shares) + 1))
        assert {d for d, _ in got[i].values()} == {exact if exact < 2**63 else None}
        own = np.array([got[i][c][1] for c in sorted(got[i])])
        if signs is None and (abs(y) > 1e-3).all():
            signs = np.sign(own) * np.sign(y)
    for (i, _), y in zip(rows, coordinates):
        own = np.array([got[i][c][1] for c in sorted(got[i])])
        assert np.allclose(own * signs, y, rtol=1e-7, atol=1e-7)


def frame(spark, rows):
    return spark.createDataFrame([(i, list(map(int, x))) for i, x in rows], "vec_id long, x array<bigint>").repartition(3)


@pytest.mark.parametrize("n,d,scale", [(200, 12, 1), (9, 12, 50), (500, 64, 3), (40, 3, 1), (50, 1, 1), (300, 5, 10**6)])
def test_equals_dense_solver(spark, n, d, scale):
    rng = np.random.default_rng(n + d)
    x = (rng.standard_normal((n, d)) * (1.5 ** np.arange(d, 0, -1)) * 1000 * scale).astype(np.int64) + 100_000
    rows = list(enumerate(x))
    compare(whiten(frame(spark, rows)), rows)


def test_query_equals_dense_solver(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, [math.floor(1024 * c) + 100_000 for c in r.embedding]) for r in table.collect()]
    compare(QUERIES["op12_embedding_whitening"](spark, small), rows)


def test_wide_vectors_stop_when_converged(spark):
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((150, 60)) * np.concatenate([1000 * 0.6 ** np.arange(12), np.ones(48)]) * 100).astype(np.int64)
    blocks = whitening.blocked(frame(spark, list(enumerate(x))), 60, "vec_id", "x")
    passes, added_up = [], whitening.added_up
    whitening.added_up = lambda *a: passes.append(1) or added_up(*a)
    try:
        found = whitening.fit(blocks, 60, 4, full_steps=10)
    finally:
        whitening.added_up = added_up
    centred = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(centred.T @ centred / 150)[::-1]
    assert np.allclose(found.variances, values[:4], rtol=1e-10) and len(passes) < 45


def test_equal_variances_are_all_found(spark):
    x = [s * 1000 * np.eye(6, dtype=np.int64)[k] for k in range(6) for s in (1, -1)]
    out = whiten(frame(spark, list(enumerate(x))), components=8).collect()
    assert {r.component for r in out} == set(range(1, 7)) and len(out) == 72
    assert all(math.isclose(r.explained, 1 / 6, rel_tol=1e-12) and r.identity_error < 1e-12 for r in out)


def test_only_directions_with_variance_count(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-5000, 5000, (80, 3))
    rows = list(enumerate(base @ rng.integers(-3, 4, (3, 20))))
    compare(whiten(frame(spark, rows)), rows)
    for same in ([(1, [5, 7])] * 4, [(1, [5, 7])], []):
        assert whiten(frame(spark, same)).count() == 0


def test_rows_that_do_not_count(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.1, 0.2], "a"), (2, None, "a"), (3, [0.5, None], "a"), (4, [nan, 0.0], "a"), (5, [inf, 1.0], "a"),
        (6, [], "a"), (7, [1.0, 2.0, 3.0], "a"), (None, [-0.3, 0.9], "a"), (8, [0.7, -0.2], "b"), (8, [0.7, -0.2], "b"),
        (9, [1e300, 0.0], "a"), (10, [-0.0004, 0.25], None),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string")
    out = whiten(quantised(df, "embedding", 1024, 100_000)).collect()
    assert sorted((r.vec_id is not None, r.vec_id or 0) for r in out if r.component == 1) == [
        (False, 0), (True, 1), (True, 8), (True, 8), (True, 10)
    ]
    assert {r.n for r in out} == {5}
    first = quantised(df, "embedding", 1024, 100_000).where("vec_id = 10").first()
    assert first.x == [99_999, 100_256]


def test_large_numbers_stay_exact(spark):
    x = [[2**60, 5], [-(2**60), 7], [2**59 + 1, 0], [0, 0]]
    blocks = whitening.blocked(frame(spark, list(enumerate(x))), 2, "vec_id", "x")
    assert whitening.exact_sums(blocks, 2) == (4, [2**59 + 1, 12])
    got = whitening.deviations(np.array(x), 4, [2**59 + 1, 12])
    assert got == [None] * 4
    assert whitening.deviations(np.array([[3, 1], [10**9, 0]]), 2, [10**9 + 3, 1]) == [(10**9 - 3) ** 2 + 1] * 2
