"""Whitening against a brute-force version with Python integers."""

from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n int"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.2, (300, 6)) @ rng.normal(0, 1, (6, 40)) + rng.normal(0, 0.1, (300, 40))
    rows = [(i, [float(v) for v in x.astype(np.float32)], "c", 1) for i, x in enumerate(base)]
    nan, inf = float("nan"), float("inf")
    odd = [(900, None, "c", 1), (901, [None] + [0.0] * 39, "c", 1), (902, [nan] * 40, None, 1), (903, [inf] + [0.0] * 39, "c", 1), (904, [], "c", 1), (905, [0.5], "c", 1)]
    return [*rows, rows[0], (None, rows[1][1], "c", 1)], odd


def brute(rows):
    x = [[int(np.floor(64.0 * np.float64(v))) + 1000000 for v in r[1]] for r in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    v = np.array([[float(Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n**3)) for j in range(d)] for i in range(d)])
    return x, n, sums, v


def test_against_brute_force(spark, vectors):
    rows, odd = vectors
    out = whitening.whiten(spark.createDataFrame(rows + odd, SCHEMA).repartition(5)).collect()
    x, n, sums, v = brute(rows)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(out) == 32 * len(rows) and {r.n for r in out} == {n}
    by_id = {}
    for r in out:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert set(by_id) == {r[0] for r in rows} and {len(by_id[0][c]) for c in by_id[0]} == {2}
    centre = (np.array([[n * a - s for a, s in zip(r, sums)] for r in x], dtype=np.float64) / n) @ axes[:, :32] / np.sqrt(values[:32])
    for c in range(32):
        sign = np.sign(by_id[0][c + 1][0].whitened * centre[0, c])
        for row, w, xs in zip(rows, centre, x):
            for got in by_id[row[0]][c + 1]:
                assert abs(got.whitened * sign - w[c]) < 1e-8
                assert got.deviation == sum((n * a - s) ** 2 for a, s in zip(xs, sums))
                assert abs(got.explained / (values[c] / values.sum()) - 1) < 1e-9
                assert got.identity_error < 1e-9


def test_population_counts_are_the_products():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 1 << b, 130) for b in (1, 5, 40, 0 + 1)])
    x[:, 3] = 0
    bits = np.array([1, 5, 40, 0])
    assert (np.triu(x.astype(object).T @ x.astype(object)) == whitening.scatter(x, bits)).all()


def test_odd_tables(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()

    assert run([]) == [] and run([(1, None, "c", 1), (2, [], "c", 1)]) == []
    # Equal vectors and a single one have no variance.
    out = run([(1, [0.5, 0.25], "c", 1), (1, [0.5, 0.25], "c", 1)])
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in out] == [(1, 0, None, 0.0, None), (2, 0, None, 0.0, None)] * 2
    # A dependent dimension: one component with variance.
    out = run([(i, [float(i), 2.0 * i], "c", 1) for i in range(5)])
    assert all((r.whitened is None) == (r.component == 2) for r in out)
    # Squares beyond a long, from entries far apart.
    out = run([(1, [2.0**40], "c", 1), (2, [-(2.0**40)], "c", 1)])
    assert [(r.deviation, round(abs(r.whitened), 9)) for r in out] == [(None, 1.0)] * 2
