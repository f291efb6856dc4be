"""Whitening against covariances in whole numbers by plain loops."""

import math
import random

import numpy as np

from aerolake.llm import whitening

ROWS = "vec_id long, embedding array<float>, n int, deviation string"


def plain(vectors):
    """n, deviations, eigenvalues, axes and trace, from products of centred whole numbers."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    lag = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    cov = np.array([[sum(r[i] * r[j] for r in lag) / n ** 3 for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    return n, lag, [sum(v * v for v in r) for r in lag], values[::-1], axes[:, ::-1], np.trace(cov)


def vectors(n=300, d=10, seed=11):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(0.05, 3, d) + rng.normal(size=d)).astype(np.float32).tolist()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], ROWS)


def test_equals_plain_loops(spark):
    kept = list(enumerate(vectors())) + [(None, vectors(1, seed=2)[0]), (7, vectors(1, seed=3)[0]),
                                         (7, vectors(1, seed=3)[0]), (400, [0.0] * 10)]
    out = [(500, None), (501, [None] + [0.0] * 9), (502, [float("nan")] * 10),
           (503, [float("inf")] + [0.0] * 9), (504, []), (505, [1.0])]
    rows = kept + out
    random.Random(1).shuffle(rows)
    got = whitening.whiten(frame(spark, rows).repartition(5)).collect()
    n, lag, deviations, values, axes, trace = plain([v for _, v in kept])
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert {r.component for r in got} == set(range(1, 9))
    assert all(r.identity_error < 1e-9 for r in got)
    want = sorted(zip([-1 if i is None else i for i, _ in kept], deviations, range(n)))
    for c in range(8):
        mine = sorted(((-1 if r.vec_id is None else r.vec_id, int(r.deviation), r.whitened)
                       for r in got if r.component == c + 1))
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        white = [float(np.dot([v / n for v in lag[k]], axes[:, c]) / math.sqrt(values[c])) for _, _, k in want]
        sign = np.sign(np.dot([m[2] for m in mine], white))
        assert np.allclose([sign * m[2] for m in mine], white, atol=1e-9)
        explained = {r.explained for r in got if r.component == c + 1}
        assert len(explained) == 1 and math.isclose(explained.pop(), values[c] / trace, rel_tol=1e-9)


def test_polarisation_is_exact_for_large_values(spark):
    rng = random.Random(4)
    rows = [[rng.uniform(-1, 1) * 2.0 ** rng.randrange(0, 30) for _ in range(3)] for _ in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found = whitening.moments(whitening.valid_vectors(df, "vec_id", "embedding"))
    n, lag, _, _, _, _ = plain(rows)
    assert found.products == [[sum(r[i] * r[j] for r in lag) for j in range(3)] for i in range(3)]


def test_without_variance(spark):
    one = whitening.whiten(frame(spark, [(1, [0.5, 0.25])])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert all(r.whitened is None and r.explained == 0.0 for r in line if r.component == 2)
    assert all(r.identity_error < 1e-9 and r.explained == 1.0 for r in line if r.component == 1)


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        got = whitening.whiten(frame(spark, rows))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                               "identity_error"]
