"""Nearest neighbours: recall against brute force, exact scores, odd vectors."""

import numpy as np

from aerolake.llm import ann

ROWS = "vec_id long, embedding array<float>, label int, code string"


def brute(vectors, k, ids):
    usable = {i: np.array(v, dtype=np.float64) for i, v in vectors}
    names = np.array(sorted(usable))
    m = np.array([usable[i] for i in names])
    out = {}
    for q in ids:
        s = (m * usable[q]).sum(axis=1)
        order = sorted((-x, i) for x, i in zip(s, names) if i != q)[:k]
        out[q] = [(int(i), -x) for x, i in order]
    return out


def fixture(n=3000, d=32):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, d))
    v = (centres[rng.integers(0, 20, n)] + rng.normal(size=(n, d))).astype(np.float32)
    v *= rng.uniform(0.5, 2.0, size=(n, 1)).astype(np.float32)
    v[500:900] = v[500]
    return [(i, v[i].tolist()) for i in range(n)]


def test_recall_and_scores(spark):
    good = fixture()
    odd = [(5000, None), (5020, [0.0] * 32), (5040, [None] + [1.0] * 31), (5060, [float("nan")] * 32),
           (5080, [float("inf")] * 32), (5100, [1.0] * 5), (None, [1.0] * 32), (500, good[500][1])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in good + odd], ROWS).repartition(5)
    got = ann.nearest(df, df.where("vec_id % 20 = 0")).collect()
    truth = brute(good, 20, range(0, 3000, 20))
    answers = {}
    for r in got:
        answers.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(answers) == set(truth)
    hits = 0
    vectors = dict(good)
    for q, rows in answers.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        keys = [(-s, v) for _, v, s in rows]
        assert keys == sorted(keys) and q not in [v for _, v, _ in rows]
        for _, v, s in rows:
            exact = (np.array(vectors[q], dtype=np.float64) * np.array(vectors[v])).sum()
            assert abs(s - exact) < 1e-9
        hits += len({v for _, v, _ in rows} & {v for v, _ in truth[q]})
    assert hits / (20 * len(truth)) >= 0.9
    copies = answers[500]
    assert [v for _, v, _ in copies if v < 900 and v >= 500][:3] == [501, 502, 503]


def test_repeated_ids_with_a_vector_that_takes_no_part(spark):
    """The valid vector of the id is asked, whichever row comes first."""
    good = fixture()[:400]
    odd = [(20, [0.0] * 32), (40, [float("nan")] * 32), (60, None), (80, [1.0] * 5)]
    truth = brute(good, 20, range(0, 400, 20))
    for rows in (good + odd, odd + good):
        df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], ROWS).coalesce(1)
        answers = {}
        for r in ann.nearest(df, df.where("vec_id % 20 = 0")).collect():
            answers.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert set(answers) == set(truth)
        for q in (20, 40, 60, 80):
            assert len(answers[q]) == 20 and all(s != 0 for _, s in answers[q])
            assert len({v for v, _ in answers[q]} & {v for v, _ in truth[q]}) >= 16


def test_fewer_candidates_than_asked_and_empty(spark):
    rows = [(i, [1.0, float(i)], 0, "x") for i in range(0, 5)]
    df = spark.createDataFrame(rows, ROWS)
    got = sorted((r["rank"], r.vec_id) for r in ann.nearest(df, df.where("vec_id % 20 = 0")).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert ann.nearest(spark.createDataFrame([], ROWS), spark.createDataFrame([], ROWS)).count() == 0
    none = spark.createDataFrame([(0, None, 0, "x")], ROWS)
    assert ann.nearest(none, none).count() == 0


def test_part_radii_lose_nothing():
    rng = np.random.default_rng(1)
    for radius in range(0, 65, 5):
        radii = ann.part_radii(radius)
        for _ in range(300):
            bits = np.zeros(64, dtype=int)
            bits[rng.permutation(64)[:rng.integers(0, radius + 1)]] = 1
            parts = bits.reshape(4, 16).sum(axis=1)
            assert any(p <= r for p, r in zip(parts, radii))
