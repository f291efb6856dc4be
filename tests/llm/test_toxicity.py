"""Toxicity chain: held-out accuracy, the chain's inputs, odd rows."""

import random

import numpy as np

from aerolake.llm import toxicity

DOCS = "doc_id long, text string, toxic int, labels string"
LABELS = "doc_id long, quality int, toxic int, text string"


def fixture(n=1500):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
             for _ in range(2000)]
    bad = ["idiot", "scum", "xjuqa", "xjuqoir", "xjuqent", "xjuqel", "xjuqix"]
    rows, truth = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(5, 300))]
        toxic, poor = rng.random() < 0.15, rng.random() < 0.3
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        if poor:
            words += ["buy", "cheap", "click"]
        rows.append((i, " ".join(words).capitalize() + ".", 0, "x"))
        truth.append((i, int(not poor), int(toxic)))
    return rows, truth


def test_held_out_documents(spark):
    rows, truth = fixture()
    odd = [(5000, None, 0, "x"), (5001, "", 0, "x"), (None, "no id", 0, "x"), (3, rows[3][1], 0, "x"),
           (5002, "clean words " * 40_000, 0, "x"), (5003, "clean words " * 40_000 + "scum idiot", 0, "x")]
    labels = [(i, q, t, "x") for i, q, t in truth if i % 3 != 1]
    labels += [(0, None, None, "x"), (9999, 1, 1, "x"), (None, 1, 1, "x"), (3, 0, truth[3][2], "x"),
               (5000, None, 0, "x")]
    df, known = spark.createDataFrame(rows + odd, DOCS), spark.createDataFrame(labels, LABELS)
    got = toxicity.classify(df, known).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    wrong = [i for i, _, t in truth if i % 3 == 1 and by[i].toxic != bool(t)]
    assert len(wrong) <= 0.02 * len(truth) / 3
    poor = [i for i, q, _ in truth if i % 3 == 1 and (by[i].p_quality >= 0.5) != bool(q)]
    assert len(poor) <= 0.05 * len(truth) / 3
    assert not by[5000].toxic and not by[5001].toxic and not by[None].toxic
    assert not by[5002].toxic and by[5003].toxic
    assert all(0 <= r.p_toxic <= 1 for r in got)
    again = toxicity.classify(df.repartition(5), known.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_later_models_use_earlier_probabilities(spark):
    """The second label is the first one's: its only way is through the chain."""
    rows, truth = fixture(600)
    labels = [(i, t, t if i % 2 else None, "x") for i, _, t in truth]
    chain = toxicity.fit(spark.createDataFrame(rows, DOCS).select("doc_id", "text"),
                         spark.createDataFrame(labels, LABELS).select("doc_id", "quality", "toxic"))
    assert len(chain.links) == 2 and len(chain.links[1].earlier) == 1
    assert chain.links[1].earlier[0] > 0


def test_logistic_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = (rng.random((400, 12)) < 0.3).astype(float)
    extra = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ rng.normal(size=12) + extra[:, 0])))).astype(float)
    owner, place = np.nonzero(x)
    w, e, b = toxicity.fit_logistic(place, owner, extra, y, 12)
    full, v = np.column_stack([x, extra]), np.concatenate([w, e])
    p = 1 / (1 + np.exp(-(full @ v + b)))
    assert np.abs(full.T @ (p - y) + toxicity.RIDGE * v).max() < 1e-3 and abs((p - y).sum()) < 1e-2


def test_no_labels_and_empty_table(spark):
    rows, _ = fixture(20)
    df, none = spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)
    assert not any(r.toxic for r in toxicity.classify(df, none).collect())
    ones = spark.createDataFrame([(1, 1, 0, "x")], LABELS)
    assert not any(r.toxic for r in toxicity.classify(df, ones).collect())
    assert toxicity.classify(spark.createDataFrame([], DOCS), none).count() == 0


def test_probabilities_do_not_depend_on_the_sample(spark, monkeypatch):
    """Labels that texts tell nothing of: the probability is their share, however few are sampled."""
    rng = random.Random(3)
    rows, _ = fixture(1500)
    labels = [(i, 1, int(rng.random() < 0.1), "x") for i, *_ in rows]
    share = sum(t for _, _, t, _ in labels) / len(labels)
    monkeypatch.setattr(toxicity, "CLASS_ROWS", 100)
    got = toxicity.classify(spark.createDataFrame(rows, DOCS),
                            spark.createDataFrame(labels, LABELS)).collect()
    assert abs(np.median([r.p_toxic for r in got]) - share) < 0.05
    assert abs(np.mean([r.p_toxic for r in got]) - share) < 0.1


def test_weights_count_as_repeated_rows():
    rng = np.random.default_rng(1)
    p, y, weight = rng.random(50), (rng.random(50) < 0.4) * 1.0, rng.integers(1, 5, 50)
    assert toxicity.best_threshold(p, y, weight * 1.0) == toxicity.best_threshold(
        np.repeat(p, weight), np.repeat(y, weight))
    x = (rng.random((50, 4)) < 0.5) * 1.0
    fit = lambda x, y, w: toxicity.fit_logistic(*np.nonzero(x)[::-1], np.zeros((len(y), 0)), y, 4, w)
    one, two = fit(x, y, weight * 1.0), fit(np.repeat(x, weight, 0), np.repeat(y, weight), None)
    assert np.allclose(one[0], two[0], atol=1e-3) and abs(one[2] - two[2]) < 1e-3
