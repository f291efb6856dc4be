"""Near-duplicates against brute force; signatures against exact similarities."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from aerolake.llm import neardup
from aerolake.llm.textops import PIECE, word_hashes

DOCS = "doc_id long, text string, digest int, label string"


def bag(text):
    w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())
    if len(w) < 5:
        return Counter([tuple(w)] if w else [])
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def similarity(a, b):
    inter = sum((a & b).values())
    union = sum((a | b).values())
    return inter / union if union else 0.0


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for g in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randrange(8, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5, 12])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(rng.choice([" ", "\n", ", "]).join(copy))
    texts += ["spam ham " * n for n in (10, 12, 13, 40, 41, 400)]
    texts += [None, "", "!!!", "!!!", "one two", "One, two!", "one three", "é à ü ö ß",
              "big " + "text of many words " * 30_000, "big " + "text of many words " * 30_001]
    return texts


def brute_classes(texts):
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or similarity(bags[i], bags[j]) >= 0.8:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]


def as_sets(pairs):
    groups = defaultdict(list)
    for doc, label in pairs:
        groups[label].append(doc)
    return sorted(map(sorted, groups.values()))


def test_classes_equal_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], DOCS)
    got = neardup.near_duplicates(df).collect()
    assert as_sets((r.doc_id, r.class_id) for r in got) == as_sets(enumerate(brute_classes(texts)))
    size = Counter(r.class_id for r in got)
    assert all(r.class_size == size[r.class_id] for r in got)


def test_links_between_dissimilar_ends_of_a_bucket(spark):
    """A chain of texts, each like the next only; hubs alone would lose links."""
    words = [f"c{i}" for i in range(160)]
    texts = [" ".join(words[i:i + 60]) for i in range(0, 100, 5)]
    assert len(set(brute_classes(texts))) == 1
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], DOCS)
    assert {r.class_id for r in neardup.near_duplicates(df).collect()} == {0}


def test_drop_keeps_one_of_each(spark):
    texts = corpus(5)
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)]
    rows += [(0, texts[0], 0, "x"), (0, "another text under the same id", 1, "y"),
             (None, texts[3], 0, "x"), (None, "a text without any id", 0, "z")]
    df = spark.createDataFrame(rows, DOCS)
    out = neardup.drop_near_duplicates(df)
    assert out.columns == df.columns
    kept = [tuple(r) for r in out.collect()]
    labels = brute_classes([r[1] for r in rows])
    first = {}
    for row, label in zip(rows, labels):
        key = (row[0] is None, row[0] or 0)
        first[label] = min(first.get(label, key), key)
    assert sorted((r[0] is None, r[0] or 0) for r in kept) == sorted(first.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert neardup.near_duplicates(df).count() == 0
    assert neardup.drop_near_duplicates(df).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    a = [rng.choice(words) for _ in range(300)]
    texts = [" ".join(a), " ".join(a[:240]), "one two three four five " * 40,
             "one two three four five " * 52]
    _, sig = neardup.signatures(texts, 4096)
    for i, j in ((0, 1), (2, 3)):
        exact = similarity(bag(texts[i]), bag(texts[j]))
        assert abs(np.mean(sig[i] == sig[j]) - exact) < 0.04
    again = neardup.signatures(texts[2:], 4096)[1]
    assert (again == sig[2:]).all()


def test_word_hashes_of_long_texts():
    long = "word " * (PIECE // 3) + "end"
    h, bounds = word_hashes([long, "word", None, "x" * (2 * PIECE) + " word"])
    assert list(np.diff(bounds)) == [PIECE // 3 + 1, 1, 0, 2]
    assert len(set(h[:bounds[1] - 1].tolist())) == 1
    assert h[bounds[1]] == h[0] == h[-1]
