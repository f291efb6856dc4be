"""Decontamination against brute force over all diagonals, with substitutions."""

import random
import re

import numpy as np

from aerolake.llm import decontam

DOCS = "doc_id long, text string, item_id int, digest string"
ITEMS = "item_id long, text string, doc_id int"


def split(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())


def fixture():
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(3000)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [words(rng.randrange(7, 60)) for _ in range(40)] + [words(90), words(5), []]
    items.append(list(items[0]))
    docs, planted = [], set()
    for i in range(200):
        text = words(rng.randrange(0, 200))
        if i % 4 == 0:
            k = rng.randrange(41)
            part = list(items[k])
            if len(part) > 40 and i % 8 == 0:
                part = part[5:5 + rng.randrange(20, 35)]
            for j in range(0, len(part), 9):
                if i % 3 == 0 and len(part) >= 15:
                    part[j] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
            planted.add((i, k))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text).title(), 0, "x"))
    docs += [(500, None, 0, "x"), (501, "", 0, "x"), (502, " ".join(items[40]) * 1, 0, "x"),
             (503, docs[0][1], 0, "x"), (0, docs[0][1], 0, "x"), (None, docs[4][1], 0, "x"),
             (504, "filler word " * 60_000 + " ".join(items[3]), 0, "x"),
             (505, " ".join(items[0][:4]), 0, "x")]
    return docs, [(i, None if not w else " ".join(w), 1) for i, w in enumerate(items)], planted


def brute(docs, items):
    out = set()
    for doc, text, *_ in docs:
        d = split(text)
        place = {}
        for i, w in enumerate(d):
            place.setdefault(w, []).append(i)
        for item, itext, *_ in items:
            w = split(itext)
            if len(w) < 6:
                continue
            for at in {p - i for i, x in enumerate(w) for p in place.get(x, [])}:
                low, high = max(0, -at), min(len(w), len(d) - at)
                same = np.array([w[i] == d[at + i] for i in range(low, high)])
                if widest(same.tolist()) >= min(13, -(-4 * len(w) // 5)):
                    out.add((doc, item))
    return out


def test_overlaps_equal_brute_force(spark):
    docs, items, planted = fixture()
    got = decontam.contaminated(spark.createDataFrame(docs, DOCS),
                                spark.createDataFrame(items, ITEMS)).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found == brute(docs, items)
    assert planted <= found
    assert len(got) == len(found) + sum(1 for d, _ in found if d == 0)  # document 0 comes twice
    for r in got:
        assert 0.8 <= r.n_matches / r.n_words <= 1


def test_drop_and_empty_tables(spark):
    docs, items, _ = fixture()
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    bad = {d for d, _ in brute(docs, items)}
    out = decontam.drop_contaminated(df, bench)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(
        str(d[0]) for d in docs if d[0] not in bad)
    none, empty = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.contaminated(df, empty).count() == 0
    assert decontam.drop_contaminated(df, empty).count() == len(docs)


def widest(same):
    """Most matches of all stretches with four matches to each substitution, one by one."""
    best = 0
    for i in range(len(same)):
        for j in range(i + 1, len(same) + 1):
            hits = sum(same[i:j])
            if hits >= 4 * (j - i - hits):
                best = max(best, hits)
    return best


def test_most_matches_equals_all_stretches():
    rng = np.random.default_rng(5)
    for _ in range(400):
        same = rng.random(rng.integers(0, 40)) < rng.choice([0.5, 0.75, 0.85, 0.95])
        start, end, n = decontam.most_matches(same)
        assert n == widest(same.tolist()) == same[start:end].sum()
        assert n >= 4 * (end - start - n)
        assert not n or same[start] and same[end - 1]


def test_shorter_stretch_of_higher_score_hides_no_overlap(spark):
    item = [f"w{i}" for i in range(50)]
    two = list(item[:36])
    two[12:20] = [f"x{i}" for i in range(8)]
    two[28] = "changed"
    fifth = [w if i % 5 != 4 else f"x{i}" for i, w in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(two), 0, ""), (2, " ".join(fifth), 0, "")], DOCS)
    got = decontam.contaminated(docs, spark.createDataFrame([(7, " ".join(item), 0)], ITEMS))
    found = {r.doc_id: (r.item_word, r.n_words, r.n_matches) for r in got.collect()}
    assert found == {1: (20, 16, 15), 2: (0, 49, 40)}


def test_every_accepted_substitution_of_short_items_is_found(spark):
    """Items of 6 to 12 words with one word, and where accepted two words, changed."""
    items, docs = [], []
    for n in range(6, 13):
        words = [f"n{n}w{i}" for i in range(n)]
        items.append((n, " ".join(words), 0))
        for a in range(n):
            for b in range(a, n):
                if n - (1 if a == b else 2) >= -(-4 * n // 5):
                    text = [f"x{i}" if i in (a, b) else w for i, w in enumerate(words)]
                    docs.append((n * 10_000 + a * 100 + b, "before " + " ".join(text) + " after", 0, ""))
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert found == {(d[0], d[0] // 10_000) for d in docs} == brute(docs, items)


def test_parts_of_many_seeds_agree(spark, monkeypatch):
    docs, items, _ = fixture()
    monkeypatch.setattr(decontam, "SEEDS", 2)
    got = decontam.contaminated(spark.createDataFrame(docs, DOCS),
                                spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
