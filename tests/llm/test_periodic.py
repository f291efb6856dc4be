"""Periodic runs against a plain scan of every period; rotation; edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from aerolake.llm import periodic

DOCS = "doc_id long, text string, row string, n_runs int"


def plain_runs(words):
    """All runs, by comparing each word with the one a period on."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def repetitive(rng, letters, n):
    out = []
    while len(out) < n:
        stretch = [rng.randrange(letters) for _ in range(rng.randrange(1, 12))]
        out += stretch * (rng.randrange(1, 12) if rng.random() < 0.5 else 1)
    return out[:n]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_all_runs_of_many_small_texts():
    rng = random.Random(13)
    for _ in range(400):
        texts = [repetitive(rng, rng.choice([1, 2, 3, 9]), rng.randrange(0, rng.choice([8, 50, 300])))
                 for _ in range(rng.randrange(1, 6))]
        got = periodic.find_runs([np.array(t, dtype=np.int64) for t in texts])
        for text, runs in zip(texts, got):
            assert sorted(map(tuple, runs.tolist())) == plain_runs(text)


@pytest.mark.parametrize("text", [fibonacci(600), [0] * 500, [0, 1] * 250, [0] * 300 + [1] + [0] * 300,
                                  [*range(120)] * 5, [i & -i for i in range(1, 700)]])
def test_texts_of_many_nested_repeats(text):
    runs = periodic.find_runs([np.array(text, dtype=np.int64)])[0]
    assert sorted(map(tuple, runs.tolist())) == plain_runs(text)


def test_extensions_of_all_pairs():
    rng = random.Random(5)
    text = repetitive(rng, 2, 150)
    grammar = periodic.Grammar(np.array([9, *text, 10]))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(1, 152), np.arange(1, 152)))
    a, b = a[a < b], b[a < b]
    ends = list(zip(grammar.extend(a, b).tolist(), grammar.extend_back(a, b).tolist()))
    s = [9, *text, 10]
    for i, j, (on, back) in zip(a.tolist(), b.tolist(), ends):
        k = 0
        while s[i + k] == s[j + k]:
            k += 1
        assert on == k
        k = 0
        while s[i - 1 - k] == s[j - 1 - k]:
            k += 1
        assert back == k


def test_slices_of_the_grid_change_nothing(monkeypatch):
    text = np.array(repetitive(random.Random(2), 3, 900), dtype=np.int64)
    whole = periodic.find_runs([text])[0].tolist()
    monkeypatch.setattr(periodic, "BATCH_POINTS", 50)
    assert periodic.find_runs([text])[0].tolist() == whole


def test_reports(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{x}" for x in repetitive(rng, 3, rng.randrange(0, 200))), "x", 1)
            for i in range(300)]
    rows += [(900, None, "x", 1), (901, "", "x", 1), (902, " \t\n", "x", 1), (None, "a " * 9, "x", 1),
             (903, "á b\x1cc " * 30, "x", 1), (904, "one", "x", 1), (905, "a\x0bb\x0cb\r" * 8, "x", 1),
             (5, "a b " * 12, "x", 1), (5, "a b " * 12, "x", 1)]
    rows += [(1000 + i, " ".join(map(str, range(i))), "x", 1) for i in range(1, 40)]  # rotated ones too
    got = periodic.report_runs(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted((plain_report(r[0], r[1]) for r in rows), key=key)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 20


def test_long_text_and_empty_table(spark):
    text = " ".join(str(i % 700) for i in range(200_000))
    (row,) = periodic.report_runs(spark.createDataFrame([(3, text, "", 0)], DOCS), rotated=False).collect()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 0, 200_000, 700)
    empty = periodic.report_runs(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
