"""License scans against plain word lists and counts of every block."""

import math
import random
import re

import pytest

from aerolake.llm import licenses

DOCS = "doc_id long, text string, row int, labels string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def plain(doc_id, text, templates, threshold):
    words, places, labels, score = plain_words(text), [], set(), 0.0
    for phrase, label in licenses.BASE_PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(parts)] == parts]
    sets = [(label, set(plain_words(t))) for label, t in templates]
    step = max((len(plain_words(t)) for _, t in templates), default=1)
    for b in range(max(0, math.ceil(len(words) / step) - 2) + 1):
        block = set(words[b * step:(b + 2) * step])
        for label, members in sets:
            share = len(block & members) / len(members)
            if share >= threshold - 1e-12:
                labels.add(label)
                score = max(score, share)
    base = {label for _, label in places}
    starts = [i for i, _ in places]
    return (doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else score)


def texts():
    rng = random.Random(12)
    pool = [w for _, t in licenses.TEMPLATES for w in plain_words(t)] + ["foo", "bar", "über", "日本"] * 9
    out = []
    for _ in range(250):
        words = []
        for _ in range(rng.randrange(0, 8)):
            if rng.random() < 0.5:
                copy = plain_words(rng.choice(licenses.TEMPLATES)[1])
                for _ in range(rng.randrange(0, 3)):
                    at = rng.randrange(len(copy))
                    copy[at:at + 1] = rng.choice([[], ["other"], [copy[at], "put", "in"]])
                words += copy
            else:
                words += [rng.choice(pool) for _ in range(rng.randrange(0, 60))]
        out.append("".join(w + rng.choice([" ", "-", "\n", ". ", ", "]) for w in words).title())
    return out + [None, "", " .. ", "CC-BY", "cc\nby cc by", "All rights reserved", "all  rights, reserved!",
                  "general public license general public license", "x" * 3_000_000,
                  "é" * 2_000_000 + " cc by", "lorem ipsum " * 200_000 + "Released under the MIT License."]


def rows_of(frame):
    key = lambda r: tuple(str(v) for v in r)
    return sorted(map(tuple, frame.collect()), key=key)


@pytest.mark.parametrize("templates, threshold", [
    (licenses.TEMPLATES, licenses.THRESHOLD), (licenses.TEMPLATES, 0.5),
    ((("a", "one"), ("b", "foo bar"), ("b", "foo bar foo und")), 1.0), ((), 0.9)])
def test_equals_all_blocks(spark, templates, threshold):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, "released under the mit license", 1, "x")]
    got = rows_of(licenses.scan(spark.createDataFrame(rows, DOCS).repartition(4),
                                templates=templates, threshold=threshold))
    want = sorted((plain(r[0], r[1], templates, threshold) for r in rows), key=lambda r: tuple(str(v) for v in r))
    assert got == want


def test_labels_of_notices_and_prose(spark):
    rows = [(1, "Some text.\nLicensed under the Apache License,\n Version 2.0. More.", 0, ""),
            (2, "The license of the road is under review.", 0, ""),
            (3, "Licensed under CC BY-NC 4.0", 0, "")]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: ("apache-2.0", 1.0), 2: ("", 0.0), 3: ("cc-by,cc-by-nc", 1.0)}


def test_words_of_pieces(monkeypatch):
    text = "Ab-c déf " * 50 + "g" * 100 + " h" * 30
    monkeypatch.setattr(licenses, "PIECE", 7)
    assert [w.decode() for w in licenses.words_of(text)] == plain_words(text)


def test_bounds_and_empty_table(spark, monkeypatch):
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        licenses.Templates.of((("a", "-"),))
    monkeypatch.setattr(licenses, "MAX_TEMPLATE_WORDS", 3)
    with pytest.raises(ValueError):
        licenses.Templates.of((("a", "one two three four"),))
