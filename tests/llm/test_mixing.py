"""Mixing: targets, schedule ranks, totals, defined results for odd rows."""

import re
from collections import Counter, defaultdict

import pytest

from aerolake.llm import mixing

DOCS = "doc_id long, text string, source string, size int, slot string"


def docs(spark, n=400):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, "word " * (1 + i * 37 % 211), source, -1, "x"))
    rows += [(n, None, "s1", 0, None), (n + 1, "", "s1", 0, None), (n + 2, " \t\n", "s2", 0, None),
             (n + 3, "a b c", None, 0, None), (n + 4, "a b", None, 0, None),
             (n + 5, "long " * 30_000, "s3", 0, None), (5, "word " * 186, "s5", -1, "x"),
             (None, "no id", "s4", 0, None)]
    return spark.createDataFrame(rows, DOCS), rows


def brute_targets(sizes, weights, share, most):
    total, capped = share * sum(sizes), {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped and sizes[i]]
        left = total - sum(capped.values())
        w = sum(weights[i] for i in rest)
        new = {i: most * sizes[i] for i in rest if left * weights[i] / w > most * sizes[i]}
        if not new:
            return [capped.get(i, left * weights[i] / w if i in rest else 0)
                    for i in range(len(sizes))]
        capped |= new


def test_targets_and_totals(spark):
    df, rows = docs(spark)
    got = mixing.words_taken(mixing.mix(df)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, brute_targets([size[s] for s in names],
                                           [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(2, 0.005 * target[s]), s
    again = mixing.words_taken(mixing.mix(df.repartition(7))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_schedule_ranks_and_discrepancy(spark):
    df, _ = docs(spark)
    _, sources = mixing.place(df, (3, 1, 2), 1.5, 2.0, 17, "doc_id", "text", "source")
    slots = sorted(mixing.schedule(df, sources).collect())
    seen = Counter()
    total = sum(s.slots for s in sources)
    assert len(slots) == total
    for n, r in enumerate(slots, 1):
        assert r["rank"] == seen[r.s]
        seen[r.s] += 1
        assert (r.epoch, r.block) == divmod(r["rank"], sources[r.s].blocks)
        share = sources[r.s].slots / total
        assert abs(seen[r.s] - n * share) < 2 + total.bit_length()
    assert seen == Counter({i: s.slots for i, s in enumerate(sources) if s.slots})


def test_whole_documents(spark):
    df, rows = docs(spark)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    copies = Counter(r.doc_id for r in out.collect())
    assert max(copies.values()) <= 4  # doc 5 comes twice in the input
    assert 400 not in copies and 401 not in copies


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert mixing.words_taken(mixing.mix(df)).count() == 0
    assert mixing.mix_documents(df).count() == 0
