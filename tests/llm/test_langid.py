"""Language identification: proper probabilities, held-out accuracy, odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from aerolake.llm import langid

DOCS = "doc_id long, text string, lang string, source string, score int, digest string"
SYLLABLES = {"aa": "ka lo mi tu re sa".split(), "bb": "schö über ngs ach ein itz".split(),
             "cc": "про ста ени ого льн чно".split()}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4)))
                    for _ in range(n))


def fixture():
    rng = random.Random(4)
    rows = [(i, words(rng, lang, rng.randrange(6, 120)).capitalize() + ".", lang, "s", 1, "x")
            for i in range(600) for lang in [rng.choice(sorted(SYLLABLES))]]
    rows += [(700, None, "aa", "s", 1, "x"), (701, "", "aa", "s", 1, "x"),
             (702, "123 !!! \n", "bb", "s", 1, "x"), (703, words(rng, "bb", 4), None, "s", 1, "x"),
             (None, words(rng, "cc", 30), "aa", "s", 1, "x"), (1, rows[1][1], rows[1][2], "s", 1, "x"),
             (704, words(rng, "aa", 60_000), "aa", "s", 1, "x"),
             (705, "q " * 200 + "zzxqj wvyx" * 20, None, "s", 1, "x")]
    return rows


def test_answers(spark):
    rows = fixture()
    got = langid.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    truth = {r[0]: r[2] for r in rows}
    by = {r.doc_id: r for r in got}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    wrong = [r for r in got if r.held_out and r.doc_id < 600 and r.lang_pred != truth[r.doc_id]]
    assert not wrong
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (700, 701, 702))
    assert by[703].lang_pred == "bb" and by[None].lang_pred == "cc" and by[704].lang_pred == "aa"
    assert by[705].lang_pred in SYLLABLES


def test_rejection_keeps_clean_documents(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, DOCS)
    out = langid.drop_rejected(df)
    assert out.columns == df.columns
    kept = Counter(r.doc_id for r in out.collect())
    gone = Counter(r[0] for r in rows) - kept
    assert set(gone) == {700, 701, 702, 705}


def test_no_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None, "s", 1, "x")], DOCS)
    assert [r.lang_pred for r in langid.identify(df).collect()] == ["und"]
    empty = spark.createDataFrame([], DOCS)
    assert langid.identify(empty).count() == 0
    assert langid.drop_rejected(empty).count() == 0


def test_probabilities_sum_to_one_and_equal_brute_force(spark):
    rng = random.Random(9)
    texts = [words(rng, "aa", 40) for _ in range(30)]
    model = langid.fit(spark.createDataFrame([("aa", t) for t in texts], "lang string, text string"))
    counts = {5: Counter()}
    for t in texts:
        codes = langid.letter_codes(t).tolist()
        counts[5].update(tuple(codes[i:i + 5]) for i in range(len(codes) - 4))
    for k in (4, 3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def discount(k):
        n1, n2 = (sum(1 for v in counts[k].values() if v == x) for x in (1, 2))
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    d = {k: discount(k) for k in counts}
    total = {k: defaultdict(int) for k in counts}
    kinds = {k: defaultdict(int) for k in counts}
    for k in counts:
        for g, n in counts[k].items():
            total[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1

    def prob(g):
        k = len(g)
        c, t, u = counts[k][g], total[k][g[:-1]], kinds[k][g[:-1]]
        if k == 1:
            return max(c - d[1], 0) / t + d[1] * u / t / 4096
        if not t:
            return prob(g[1:])
        return max(c - d[k], 0) / t + d[k] * u / t * prob(g[1:])

    letters = sorted({g[0] for g in counts[1]})
    some = [g for g in rng.sample(sorted(counts[5]), 60)]
    some += [tuple(rng.choice(letters) for _ in range(5)) for _ in range(60)]
    keys = np.array([sum(c << 12 * (4 - i) for i, c in enumerate(g)) for g in some])
    got = np.exp2(model.log_probs(keys)[:, 0])
    assert np.allclose(got, [prob(g) for g in some], rtol=1e-4)
    context = some[0][:4]
    every = np.array([sum(c << 12 * (4 - i) for i, c in enumerate((*context, x)))
                      for x in range(4096)])
    assert abs(np.exp2(model.log_probs(every)[:, 0].astype(float)).sum() - 1) < 1e-3


def test_hash_table():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 50_000))
    table = langid.HashTable(keys[::2])
    place = table.find(keys)
    assert (place[1::2] == -1).all()
    assert (keys[::2][table.order][place[::2]] == keys[::2]).all()
    assert (langid.HashTable(keys[:0]).find(keys[:9]) == -1).all()


def test_rare_grams_of_a_long_text_are_kept(spark):
    """A gram counted once among 600,000 has its own probability, not that of its suffix."""
    texts = ["kalo " * 120_000, "zyxwv", *[f"{c}yxw{c}" for c in "abcdefghijklmnopqrst"] * 2]
    model = langid.fit(spark.createDataFrame([("aa", t) for t in texts],
                                             "lang string, text string"))
    key = np.array([sum(ord(c) << 12 * (4 - i) for i, c in enumerate("zyxwv"))])
    assert np.exp2(model.log_probs(key)[0, 0]) > 0.3


def test_a_language_left_out_is_rejected_and_known_texts_are_kept(spark):
    """Unlabelled texts of other syllables in the same letters go; mixtures stay."""
    rng = random.Random(12)
    latin = {"aa": "ka lo mi tu re sa ne".split(), "bb": "tor uni che sal em pra is".split(),
             "xx": "kul ost irm ase tep unl oce".split()}
    text = lambda lang, n: " ".join(
        "".join(rng.choice(latin[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(i, text(lang, rng.randrange(30, 120)), None if lang == "xx" else lang, lang, 1, "x")
            for i in range(1500) for lang in ["aabbxx"[i % 3 * 2:i % 3 * 2 + 2]]]
    rows += [(2000 + i, text("aa", 200) + " " + text("bb", 200), None, "mix", 1, "x")
             for i in range(20)]
    df = spark.createDataFrame(rows, DOCS)
    kept = Counter(r.source for r in langid.drop_rejected(df).collect())
    assert kept["xx"] <= 25 and kept["aa"] >= 495 and kept["bb"] >= 495 and kept["mix"] == 20
