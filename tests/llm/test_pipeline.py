"""The pipeline on a small fixture, stage by stage against brute force."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from aerolake.llm import token_records
from aerolake.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(21)
    syllables = {"aa": "ka lo mi tu re sa ne po".split(), "bb": "schö über ngs ach ein itz ung".split()}

    def prose(lang, n):
        return " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(2, 5)))
                        for _ in range(n))

    items = [prose("aa", 30) for _ in range(5)]
    rows = []
    for i in range(240):
        lang = rng.choice(["aa", "bb"])
        text = prose(lang, rng.randrange(120, 300))
        if i % 20 == 3:
            text += " " + items[i % 5]
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    rows += [(300 + i, rows[2 * i][1], rows[2 * i][2], "s1", 0) for i in range(20)]  # copies
    rows += [(400, None, "aa", "s0", 0), (401, "!!! 123", "aa", "s0", 0),
             (402, "zzxqj wvyx qqq xxw " * 60, None, "s0", 0)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "mix_sources", "token_records"]
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{sf_dir}/after_{name}"
        out = stage(spark, steps[-1], sf_dir)
        assert out.columns == docs.columns
        out.write.parquet(path)
        steps.append(spark.read.parquet(path))
    ids = [sorted(r.doc_id for r in s.collect()) for s in steps]
    assert set(ids[0]) - set(ids[1]) == {400, 401, 402}
    assert ids[2] == [i for i in ids[1] if i < 300]
    assert ids[3] == [i for i in ids[2] if i % 20 != 3]
    assert set(ids[4]) <= set(ids[3]) and max(map(ids[4].count, ids[4])) <= 2
    last = stages["token_records"](spark, steps[-1], sf_dir).collect()
    tokenizer = Tokenizer.from_file(token_records.default_tokenizer())
    text = {r.doc_id: r.text for r in steps[-1].collect()}
    at = 0
    for r in sorted(last, key=lambda r: r.start):
        tokens = [*tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.asarray(tokens, dtype="<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(tokens), crc)
        at += len(tokens)
    run = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, last))


def test_queries_are_registered():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
