"""Token records: exact round trip and ids equal to encoding each text at once."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from aerolake.llm import token_records as tr
from aerolake.session import scratch_dir

TEXTS = ["Hello, world. it's  a TEST\n\nnext\tline", None, "", "   ", "ĞÜŞ İstanbul µm ª №5",
         "co-op. don't can't... wait, 'S", "αβγς ΑΣ. ΐ", "日本語 テスト。", "áé x́.",
         "x" * 5000, "word, " * 40_000, "tab\x0bvt\x0cff\x1cfs\x85nel nbsp", "1234 5a6b ½",
         "<|endoftext|> mid<|startoftext|>dle", "Straße, ÄÖÜ. ÿ", "emoji 👩‍👩‍👧 ok.", "Hello, world. it's",
         "<|ENDOFTEXT|> A", "y" * 9000 + " tail.", "End . , .. ,, x., x.. 5. É. é, a\r\nB.\tC,", "..., .a ,b a,b. "]
DOCS = "doc_id long, text string, start string, file int"


def reference(text):
    t = Tokenizer.from_file(tr.default_tokenizer())
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_round_trip(spark):
    rows = [(i * 7 % 17, t, "x", 1) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", "x", 1), (3, TEXTS[0], "x", 1), (3, TEXTS[0], "x", 1)]
    got = tr.encode_to_records(spark.createDataFrame(rows, DOCS), tr.default_tokenizer()).collect()
    assert len(got) == len(rows)
    expected = {}
    for doc, text, *_ in rows:
        ids = reference(text)
        crc = zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
        expected.setdefault(doc, []).append((len(ids), crc))
    found = {}
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


def test_shuffled_reads_and_damage(spark, tmp_path):
    rows = [(i, f"text number {i} " * (i % 9), "x", 1) for i in range(300)]
    df = spark.createDataFrame(rows, DOCS)
    root = scratch_dir(spark, "test-records")
    index = tr.write_records(df, tr.default_tokenizer(), root)
    some = index.where("doc_id % 5 = 2").orderBy("length")
    got = {r.doc_id: r.ids for r in tr.read_records(some, root).collect()}
    assert got == {i: reference(rows[i][1]) for i in range(2, 300, 5)}
    record = tr.frame(b"payload")
    assert tr.unframe(record) == b"payload"
    for at in (0, 9, 14, len(record) - 1):
        damaged = bytearray(record)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            tr.unframe(bytes(damaged))


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert tr.encode_to_records(df, tr.default_tokenizer()).count() == 0


def thue_morse(n, flip=0):
    return "".join("ab"[(bin(i).count("1") + flip) & 1] for i in range(n))


def test_words_made_to_collide_under_polynomial_hashes():
    import json

    from aerolake.llm.chunk_encoder import ChunkEncoder
    from aerolake.llm.textops import word_hashes

    path = tr.default_tokenizer()
    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        lower = "Lowercase" in json.dumps(json.load(f)["normalizer"])
    encoder = ChunkEncoder(whole, "u2", lower=lower)
    for n in (512, 1024, 2048, 4096, 8192):
        a, b = thue_morse(n), thue_morse(n, 1)
        text = f"start {a} mid {b} end"
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], dtype="u2").tolist() == expected
        assert len(set(word_hashes([f"{a} {b}"])[0].tolist())) == 2


def test_a_part_with_another_parts_hash_goes_through_the_tokenizer(monkeypatch):
    from aerolake.llm import chunk_encoder

    whole = Tokenizer.from_file(tr.default_tokenizer())
    monkeypatch.setattr(chunk_encoder, "block_hashes",
                        lambda values, counts, lengths: np.full(len(counts), 7, dtype=np.uint64))
    encoder = chunk_encoder.ChunkEncoder(whole, "u2")
    for text in ("one one one", "one two three", "two", "one"):
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], dtype="u2").tolist() == expected
