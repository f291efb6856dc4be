"""Benchmark decontamination by spaced-seed hashing.

A mask of a spaced seed looks at some of a window's words and ignores the others, so
a window still hashes alike when ignored words were substituted. Hashes of all
windows of the benchmark items, under each mask, are joined with those of all
windows of the documents. Items of at most FEW words also have the masks of four words,
which hit every substitution that such an item accepts; documents are looked at under
these masks only if there are such items. Of the patterns of whole items that are accepted,
those of 13, 14 and 17 to 30 words miss none, those of 15 and 16 under one in a hundred.

A hit fixes a diagonal (where in the document the item would start); on each diagonal the
words are compared one by one, and of the contiguous overlaps with at least four matches
to each substitution the one with most matches is kept. An overlap counts from 13 matching
words on, or from four fifths of an item for which that is less. An item of fewer words
than the shortest mask (six) is no evidence of anything and matches nothing.

Before the join, windows are dropped whose hash cannot be an item's: a bitmap of
fixed size holds one bit for each item hash and is the only thing broadcast. A
larger benchmark lets more windows through to the join, and nothing else changes.

Nulls, empties, ties, repeats: a null text is empty and matches nothing; equal items
(by their words) are compared once and reported for each id; equal documents are
compared once and reported for each row; of several overlaps of a document and an
item the one with most matches, then the first, is reported; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare, text_digest, texts_of
from aerolake.llm.textops import chunks, mix64, word_hashes

#: Positions with 1 are compared; each mask has six of them.
MASKS = ("111111", "11011011", "1100101011", "101100100101")
#: Masks of items of at most FEW words, besides those above.
FINE, FEW = ("1111", "11011"), 12
#: Seeds of a document that are compared together; the text is there once for each so many.
SEEDS = 1000
#: Bits of the bitmap of item hashes (4 MiB).
FILTER_BITS = 25
MIN_MATCHES = 13
#: Matches that a substitution costs; an overlap of no negative score has four fifths of matches.
COST = 4


def masked_hashes(words: np.ndarray, mask: str, seed: int) -> np.ndarray:
    """Hash of each window of ``len(mask)`` words under the mask."""
    n = max(0, len(words) - len(mask) + 1)
    acc = np.full(n, np.uint64(seed + 1), dtype=np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            acc *= np.uint64(0x100000001B3)
            acc += words[j:j + n]
    return mix64(acc)


def window_hashes(words: np.ndarray, bounds: np.ndarray, fine: bool, few: int | None = None):
    """(hash, text number, position) of every window of every text, mask by mask.

    ``fine``: under the masks FINE too, of texts of at most ``few`` words (None: all) and
    at least as many as the shortest of MASKS has.
    """
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - bounds[:-1][owner]
    for seed, mask in enumerate((*MASKS, *FINE) if fine else MASKS):
        h = masked_hashes(words, mask, seed)
        size = counts[owner[:len(h)]]
        ok = place[:len(h)] + len(mask) <= size
        if mask in FINE and few is not None:
            ok &= (size <= few) & (size >= len(MASKS[0]))
        yield h[ok], owner[:len(h)][ok], place[:len(h)][ok]


def most_matches(same: np.ndarray) -> tuple[int, int, int]:
    """(from, to, matches) of the contiguous part with most matches, then the first, among
    those with at least COST matches to each substitution; it starts and ends in a match."""
    starts = np.flatnonzero(same)
    if not len(starts):
        return 0, 0, 0
    score = np.concatenate([[0], np.cumsum(np.where(same, 1, -COST))])
    # The last end whose score is not below the start's: scores to come, at their highest, fall.
    ahead = np.maximum.accumulate(score[::-1])[::-1]
    ends = np.searchsorted(-ahead, -score[starts], side="right") - 1
    matches = np.searchsorted(starts, ends) - np.arange(len(starts))
    k = int(np.argmax(matches))
    n = int(matches[k])
    return int(starts[k]), int(starts[k + n - 1]) + 1, n


def needed(n_words: int) -> int:
    """Matches from which an overlap with an item of so many words counts."""
    return min(MIN_MATCHES, -(-4 * n_words // 5))


def item_windows(items: DataFrame) -> DataFrame:
    """item (digest of its words), words, and its windows: array of (hash, place).

    ``items``: item_id, text. An item is as long as a question; its windows are few.
    """
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column("item_id"), batch.column("text").to_pylist()
            for a, b in chunks(texts):
                words, bounds = word_hashes(texts[a:b])
                each = [words[s:e] for s, e in zip(bounds[:-1], bounds[1:])]
                found = [[], [], []]
                for h, owner, place in window_hashes(words, bounds, True, FEW):
                    for out, x in zip(found, (h, owner, place)):
                        out.append(x)
                h, owner, place = map(np.concatenate, found)
                order = np.argsort(owner, kind="stable")
                ends = np.searchsorted(owner[order], np.arange(b - a + 1)).astype(np.int32)
                windows = pa.StructArray.from_arrays(
                    [pa.array(h[order].view(np.int64)), pa.array(place[order].astype(np.int64))],
                    names=["hash", "place"])
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a),
                    pa.array([hashlib.md5(w.tobytes()).digest() for w in each], pa.binary()),
                    pa.array([w.view(np.int64) for w in each], pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array(ends), windows)],
                    names=["item_id", "item", "words", "windows"])

    kind = dict(items.dtypes)["item_id"]
    return items.select("item_id", "text").mapInArrow(
        run, f"item_id {kind}, item binary, words array<long>, "
             "windows array<struct<hash: long, place: long>>")


def hash_bitmap(windows: DataFrame) -> np.ndarray:
    """One bit for each item hash, of fixed size; partial bitmaps come one by one."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            bits[h >> np.uint64(64 - FILTER_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                         names=["bits"])

    total = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for row in windows.select("hash").coalesce(8).mapInArrow(run, "bits binary").toLocalIterator():
        total |= np.frombuffer(row["bits"], dtype=np.uint8)
    return total


def compare(rows: DataFrame) -> DataFrame:
    """Best overlap of each (digest, item) of a row. ``rows``: digest, text and seeds, an array
    of (item, words, diagonal)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, out = batch.column("text").to_pylist(), []
            digests, seeds = batch.column("digest"), batch.column("seeds")
            for a, b in chunks(texts):
                words, bounds = word_hashes(texts[a:b])
                for i in range(a, b):
                    doc = words[bounds[i - a]:bounds[i - a + 1]].view(np.int64)
                    best: dict[bytes, tuple] = {}
                    for seed in seeds[i].as_py():
                        item, at = np.array(seed["words"], dtype=np.int64), seed["diagonal"]
                        low, high = max(0, -at), min(len(item), len(doc) - at)
                        same = item[low:high] == doc[at + low:at + high]
                        start, end, matches = most_matches(same)
                        if matches < needed(len(item)):
                            continue
                        found = (-matches, at + low + start, low + start, end - start, len(item))
                        best[seed["item"]] = min(best.get(seed["item"], found), found)
                    out += [(digests[i].as_py(), item, at, place, n, -m, -m / size)
                            for item, (m, at, place, n, size) in best.items()]
            cols = list(zip(*out)) or [[]] * 7
            types = [pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["digest", "item", "doc_word", "item_word", "n_words", "n_matches",
                       "coverage"])

    return rows.select("digest", "text", "seeds").mapInArrow(
        run, "digest binary, item binary, doc_word long, item_word long, n_words long, "
             "n_matches long, coverage double")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """Overlaps of documents with benchmark items.

    One row per document and item: doc_id, digest (of the document's text), item_id,
    doc_word and item_word (where the overlap starts), n_words (its length),
    n_matches, and coverage (matches to the item's words).
    """
    spark = docs.sparkSession
    prepare(spark)
    items = materialise(item_windows(benchmark.select(
        F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))), "items")
    ids = items.select("item_id", "item")
    distinct = materialise(items.groupBy("item").agg(F.first("words").alias("words"),
                                                     F.first("windows").alias("windows")),
                           "distinct-items")
    windows = materialise(distinct.select("item", F.inline("windows")), "item-windows")
    bitmap = spark.sparkContext.broadcast(hash_bitmap(windows))
    fine = bool(distinct.where(F.size("words").between(len(MASKS[0]), FEW)).take(1))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits = bitmap.value
        for batch in batches:
            texts, digests = batch.column("text").to_pylist(), batch.column("digest")
            for a, b in chunks(texts):
                words, bounds = word_hashes(texts[a:b])
                for h, owner, place in window_hashes(words, bounds, fine):
                    slot = h >> np.uint64(64 - FILTER_BITS)
                    byte = bits[slot >> np.uint64(3)]
                    k = np.flatnonzero((byte << (slot & np.uint64(7)).astype(np.uint8)) & 128)
                    yield pa.RecordBatch.from_arrays(
                        [digests.take(pa.array(owner[k] + a)), pa.array(h[k].view(np.int64)),
                         pa.array(place[k].astype(np.int64))], names=["digest", "hash", "at"])

    hits = materialise(rows.select("digest", "text").mapInArrow(
        scan, "digest binary, hash long, at long"), "window-hits")
    # Equal texts, and seeds that fall on one diagonal, are one candidate.
    diagonals = materialise(
        hits.join(windows, "hash")
        .select("digest", "item", (F.col("at") - F.col("place")).alias("diagonal")).distinct(),
        "diagonals")
    # A document's seeds are compared in parts of about SEEDS.
    parts = diagonals.groupBy("digest").agg(F.ceil(F.count("*") / SEEDS).alias("parts"))
    seeds = materialise(
        diagonals.join(parts, "digest")
        .withColumn("part", F.pmod(F.xxhash64("item", "diagonal"), "parts"))
        .join(distinct.select("item", "words"), "item")
        .groupBy("digest", "part")
        .agg(F.collect_list(F.struct("item", "words", "diagonal")).alias("seeds")), "seeds")
    texts = texts_of(rows, materialise(parts.select("digest"), "hit-digests"), "digest")
    best = F.min(F.struct((-F.col("n_matches")).alias("fewer"), "doc_word", "item_word", "n_words",
                          "n_matches", "coverage"))
    overlaps = materialise(compare(texts.join(seeds, "digest")).groupBy("digest", "item")
                           .agg(best.alias("best")).select("digest", "item", "best.*").drop("fewer"),
                           "overlaps")
    found = overlaps.join(ids, "item").drop("item")
    return rows.select("doc_id", "digest").join(found, "digest").select(
        "doc_id", "digest", "item_id", "doc_word", "item_word", "n_words", "n_matches", "coverage")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap with a benchmark item."""
    bad = materialise(contaminated(docs, benchmark, id_col, text_col, item_col, item_text_col)
                      .select(F.col("digest").alias("__digest")).distinct(), "contaminated")
    return docs.join(bad, text_digest(docs[text_col]) == bad["__digest"], "left_anti")
