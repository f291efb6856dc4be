"""License scans by an exact set-similarity join of text blocks with templates.

Words are runs of ``[a-z0-9]`` and of characters beyond ASCII after lowering A-Z.
Blocks are windows of twice the words of the longest template, half overlapping, so
every stretch as long as a template lies in a block, whatever its lines. A block and a
template are sets of words; a template is found in a block that holds at least
``THRESHOLD`` of its words.

One pass reads the texts: it counts words, finds the base phrases, and keeps of every
block the words that stand in some template, the only ones an overlap can hold. The
join then works on these sets:

* global order: words by the number of all blocks of all texts that hold them, rarest
  first;
* prefix filter: a template that needs m of its t words must share one of its t - m + 1
  rarest with a block (and one of the block's, of which so many are left out as the
  least need of any template allows);
* length filter: the block must have m words;
* positional filter: behind the shared word enough words must be left on both sides;
* what is left is verified by counting the overlap.

Nothing is lost by these filters, so the join is exact. The templates are a parameter;
they and their index are sent to the tasks, at most ``MAX_TEMPLATE_WORDS`` words in
all, which is checked. Blocks meet templates where they are; the only exchange is of
found labels, pre-aggregated by row.

Nulls, empties, ties: a null text is empty: no words, no labels, score 0, null first
and last word; a null id is kept; repeated rows are each reported; an empty table gives
no rows. Long texts are read in pieces of ``PIECE`` bytes cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare

# Phrases whose words must stand consecutively, and their labels.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Sentences of well-known licenses and of the notices that name them.
TEMPLATES = (
    ("agpl", "licensed under the terms of the gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
    ("cc-by-sa", "licensed under cc by-sa 4.0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the terms of the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Share of a template's words that a block must hold.
THRESHOLD = 0.9
#: Most words of all templates together: what the tasks are sent grows with them only.
MAX_TEMPLATE_WORDS = 1 << 16
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20

_WORD = bytes(b if b in b"abcdefghijklmnopqrstuvwxyz0123456789" or b >= 128 else 32 for b in range(256))
_TO_WORDS = bytes(_WORD[ord(chr(b).lower())] if b < 128 else b for b in range(256))


def split_words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, in pieces."""
    at = 0
    while at < len(data):
        piece = data[at:at + PIECE].translate(_TO_WORDS)
        at += PIECE
        if at < len(data):
            cut = piece.rfind(b" ") + 1
            while not cut and at < len(data):  # a word longer than a piece
                piece += data[at:at + PIECE].translate(_TO_WORDS)
                at += PIECE
                cut = piece.rfind(b" ") + 1
            if cut and at < len(data):
                at -= len(piece) - cut
                piece = piece[:cut]
        yield piece.split()


def words_of(text: str) -> list[bytes]:
    return [w for piece in split_words(text.encode("utf-8", "surrogatepass")) for w in piece]


@dataclass(frozen=True)
class Templates:
    """Labelled sets of words, and what is derived from them."""

    labels: list[str]
    sets: list[list[int]]  # numbers of the distinct words of each template
    needed: list[int]
    numbers: dict[bytes, int]  # of the words of templates and base phrases
    block: int  # words of the longest template

    @classmethod
    def of(cls, templates=TEMPLATES, threshold: float = THRESHOLD) -> Templates:
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be above 0 and at most 1")
        labels, sets, longest, total = [], [], 1, 0
        numbers: dict[bytes, int] = {}
        for label, text in templates:
            words = words_of(text)
            if not words:
                raise ValueError(f"a template of {label} has no word")
            total += len(words)
            longest = max(longest, len(words))
            labels.append(label)
            sets.append(sorted({numbers.setdefault(w, len(numbers)) for w in words}))
        if total > MAX_TEMPLATE_WORDS:
            raise ValueError(f"the templates have {total} words, more than {MAX_TEMPLATE_WORDS}")
        # one rounding step below, so that 0.9 * 10 needs nine words
        needed = [max(1, int(np.ceil(threshold * len(s) - 1e-9))) for s in sets]
        for phrase, _ in BASE_PHRASES:
            for w in words_of(phrase):
                numbers.setdefault(w, len(numbers))
        return cls(labels, sets, needed, numbers, longest)

    @property
    def vocabulary(self) -> int:
        """Words of templates come first among the numbers."""
        return 1 + max((max(s) for s in self.sets), default=-1)


def base_places(numbers: np.ndarray, known: dict[bytes, int]) -> dict[str, np.ndarray]:
    """label -> starts of its phrase, over the word numbers of a text."""
    places = {}
    for phrase, label in BASE_PHRASES:
        words = [known[w] for w in words_of(phrase)]
        starts = np.flatnonzero(numbers[:max(0, len(numbers) - len(words) + 1)] == words[0])
        for k, w in enumerate(words[1:], 1):
            starts = starts[numbers[starts + k] == w]
        places[label] = starts
    return places


def blocks_of(numbers: np.ndarray, templates: Templates) -> tuple[np.ndarray, np.ndarray]:
    """(block, word) pairs, distinct and sorted, of the template words of a text."""
    step, vocabulary = templates.block, templates.vocabulary
    last = max(0, -(-len(numbers) // step) - 2)  # block b holds words b * step to (b + 2) * step
    at = np.flatnonzero((numbers >= 0) & (numbers < vocabulary))
    block = at // step
    inside = np.concatenate([np.minimum(block, last), np.maximum(np.minimum(block, last + 1) - 1, 0)])
    pairs = np.unique(inside * vocabulary + np.tile(numbers[at], 2))
    return pairs // max(vocabulary, 1), pairs % max(vocabulary, 1)


PROFILE = ("doc_id {id}, row long, n_words long, n_base long, first_word long, last_word long, "
           "base_labels array<string>, words array<int>, word_blocks array<int>, "
           "blocks array<array<int>>")


def profile(docs: DataFrame, templates: Templates, id_col: str, text_col: str) -> DataFrame:
    """One row per document: counts, base phrases, the blocks that could hold a template,
    and in how many of all its blocks each template word stands."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).cast("binary").alias("text"))
    schema = PROFILE.format(id=rows.schema["doc_id"].dataType.simpleString())
    least = min(templates.needed, default=0)

    def one(text: bytes) -> tuple:
        known = templates.numbers
        pieces = [np.fromiter((known.get(w, -1) for w in words), dtype=np.int32, count=len(words))
                  for words in split_words(text)]
        numbers = np.concatenate(pieces) if pieces else np.empty(0, dtype=np.int32)
        places = base_places(numbers, known)
        starts = np.concatenate(list(places.values()))
        block, word = blocks_of(numbers.astype(np.int64), templates)
        counted, blocks = np.unique(word, return_counts=True)
        _, at, size = np.unique(block, return_index=True, return_counts=True)
        kept = [word[a:a + n].tolist() for a, n in zip(at.tolist(), size.tolist()) if n >= least]
        found = len(starts) > 0
        return (len(numbers), len(starts), int(starts.min()) if found else None,
                int(starts.max()) if found else None, sorted(k for k, p in places.items() if len(p)),
                counted.tolist(), blocks.tolist(), kept)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        ints = pa.list_(pa.int32())
        types = [*[pa.int64()] * 4, pa.list_(pa.string()), ints, ints, pa.list_(ints)]
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            found = [one(t.as_py() or b"") for t in batch.column("text")]
            columns = zip(*found) if found else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"),
                 *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    return rows.mapInArrow(run, schema)


def word_ranks(profiles: DataFrame, vocabulary: int) -> list[int]:
    """Rank of each template word by the number of blocks of all texts that hold it."""
    each = profiles.select(F.explode(F.arrays_zip("words", "word_blocks")).alias("w"))
    counts = {r.word: r.n for r in each.groupBy(F.col("w.words").alias("word"))
              .agg(F.sum(F.col("w.word_blocks").cast("long")).alias("n")).collect()}
    order = sorted(range(vocabulary), key=lambda w: (counts.get(w, 0), w))
    ranks = [0] * vocabulary
    for rank, word in enumerate(order):
        ranks[word] = rank
    return ranks


def join_templates(profiles: DataFrame, templates: Templates, ranks: list[int]) -> DataFrame:
    """row, label, score of every template found in a block: the exact join."""
    spark = profiles.sparkSession
    sets = [sorted(ranks[w] for w in s) for s in templates.sets]
    least = min(templates.needed)
    index = spark.createDataFrame(
        [(s[i], t, i, len(s), need) for t, (s, need) in enumerate(zip(sets, templates.needed))
         for i in range(len(s) - need + 1)],
        "rank int, template int, at int, size int, needed int")
    whole = spark.createDataFrame(
        [(t, label, s) for t, (label, s) in enumerate(zip(templates.labels, sets))],
        "template int, label string, members array<int>")
    rank_of = F.array(*(F.lit(r) for r in ranks))
    blocks = profiles.select("row", F.explode("blocks").alias("block")).select(
        "row", F.array_sort(F.transform("block", lambda w: rank_of[w])).alias("block"))
    prefixes = blocks.select(
        "row", "block", F.size("block").alias("block_size"),
        F.posexplode(F.slice("block", F.lit(1), F.size("block") - least + 1)).alias("block_at", "rank"))
    behind = F.least(F.col("size") - F.col("at"), F.col("block_size") - F.col("block_at"))
    candidates = prefixes.join(F.broadcast(index), "rank").where(
        (F.col("block_size") >= F.col("needed")) & (behind >= F.col("needed")))
    overlap = F.size(F.array_intersect("block", "members"))
    return (candidates.join(F.broadcast(whole), "template")
            .where(overlap >= F.col("needed"))
            .select("row", "label", (overlap / F.col("size")).alias("score")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, base phrases, labels and score of every document.

    ``labels`` are those of base phrases and of templates; ``score`` is the largest share
    of a template's words in one block, of those at or above the threshold, 1 where a
    base phrase stands, and 0 otherwise.
    """
    known = Templates.of(templates, threshold)
    profiles = materialise(profile(docs, known, id_col, text_col), "license-profile")
    rows = profiles.select("doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base_labels")
    if known.sets:
        found = join_templates(profiles, known, word_ranks(profiles, known.vocabulary))
        per_row = found.groupBy("row").agg(F.collect_set("label").alias("found"),
                                           F.max("score").alias("best"))
        rows = rows.join(per_row, "row", "left")
    else:
        rows = rows.select("*", F.lit(None).cast("array<string>").alias("found"),
                           F.lit(None).cast("double").alias("best"))
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
