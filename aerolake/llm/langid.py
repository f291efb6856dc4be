"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; each run of other characters than letters becomes one blank.
A character takes 12 bits (code points from 2,048 on share 2,048 further codes), so
a run of five is one 60-bit number, its context and its suffix are shifts and masks
of it, and all counts are plain aggregations in Spark over every labelled text:

* order 5 has occurrence counts, orders 4 to 1 have continuation counts (distinct
  characters to the left), each with the discount n1 / (n1 + 2 n2) of its language;
* every counted gram is in the model, however rare, so probabilities are those of the
  whole text. The model is built on the driver and is what the workers get: its size is
  that of the distinct grams of the labelled texts, and grows with them.

A model is a set of sorted hash arrays: grams in the order of their mixed hashes, an
index of the hashes' leading bits, and one row of log-probabilities, a column for
each language. A gram that no language has backs off: the weights of its context are
added and the next lower order is looked up.

A text gets the language of the lowest cross-entropy per character. Rejection is
calibrated on labelled texts that the model did not see: one labelled text in FOLDS (by
its digest, so copies stay together) is kept from the model, and a language's limit is a
high percentile of the entropies of its texts among those, less an allowance for short texts,
plus a small margin. A language with few such texts takes the highest limit of all. For
rejection an entropy is that of pieces of the text, each in the language that suits
it, so a text that mixes learned languages is not rejected for that. A text above its
language's limit, or without letters, is rejected.

Nulls, empties, ties, repeats: a null text and one without letters are ``und`` with
score 0, and rejected; rows with a null language teach nothing; equal entropies go to
the language first by code point; each repeated row counts and is answered; without
any labelled text every answer is ``und``; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare, text_digest
from aerolake.llm.textops import chunks, mix64

ORDER = 5
BITS = 12
#: Rejection: percentile of the unseen labelled texts' entropies, margin in bits, allowance in
#: bits for a text of one character (it falls with the square root of the length, and is the
#: same for all texts from LONG characters on).
PERCENTILE, MARGIN, SHORT, LONG = 0.999, 0.3, 8.0, 400
#: One labelled text in FOLDS calibrates; a language needs ENOUGH of them for a limit of its own.
FOLDS, ENOUGH = 5, 20
#: Characters of a piece of a text.
PIECE = 128
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letter_codes(text: str | None) -> np.ndarray:
    """12-bit codes of a text's letters with single blanks (32), padded for contexts.

    Empty if there is no letter.
    """
    if not text:
        return np.zeros(0, dtype=np.int64)
    if not _letters:
        table = np.full(0x110000, 32, dtype=np.int16)
        for start in range(0, 0x110000, 0x1000):
            for c in range(start, start + 0x1000):
                if chr(c).isalpha():
                    table[c] = c if c < 2048 else 2048 + c * 40503 % 65537 % 2048
        _letters.append(table)
    codes = _letters[0][np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"),
                                      dtype=np.uint32)].astype(np.int64)
    blank = codes == 32
    if blank.all():
        return np.zeros(0, dtype=np.int64)
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    codes = codes[keep]
    if codes[0] == 32:
        codes = codes[1:]
    tail = [] if codes[-1] == 32 else [32]
    return np.concatenate([np.full(ORDER - 1, 32), codes, tail]).astype(np.int64)


def grams(codes: np.ndarray) -> np.ndarray:
    """The number of each run of five codes."""
    n = len(codes) - ORDER + 1
    out = np.zeros(max(0, n), dtype=np.int64)
    for j in range(ORDER):
        out = out << BITS | codes[j:j + n]
    return out


def _counted(keys: np.ndarray, counts: np.ndarray | None = None):
    """Distinct keys and their total counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    sums = (np.diff(np.append(at, len(keys))) if counts is None
            else np.add.reduceat(counts, at) if len(at) else counts)
    return keys[at], sums


def count_grams(labelled: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of ``labelled`` (lang, text)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, list] = {}

        def merge(lang):
            held[lang] = [_counted(*map(np.concatenate, zip(*held[lang])))]

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for a, b in chunks(texts):
                found: dict[str, list] = {}
                for lang, text in zip(langs[a:b], texts[a:b]):
                    found.setdefault(lang, []).append(grams(letter_codes(text)))
                for lang, keys in found.items():
                    held.setdefault(lang, []).append(_counted(np.concatenate(keys)))
                    if len(held[lang]) >= 16:
                        merge(lang)
        for lang in held:
            merge(lang)
            keys, counts = held[lang][0]
            for s in range(0, len(keys), 1 << 16):
                k = keys[s:s + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k)), pa.array(k),
                     pa.array(counts[s:s + (1 << 16)].astype(np.int64))],
                    names=["lang", "gram", "n"])

    return (labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class HashTable:
    """Keys sorted by their mixed hash, found through an index of its leading bits."""

    def __init__(self, keys: np.ndarray):
        h = mix64(keys.astype(np.uint64))
        self.order = np.argsort(h)
        self.hashes = np.append(h[self.order], np.uint64(0))
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(self.hashes[:-1] >> self.shift,
                                     np.arange((1 << bits) + 1)).astype(np.int32)
        self.longest = int(np.diff(self.start).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in sorted order; -1 if it is not there."""
        h = mix64(keys.astype(np.uint64))
        at = self.start[h >> self.shift]
        found = self.hashes[at] == h
        place = np.where(found & (at < len(self.order)), at, -1)
        rest = np.flatnonzero(place < 0)
        for step in range(1, self.longest):
            if not len(rest):
                break
            p = np.minimum(at[rest] + step, len(self.hashes) - 1)
            hit = (self.hashes[p] == h[rest]) & (p < len(self.order))
            place[rest[hit]] = p[hit]
            rest = rest[~hit]
        return place


@dataclass
class Model:
    """Language models: tables[k] and logs[k] for order k + 1, weights of contexts."""

    langs: list[str]
    tables: list[HashTable]
    logs: list[np.ndarray]
    contexts: list[HashTable]
    weights: list[np.ndarray]

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        """log2 of P(last character | four before) in each language."""
        return self._order(keys, ORDER)

    def _order(self, keys: np.ndarray, order: int) -> np.ndarray:
        place = self.tables[order - 1].find(keys)
        out = self.logs[order - 1][place]
        miss = np.flatnonzero(place < 0)
        if len(miss):
            if order == 1:
                out[miss] = self.logs[0][-1]
                return out
            rest = keys[miss]
            context = self.contexts[order - 1].find(rest >> BITS)
            lower = self._order(rest & ((1 << BITS * (order - 1)) - 1), order - 1)
            out[miss] = lower + self.weights[order - 1][context]
        return out


def _build(langs: list[str], counts: dict[int, list[tuple]], discounts: np.ndarray) -> Model:
    """``counts[order][lang]``: (keys, counts); ``discounts[order - 1, lang]``."""
    n_langs = len(langs)
    tables, logs, contexts, weights = [], [], [None], [None]
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([k for k, _ in counts[order]]))
        table = HashTable(union)
        union = union[table.order]
        if order > 1:
            base = np.unique(union >> BITS)
            context = HashTable(base)
            base = base[context.order]
            weight = np.zeros((len(base) + 1, n_langs), dtype=np.float32)
            place = context.find(union >> BITS)
        prob = np.zeros((len(union) + 1, n_langs))
        for i, (keys, n) in enumerate(counts[order]):
            d = discounts[order - 1, i]
            at = table.find(keys)
            if order == 1:
                total = max(1, n.sum())
                prob[at, i] = np.maximum(n - d, 0) / total
                prob[:, i] += (d * len(keys) / total if len(keys) else 1.0) / (1 << BITS)
                continue
            sums = np.bincount(place[at], weights=n, minlength=len(base))
            kinds = np.bincount(place[at], minlength=len(base))
            seen = sums > 0
            share = np.ones(len(base))
            share[seen] = d * kinds[seen] / sums[seen]
            weight[:-1, i] = np.log2(share)
            prob[at, i] = np.maximum(n - d, 0) / sums[place[at]]
        if order > 1:
            lower = Model(langs, tables, logs, contexts, weights)._order(
                union & ((1 << BITS * (order - 1)) - 1), order - 1)
            prob[:-1] += np.exp2(lower + weight[place])
            prob[-1] = 1.0  # not used
            contexts.append(context)
            weights.append(weight)
        tables.append(table)
        logs.append(np.log2(np.maximum(prob, 1e-30)).astype(np.float32))
    return Model(langs, tables, logs, contexts, weights)


def fit(labelled: DataFrame) -> Model | None:
    """Models of all languages of ``labelled`` (lang, text); null languages teach nothing.

    All rows are counted, and all distinct grams of each language and order come to the
    driver.
    """
    prepare(labelled.sparkSession)
    full = materialise(count_grams(labelled.where("lang is not null")), "grams")
    orders, now = [full], full
    for order in range(ORDER - 1, 0, -1):
        now = now.groupBy("lang", F.col("gram").bitwiseAND((1 << BITS * order) - 1).alias("gram")
                          ).agg(F.count("*").alias("n"))
        orders.append(now)
    tagged = None
    for order, df in zip(range(ORDER, 0, -1), orders):
        df = df.select(F.lit(order).alias("k"), "lang", "gram", "n")
        tagged = df if tagged is None else tagged.unionByName(df)
    tagged = materialise(tagged, "gram-counts")
    stats = tagged.groupBy("k", "lang").agg(
        F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("n1"),
        F.count_if(F.col("n") == 2).alias("n2"))
    stats = materialise(stats, "gram-stats")
    rows = stats.collect()  # one for each order and language
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    index = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int") - 1
    counts = {}
    for order in range(1, ORDER + 1):
        table = (tagged.where(F.col("k") == order)
                 .select(index.alias("lang"), "gram", "n").toArrow())
        lang, gram, n = (table.column(c).to_numpy() for c in ("lang", "gram", "n"))
        counts[order] = []
        for i in range(len(langs)):
            mine = lang == i
            counts[order].append((gram[mine], n[mine].astype(np.float64)))
    discounts = np.full((ORDER, len(langs)), 0.5)
    for r in rows:
        if r["n1"] and r["n2"]:
            discounts[r["k"] - 1, langs.index(r["lang"])] = r["n1"] / (r["n1"] + 2 * r["n2"])
    return _build(langs, counts, discounts)


def entropies(model: Model, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """(characters, cross-entropy per character in each language, and that of the pieces,
    each in its best language) of whole texts."""
    codes = [grams(letter_codes(t)) for t in texts]
    n = np.array([len(c) for c in codes], dtype=np.int64)
    ends = np.cumsum(n)
    keys = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), n)
    # Pieces are numbered text by text; the rest of a text is part of its last piece.
    counts = np.maximum(n // PIECE, 1)
    first = np.cumsum(counts) - counts
    place = np.arange(len(keys)) - np.repeat(ends - n, n)
    piece = first[owner] + np.minimum(place // PIECE, counts[owner] - 1)
    cost = np.zeros((int(counts.sum()), len(model.langs)))
    for s in range(0, len(keys), 1 << 19):
        part = slice(s, s + (1 << 19))
        logs = model.log_probs(keys[part])
        base = int(piece[s])
        for i in range(len(model.langs)):
            sums = np.bincount(piece[part] - base, weights=logs[:, i])
            cost[base:base + len(sums), i] -= sums
    if not len(texts):
        return n, cost, np.zeros(0)
    size = np.maximum(n, 1)
    return (n, np.add.reduceat(cost, first) / size[:, None],
            np.add.reduceat(cost.min(axis=1), first) / size)


def classify(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
             text_col: str = "text", carry: dict[str, F.Column] | None = None) -> DataFrame:
    """doc_id, digest, lang_pred, score (0 to 1), n_letters, entropy, adjusted (that of the
    pieces, less the allowance for short texts).

    ``carry``: further columns of the result, which predictions do not see.
    """
    carry = carry or {}
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"),
                       F.col(text_col).alias("text"), *(c.alias(k) for k, c in carry.items()))
    shared, names_too = spark.sparkContext.broadcast(model), list(carry)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value
        names = np.array([*(model.langs if model else []), UNKNOWN], dtype=object)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts):
                if model is None:
                    n, h = np.zeros(b - a, dtype=np.int64), np.zeros((b - a, 1))
                    mixed = np.zeros(b - a)
                else:
                    n, h, mixed = entropies(model, texts[a:b])
                best = h.argmin(axis=1)
                low = h[np.arange(b - a), best]
                odds = np.exp2(-(h - low[:, None]) * np.minimum(n, 50)[:, None]).sum(axis=1)
                known = n > 0
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), batch.column("digest").slice(a, b - a),
                    pa.array(names[np.where(known, best, -1)].tolist(), pa.string()),
                    pa.array(np.where(known, 1 / odds, 0.0)), pa.array(n), pa.array(low),
                    pa.array(mixed - SHORT / np.sqrt(np.clip(n, 1, LONG))),
                    *(batch.column(k).slice(a, b - a) for k in names_too)],
                    names=["doc_id", "digest", "lang_pred", "score", "n_letters", "entropy",
                           "adjusted", *names_too])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        run, f"doc_id {kinds['doc_id']}, digest binary, lang_pred string, score double, "
             "n_letters long, entropy double, adjusted double"
             + "".join(f", {k} {kinds[k]}" for k in carry))


def limits(scored: DataFrame) -> DataFrame:
    """lang_pred, limit (the adjusted entropy above which a text is rejected), n (texts).

    ``scored``: rows of ``classify`` with lang, the label where there is one, of texts that
    the model did not see. One row for each language.
    """
    return (scored.where("lang_pred = lang").groupBy("lang_pred")
            .agg((F.percentile_approx("adjusted", PERCENTILE, 10_000) + F.lit(MARGIN))
                 .alias("limit"), F.count("*").alias("n")))


def held_out(doc_id) -> F.Column:
    """Whether a document is kept from learning (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model | None:
    """Fit on the documents with a language that are not held out; null ids do not teach."""
    doc_id = F.col(id_col)
    return fit(docs.where(doc_id.isNotNull() & ~held_out(doc_id))
               .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    answers = classify(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col)
    return answers.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                          "score")


def calibrates(text) -> F.Column:
    """Whether a text is kept from the model to calibrate rejection."""
    return F.crc32(text_digest(text)) % FOLDS == 0


def rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Digests of the texts that no language accepts."""
    kept_out = calibrates(F.col(text_col))
    model = learn(docs.where(~kept_out), id_col, text_col, lang_col)
    teaches = F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
    scored = materialise(classify(docs, model, id_col, text_col, {
        "lang": F.when(teaches & kept_out, F.col(lang_col))}), "languages")
    limit = materialise(limits(scored).withColumnRenamed("lang_pred", "of"), "language-limits")
    highest = limit.agg(F.max("limit").alias("limit")).first()["limit"]
    own = F.when(F.col("n") >= ENOUGH, F.col("limit"))
    return (scored.join(F.broadcast(limit), F.col("lang_pred") == F.col("of"), "left")
            .where((F.col("lang_pred") == UNKNOWN)
                   | (F.col("adjusted") > F.coalesce(own, F.lit(highest).cast("double"))))
            .select(F.col("digest").alias("__digest")).distinct())


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """``docs`` without the texts that no language accepts."""
    bad = materialise(rejected(docs, id_col, text_col, lang_col), "rejected")
    return docs.join(bad, text_digest(docs[text_col]) == bad["__digest"], "left_anti")
