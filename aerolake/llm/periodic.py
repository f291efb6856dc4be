"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least ``max(6, 4 * q)`` words that no neighbouring word extends
keeping period q.

Grammar: the words of some documents, one sentinel between two, are compressed in
turn by blocks (a maximal repeat of one symbol becomes one symbol) and by pairs (the
symbols are dealt to two classes; each neighbouring pair of a left and a right one
becomes one symbol), level by level. Equal words get equal symbols wherever they
stand, up to the borders of a match. The nodes of all levels are arrays: symbol, first
child, parent, start and the borders of the repeat a node stands in, which is its run
length.

Extensions: two positions are compared by walking their nodes together. Equal symbols
are passed over, a repeat as a whole, and where both then stand at the first (going
back: the last) child of their parents the walk goes up; unequal ones are opened; it
ends at two unequal words. That is exact whatever the levels are.

Candidates: a run of period q and 4 * q words or more holds four neighbouring points
of the grid of multiples of q, whose words are equal. Only such points, about n ln n of
a text's n words, are looked at for every q up to n / 4; neighbouring points of one
run are extended once. Of equal stretches the smallest period stays.

Everything of a document happens in the task that reads it: nothing is shuffled, and
memory is in proportion to the documents of a batch of ``BATCH_WORDS`` words, or to
one longer document.

Nulls, empties, ties: a null text has no words and no run; a null id is never rotated;
repeated rows are each reported; an empty table gives no rows; of runs of one length
the one that starts first, then the one of smaller period, is reported.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import prepare
from aerolake.llm.textops import mix64

#: Words of the documents handled at once, and grid points looked at at once.
BATCH_WORDS, BATCH_POINTS = 1 << 17, 1 << 20
#: The least words of a run, and the least repeats of its period.
LEAST_WORDS, LEAST_REPEATS = 6, 4
#: A string of so few symbols is not compressed further.
SMALLEST_LEVEL = 32


def _starts(change: np.ndarray) -> np.ndarray:
    """Indexes at which a new group begins, given whether each item differs from the last."""
    return np.concatenate([[0], np.flatnonzero(change) + 1])


class Grammar:
    """Run-length grammar of ``symbols``, whose first and last symbol stand nowhere else."""

    def __init__(self, symbols: np.ndarray):
        level = symbols.astype(np.int64)
        self.words = len(level)
        self._edges = int(level[0]), int(level[-1])
        self._fresh = int(level.max()) + 1
        names, firsts, parents, starts = [level], [np.full(len(level), -1)], [], [np.arange(len(level))]
        base, idle = 0, 0
        for step in range(1, 1 << 10):
            if len(level) <= SMALLEST_LEVEL or idle > 8:
                break
            heads, above = self._blocks(level) if step % 2 else self._pairs(level, step)
            if len(heads) == len(level):
                idle += 1
                continue
            idle = 0
            group = np.zeros(len(level), dtype=np.int64)
            group[heads[1:]] = 1
            parents.append(base + len(level) + np.cumsum(group))
            firsts.append(base + heads)
            starts.append(starts[-1][heads])
            base += len(level)
            level = above
            names.append(level)
        parents.append(np.full(len(level), -1))
        self.name, self.first = np.concatenate(names), np.concatenate(firsts)
        self.parent, self.start = np.concatenate(parents), np.concatenate(starts)
        # the repeats of every level: the first symbol of a level stands nowhere else
        heads = _starts(self.name[1:] != self.name[:-1])
        sizes = np.diff(np.append(heads, len(self.name)))
        self.repeat_start = np.repeat(heads, sizes)
        self.repeat_end = np.repeat(heads + sizes, sizes)

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """A new symbol for each distinct key."""
        distinct, which = np.unique(keys, return_inverse=True)
        names = self._fresh + which
        self._fresh += len(distinct)
        return names

    def _blocks(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        heads = _starts(level[1:] != level[:-1])
        sizes = np.diff(np.append(heads, len(level)))
        above, many = level[heads], sizes > 1
        above[many] = self._named(above[many] * (int(sizes.max()) + 1) + sizes[many])
        return heads, above

    def _pairs(self, level: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        salt = np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        left = (mix64(level.astype(np.uint64) + salt) >> np.uint64(63)).astype(bool)
        if np.count_nonzero(~left[:-1] & left[1:]) > np.count_nonzero(left[:-1] & ~left[1:]):
            left = ~left
        left[0], left[-1] = False, True  # the edges are never part of a pair
        paired = left[:-1] & ~left[1:]
        heads = np.flatnonzero(~np.concatenate([[False], paired]))
        begins = np.append(paired, False)[heads]
        above, at = level[heads], heads[begins]
        above[begins] = self._named(level[at] * self._fresh + level[at + 1])
        return heads, above

    def extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from positions ``a`` and ``b`` (different ones) onwards."""
        return self._walk(a, b, self.repeat_end, 1)

    def extend_back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree before positions ``a`` and ``b``, going back."""
        return self._walk(a - 1, b - 1, self.repeat_start, -1)

    def _child(self, nodes: np.ndarray, sign: int) -> np.ndarray:
        """First child, or going back the last: the one before the next node's first."""
        return self.first[nodes] if sign > 0 else self.first[nodes + 1] - 1

    def _walk(self, a, b, border, sign: int) -> np.ndarray:
        agreed = np.zeros(len(a), dtype=np.int64)
        query, origin, a, b = np.arange(len(a)), a, a.copy(), b.copy()
        while len(query):
            equal = self.name[a] == self.name[b]
            down = ~equal & (a >= self.words)
            over = ~equal & ~down
            agreed[query[over]] = sign * (a[over] - origin[query[over]])
            if equal.any():
                x, y = a[equal], b[equal]
                left = np.minimum(sign * (border[x] - x), sign * (border[y] - y)) + (sign < 0)
                x, y = x + sign * left, y + sign * left
                up, other = self.parent[x], self.parent[y]
                climbs = up >= 0
                climbs[climbs] = ((self._child(up[climbs], sign) == x[climbs])
                                  & (self._child(other[climbs], sign) == y[climbs]))
                a[equal], b[equal] = np.where(climbs, up, x), np.where(climbs, other, y)
            if down.any():
                a[down], b[down] = self._child(a[down], sign), self._child(b[down], sign)
            stays = ~over
            query, a, b = query[stays], a[stays], b[stays]
        return agreed


def _grid(text: np.ndarray, begin: np.ndarray, size: np.ndarray):
    """(position, period) of grid points that start four equal words, in slices.

    Sorted by document, period and position. ``begin`` and ``size`` are of documents.
    """
    periods = size // LEAST_REPEATS
    period = np.arange(int(periods.sum())) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    begin, size = np.repeat(begin, periods), np.repeat(size, periods)
    points = (size - 1) // period + 1 - (LEAST_REPEATS - 1)
    total = np.cumsum(points)
    at = 0
    while at < len(period):
        done = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + BATCH_POINTS)))
        n, q = points[at:to], period[at:to]
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        q = np.repeat(q, n)
        p = np.repeat(begin[at:to], n) + k * q
        for j in range(1, LEAST_REPEATS):
            same = text[p] == text[p + j * q]
            p, q = p[same], q[same]
        if len(p):
            yield p, q
        at = to


def find_runs(documents: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each document, given as word numbers: rows of (start, length, period)."""
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    none = np.empty((0, 3), dtype=np.int64)
    out = [none] * len(documents)
    if not sizes.sum():
        return out
    begin = np.cumsum(sizes) - sizes
    slices = list(_grid(np.concatenate(documents), begin, sizes))
    if not slices:
        return out
    # the grammar is over the documents with candidates, a sentinel around each
    owners = [np.searchsorted(begin + sizes, p, side="right") for p, _ in slices]
    chosen = np.unique(np.concatenate(owners))
    space = max(int(d.max()) for d in documents if len(d)) + 1
    parts = [np.array([space])]
    for i, d in enumerate(chosen):
        parts += [documents[d], np.array([space + 1 + i])]
    grammar = Grammar(np.concatenate(parts))
    moved = np.zeros(len(documents), dtype=np.int64)
    moved[chosen] = np.cumsum(sizes[chosen] + 1) - sizes[chosen] - begin[chosen]
    found = []
    for (p, q), owner in zip(slices, owners):
        p = p + moved[owner]
        while len(p):
            # of neighbouring points the first; those of the same run then go
            chain = np.cumsum(np.concatenate([[True], (q[1:] != q[:-1]) | (np.diff(p) != q[1:])])) - 1
            heads = _starts(chain[1:] != chain[:-1])
            a, period = p[heads], q[heads]
            end = a + period + grammar.extend(a, a + period)
            start = a - grammar.extend_back(a, a + period)
            found.append(np.column_stack([start, end, period, owner[heads]]))
            rest = p >= (end - period)[chain]
            p, q, owner = p[rest], q[rest], owner[rest]
    runs = np.concatenate(found)
    length = runs[:, 1] - runs[:, 0]
    runs = runs[length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if not len(runs):
        return out
    runs = runs[_starts((np.diff(runs[:, 0]) != 0) | (np.diff(runs[:, 1]) != 0))]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0], runs[:, 3]))]
    for group in np.split(runs, _starts(np.diff(runs[:, 3]) != 0)[1:]):
        d = int(group[0, 3])
        out[d] = np.column_stack([group[:, 0] - moved[d] - begin[d], group[:, 1] - group[:, 0], group[:, 2]])
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words stays: no run holds it after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def rotate(words: list[bytes], doc_id) -> list[bytes]:
    """A tenth of the documents, by checksum of the id, repeat a stretch up to their end."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a:a + p]
    return words[:a] + (stretch * -(-(n - a) // p))[:n - a]


def _numbered(documents: list[list[bytes]]) -> list[np.ndarray]:
    """Equal words, equal numbers."""
    seen: dict[bytes, int] = {}
    return [np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
            for words in documents]


REPORT = ("doc_id {id}, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _report(doc_id, words: list[bytes], runs: np.ndarray) -> tuple:
    longest = (None,) * 4
    if len(runs):
        best = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]]
        start, length, period = (int(v) for v in best)
        longest = start, length, period, 1000 * length // period
        kept = kept_words(len(words), runs)
        words = [w for w, keep in zip(words, kept.tolist()) if keep]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(words)).hexdigest())


def report_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rotated: bool = True) -> DataFrame:
    """Per document: number of runs, the longest, and digests of all runs and of the text
    with every repeat of a period left out.

    ``rotated`` first repeats a stretch of some documents (see ``rotate``).
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = REPORT.format(id=rows.schema["doc_id"].dataType.simpleString())

    def reports(ids: list, documents: list[list[bytes]]) -> Iterator[tuple]:
        runs = find_runs(_numbered(documents))
        return (_report(*row) for row in zip(ids, documents, runs))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, documents, size, out = [], [], 0, []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = (text.as_py() or b"").split()  # at spaces and \t to \r
                ids.append(doc_id)
                documents.append(rotate(words, doc_id) if rotated else words)
                size += len(words)
                if size >= BATCH_WORDS:
                    out += reports(ids, documents)
                    ids, documents, size = [], [], 0
            out += reports(ids, documents)
            types = [batch.schema.field("doc_id").type, *[pa.int64()] * 5, *[pa.string()] * 2]
            names = [f.split()[0] for f in schema.split(", ")]
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return rows.mapInArrow(run, schema)
