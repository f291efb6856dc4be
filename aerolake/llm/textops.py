"""Vectorised word hashing for whole texts, in pieces of bounded size.

A word is a maximal run of ASCII letters and digits and of bytes above 127 of the
lower-cased text in UTF-8; everything else separates words. Hashes are 64 bits.
"""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once; a longer text is cut between words.
PIECE = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[128:] = True
for _range in (b"az", b"AZ", b"09"):
    _IS_WORD[_range[0]:_range[1] + 1] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of runs: starts[i], starts[i] + 1, ... of counts[i] each."""
    total = np.cumsum(counts)
    n = int(total[-1]) if len(total) else 0
    return np.repeat(starts - total + counts, counts) + np.arange(n)


def blocks(data: np.ndarray, starts: np.ndarray,
           ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, counts): the bytes of each part, eight to a number, zeros after its end."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    counts = (ends - starts + 7) >> 3
    first = np.cumsum(counts) - counts
    at = np.repeat(starts, counts) + (ragged(np.zeros_like(first), counts) << 3)
    left = np.minimum(8, np.repeat(ends, counts) - at).astype(np.uint64)
    return eight[at] & (~np.uint64(0) >> (np.uint64(64) - (left << np.uint64(3)))), counts


def block_hashes(values: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each part from its blocks: each is mixed with its place in the part before
    they are added, so that no difference of one block undoes that of another."""
    place = ragged(np.zeros(len(counts), dtype=np.int64), counts).astype(np.uint64)
    mixed = mix64(mix64(values + _STEP) + (place + np.uint64(1)) * _STEP)
    total = np.zeros(len(counts), dtype=np.uint64)
    some = counts > 0
    if some.any():
        total[some] = np.add.reduceat(mixed, (np.cumsum(counts) - counts)[some])
    return mix64(total ^ (lengths.astype(np.uint64) << np.uint64(32)))


def _hash_piece(data: np.ndarray, prefixes: tuple[int, ...] = ()):
    """(start byte, hash) of each word of a piece, and of each prefix of a longer word."""
    word = _IS_WORD[data]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    at, h = [starts], [block_hashes(*blocks(data, starts, ends), ends - starts)]
    for k in prefixes:
        longer = starts[ends - starts > k]
        at.append(longer)
        # Not the hash of a word of k bytes.
        h.append(mix64(block_hashes(*blocks(data, longer, longer + k),
                                    np.full(len(longer), k)) + _STEP))
    return np.concatenate(at), np.concatenate(h)


def _pieces(data: bytes):
    """Cut between words into pieces of about PIECE bytes."""
    at = 0
    while len(data) - at > PIECE:
        cut = at + PIECE
        while cut < len(data) and _IS_WORD[data[cut]]:
            cut += 1
        yield at, data[at:cut]
        at = cut
    yield at, data[at:]


def _hashed(texts: list[str | None], prefixes: tuple[int, ...] = ()):
    """(start byte, hash) over all texts, and where each text starts."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    starts, hashes = [], []
    for at, piece in _pieces(b"\n".join(raw)):
        s, h = _hash_piece(np.frombuffer(piece, dtype=np.uint8), prefixes)
        starts.append(s + at)
        hashes.append(h)
    return np.concatenate(starts), np.concatenate(hashes), offsets


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All words of the texts: (hashes, bounds); text i has hashes[bounds[i]:bounds[i + 1]]."""
    start, hashes, offsets = _hashed(texts)
    return hashes, np.searchsorted(start, offsets, side="left")


def word_features(
    texts: list[str | None], prefixes: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of their first ``prefixes`` bytes, and the text of each."""
    start, hashes, offsets = _hashed(texts, prefixes)
    return hashes, np.searchsorted(offsets, start, side="right") - 1


def chunks(texts: list[str | None], limit: int = 1 << 18):
    """(from, to) ranges of the list, each of about ``limit`` characters or one text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "") + 64
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def shingle_hashes(
    words: np.ndarray, bounds: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and the text each belongs to.

    A text of fewer than ``k`` words, but at least one, has one shingle of all its
    words; a text without words has none.
    """
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    n = len(words)
    full = np.zeros(n, dtype=np.uint64)
    prime = np.uint64(0x100000001B3)
    m = max(0, n - k + 1)
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        acc *= prime
        acc += words[j:j + m]
    full[:m] = mix64(acc)
    ok = np.arange(n) + k <= bounds[1:][owner]
    short = np.flatnonzero((counts > 0) & (counts < k))
    with np.errstate(over="ignore"):
        for i in short:
            h = np.uint64(counts[i])
            for w in words[bounds[i]:bounds[i + 1]]:
                h = h * prime + w
            full[bounds[i]] = h
            ok[bounds[i]] = True
    return full[ok], owner[ok]
