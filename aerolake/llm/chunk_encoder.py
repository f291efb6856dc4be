"""Token ids of whole texts, each distinct word encoded once.

For tokenizers that split at white space before anything else and drop it, the ids of
a text are those of its parts between ASCII white space, one after the other. Parts are
found and hashed (64 bits) over whole batches with numpy; a table of bounded size keeps
the bytes and ids of parts by hash, and only parts it lacks go through the tokenizer: plain
words (Latin-1 letters) all together, cut where tokens end a word, others one by one. The
bytes of every part found are compared; a batch with a part whose hash is another's goes
through the tokenizer text by text.
"""

from __future__ import annotations

import re

import numpy as np

from aerolake.llm.textops import block_hashes, blocks, ragged

#: The longest part that is kept, in bytes.
LONGEST = 1 << 12
#: Slots of the table (two thirds of them are used at most), ids and blocks of eight bytes
#: kept in all.
SLOT_BITS, IDS, BLOCKS = 20, 4_000_000, 2_000_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 13, 32]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[ord("A"):ord("Z") + 1] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord("."), ord(",")]] = True
_WIDE = re.compile("[^\x00-\xff]")


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of a batch that begins and ends with white space.

    A comma or full stop between a letter and white space is a part of its own, as the
    tokenizer splits there in any case.
    """
    space = _SPACE[data]
    mark = np.flatnonzero(_MARK[data])
    mark = mark[_LETTER[data[mark - 1]] & space[mark + 1]]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts = np.sort(np.concatenate([edge[::2], mark]))
    ends = np.sort(np.concatenate([edge[1::2], mark]))
    return starts, ends


class PartTable:
    """Ids and bytes by hash of a part: open addressing in arrays of fixed size."""

    def __init__(self, width: np.dtype):
        self.mask = np.uint64((1 << SLOT_BITS) - 1)
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        self.place = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.start = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.count = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.ids = np.zeros(IDS, dtype=self.width)
        self.first = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.length = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.blocks = np.zeros(BLOCKS, dtype=np.uint64)
        self.parts = self.used = self.held = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of the part with each hash; -1 if it is not here."""
        slot = (h & self.mask).astype(np.int64)
        key = self.keys[slot]
        found = np.where(key == h, self.place[slot], -1)
        rest = np.flatnonzero((key != h) & (key != 0))
        slot = slot[rest]
        while len(rest):
            slot = (slot + 1) & int(self.mask)
            key = self.keys[slot]
            hit = key == h[rest]
            found[rest[hit]] = self.place[slot[hit]]
            on = ~hit & (key != 0)
            rest, slot = rest[on], slot[on]
        return found

    def same(self, number: np.ndarray, lengths: np.ndarray, values: np.ndarray,
             sizes: np.ndarray) -> bool:
        """Whether the parts of these numbers have these lengths and blocks."""
        return (np.array_equal(self.length[number], lengths) and
                np.array_equal(self.blocks[ragged(self.first[number].astype(np.int64), sizes)],
                               values))

    def room(self, parts: int, ids: int, held: int) -> bool:
        return (3 * (self.parts + parts) < 2 << SLOT_BITS and self.used + ids < IDS
                and self.held + held < BLOCKS)

    def add(self, h: np.ndarray, ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray,
            values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Add parts of distinct new hashes; return their numbers."""
        number = np.arange(self.parts, self.parts + len(h), dtype=np.int32)
        self.start[number] = self.used + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.count[number] = counts
        self.ids[self.used:self.used + len(ids)] = ids
        self.first[number] = self.held + np.cumsum(sizes) - sizes
        self.length[number] = lengths
        self.blocks[self.held:self.held + len(values)] = values
        self.held += len(values)
        self.parts, self.used = self.parts + len(h), self.used + len(ids)
        slot, rest = (h & self.mask).astype(np.int64), np.arange(len(h))
        while len(rest):
            free = self.keys[slot] == 0
            _, first = np.unique(slot[free], return_index=True)
            take = np.flatnonzero(free)[first]
            self.keys[slot[take]] = h[rest[take]]
            self.place[slot[take]] = number[rest[take]]
            on = np.ones(len(rest), dtype=bool)
            on[take] = False
            rest, slot = rest[on], (slot[on] + 1) & int(self.mask)
        return number


class ChunkEncoder:
    """Encodes lists of texts to the ids of each, as bytes of the given width.

    ``lower``: the tokenizer lower-cases texts, so Latin-1 texts may be before.
    """

    _plain = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

    def __init__(self, tokenizer, width: str, word_end: str = "</w>", lower: bool = False):
        self.lower = lower
        self.tokenizer, self.width = tokenizer, np.dtype(width)
        self.ends = np.zeros(tokenizer.get_vocab_size() + 1, dtype=bool)
        for token, i in tokenizer.get_vocab().items():
            self.ends[i] = token.endswith(word_end)
        self.table = PartTable(self.width)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype=self.width) for at in range(0, len(texts), 1024)
                for e in self.tokenizer.encode_batch_fast(texts[at:at + 1024],
                                                          add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts one after the other, number of ids of each)."""
        is_plain = [self._plain.fullmatch(p) is not None for p in parts]
        plain = [p for p, ok in zip(parts, is_plain) if ok]
        ids = [np.zeros(0, dtype=self.width)]
        counts = []
        for at in range(0, len(plain), 2048):
            group = plain[at:at + 2048]
            found = self._whole([" ".join(group)])[0]
            cuts = np.flatnonzero(self.ends[found]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(found):
                ids.append(found)
                counts.append(np.diff(cuts, prepend=0))
            else:
                each = self._whole(group)
                ids += each
                counts.append(np.array([len(e) for e in each]))
        other = self._whole([p for p, ok in zip(parts, is_plain) if not ok])
        counts = np.concatenate([*counts, np.array([len(e) for e in other], dtype=np.int64)])
        order = np.argsort(~np.array(is_plain), kind="stable")
        flat = np.concatenate([*ids, *other])
        # back from plain parts first to the order asked for
        sizes = np.zeros(len(parts), dtype=np.int64)
        sizes[order] = counts
        starts = np.zeros(len(parts), dtype=np.int64)
        starts[order] = np.cumsum(counts) - counts
        return flat[ragged(starts, sizes)], sizes

    def _folded(self, text: str) -> str:
        """The text in lower case where the tokenizer would do no more than that to it."""
        if self.lower and "<" not in text and (text.isascii() or not _WIDE.search(text)):
            return text.lower()
        return text

    def encode(self, texts: list[str | None]) -> list[bytes]:
        raw = [self._folded(t or "").encode("utf-8", "surrogatepass") for t in texts]
        joined = b" " + b" ".join(raw) + b" "
        lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
        offsets = np.concatenate([[1], 1 + np.cumsum(lengths)])
        data = np.frombuffer(joined, dtype=np.uint8)
        starts, ends = _spans(data)
        if len(starts) and int((ends - starts).max()) > LONGEST:
            return [e.tobytes() for e in self._whole([t or "" for t in texts])]
        lengths = ends - starts
        values, sizes = blocks(data, starts, ends)
        h = block_hashes(values, sizes, lengths)
        number = self.table.find(h)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct, first, back = np.unique(h[new], return_index=True, return_inverse=True)
            spans = new[first]
            parts = [joined[s:e].decode("utf-8", "surrogatepass")
                     for s, e in zip(starts[spans].tolist(), ends[spans].tolist())]
            ids, counts = self._learn(parts)
            held = values[ragged((np.cumsum(sizes) - sizes)[spans], sizes[spans])]
            if not self.table.room(len(distinct), len(ids), len(held)):
                self.table.clear()
                if not self.table.room(len(distinct), len(ids), len(held)):
                    return [e.tobytes() for e in self._whole([t or "" for t in texts])]
                return self.encode(texts)
            number[new] = self.table.add(distinct, ids, counts, lengths[spans], held,
                                         sizes[spans])[back]
        if not self.table.same(number, lengths, values, sizes):
            return [e.tobytes() for e in self._whole([t or "" for t in texts])]
        counts = self.table.count[number].astype(np.int64)
        data = self.table.ids[ragged(self.table.start[number].astype(np.int64), counts)].tobytes()
        bounds = np.concatenate([[0], np.cumsum(counts)]) * self.width.itemsize
        cuts = bounds[np.searchsorted(starts, offsets)].tolist()
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
