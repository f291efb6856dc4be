"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

1. Each source's documents, in a seeded random order, form a stream of words that is
   cut into blocks of equal size.
2. Slot i of the schedule takes the van der Corput point of i in base 2, on a grid of
   2**m cells. Cumulative slot counts divide the cells among the sources, so each
   source gets exactly its number of slots and any prefix of the schedule is close
   to the target proportions. Cells above the last source are idle and are dropped.
3. The rank of a slot among its source's slots is counted in closed form from the
   binary digits of i (no window over a source's slots); slot number r of a source
   plays block r modulo the number of blocks, so r // blocks is the epoch.
4. Slots join the blocks of the shuffled documents.

Nothing gathers a source in one task: running word positions are taken in random
buckets of about the square root of the rows, plus the totals of the buckets before.

Nulls, ties, empties: a null source is a source of its own, last in order; a null
text has size 0; documents without words take nothing; repeated rows are documents
of their own; an empty table gives an empty mixture. Only the list of sources (one
row each, at most ``MAX_SOURCES``) passes the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare

#: Words of a block, and the fewest blocks of a source (with as many words).
BLOCK_WORDS, MIN_BLOCKS = 1024, 512
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Source:
    """One source's part of the mixture."""

    name: str | None
    docs: int
    size: int
    target: float
    width: int  # words of a block; the last one may be shorter
    blocks: int
    slots: int
    first: int  # cells below those of the source


def capped_targets(sizes: list[int], weights: list[float], share: float,
                   most: float) -> list[float]:
    """Split ``share`` of all words by weight, no source above ``most`` times its size.

    What a capped source leaves is dealt again among the others by weight, until
    none is above its cap.
    """
    total = share * sum(sizes)
    targets = [0.0] * len(sizes)
    open_ = [i for i, n in enumerate(sizes) if n > 0]
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if total * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = total * weights[i] / weight
            break
        for i in over:
            targets[i] = most * sizes[i]
            total -= targets[i]
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def plan_sources(docs: DataFrame, weights: tuple[float, ...], share: float,
                 most: float) -> list[Source]:
    """Targets, blocks and slots of each source. ``docs``: source, size."""
    rows = (docs.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
            .limit(MAX_SOURCES + 1).collect())
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; mix by a coarser column")
    # Python orders strings by code point.
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["w"]) for r in rows]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(rows))],
                             share, most)
    out, first = [], 0
    for r, size, target in zip(rows, sizes, targets):
        width = min(BLOCK_WORDS, max(1, size // MIN_BLOCKS))
        blocks = -(-size // width)
        slots = min(round(target / size * blocks), int(most * blocks)) if size else 0
        out.append(Source(r["source"], r["n"], size, target, width, blocks, slots, first))
        first += slots
    return out


def word_positions(docs: DataFrame, n_rows: int, seed: int) -> DataFrame:
    """Add ``start``: the words before each document in its source's random order."""
    bits = max(0, (n_rows.bit_length() + 1) // 2 - 3)
    docs = (docs.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "digest"))
            .withColumn("bucket", F.shiftrightunsigned("order", 64 - bits) if bits else F.lit(0).cast("long")))
    docs = materialise(docs, "mix-order")
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (docs.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
            .select("s", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")))
    within = (Window.partitionBy("s", "bucket").orderBy("order", "doc_id", "digest")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (docs.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(base, ["s", "bucket"])
            .withColumn("start", F.col("base") + F.col("inner")))


def schedule(docs: DataFrame, sources: list[Source]) -> DataFrame:
    """One row per slot: slot, s (source's place in the list), rank, epoch, block."""
    import numpy as np

    spark = docs.sparkSession
    prepare(spark)
    total = sum(s.slots for s in sources)
    m = max(0, (total - 1).bit_length())
    bounds = np.array([s.first for s in sources] + [total], dtype=np.int64)
    blocks = np.array([max(1, s.blocks) for s in sources], dtype=np.int64)

    def reverse(x, width):
        out = np.zeros_like(x)
        for _ in range(width):
            out = out << 1 | x & 1
            x = x >> 1
        return out

    def below(n, cells):
        """Points among the first n that lie in the first ``cells`` cells."""
        count = np.zeros_like(n)
        for k in range(m + 1):
            start = reverse(n >> (k + 1) << (k + 1), m)
            step = 1 << (m - k)
            inside = np.clip(-(-(cells - start) // step), 0, 1 << k)
            count += np.where(n >> k & 1, inside, 0)
        return count

    def play(batches):
        import pyarrow as pa

        names = ["slot", "s", "rank", "epoch", "block"]
        for batch in batches:
            slot = batch.column(0).to_numpy()
            cell = reverse(slot, m)
            slot, cell = slot[cell < total], cell[cell < total]
            s = np.searchsorted(bounds, cell, side="right") - 1
            rank = below(slot, bounds[s + 1]) - below(slot, bounds[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (slot, s, rank, rank // blocks[s], rank % blocks[s])],
                names=names)

    n = (1 << m) if total else 0
    tasks = max(1, -(-n // 1_000_000))
    return spark.range(0, n, 1, tasks).mapInArrow(
        play, "slot long, s long, rank long, epoch long, block long")


def pieces(placed: DataFrame) -> DataFrame:
    """One row per document and block it lies in, with the words it has there."""
    return (placed.where("size > 0")
            .withColumn("block", F.explode(F.sequence(
                F.expr("start div width"), F.expr("(start + size - 1) div width"))))
            .withColumn("from_word", F.expr("greatest(0L, block * width - start)"))
            .withColumn("words", F.expr("least(start + size, (block + 1) * width)"
                                        " - greatest(start, block * width)")))


def place(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int,
          id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, list[Source]]:
    """Positions of the documents in their sources' streams, and the sources."""
    sized = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
        .cast("long").alias("size")), "mix-sizes")
    sources = plan_sources(sized, weights, share, most)
    stats = docs.sparkSession.createDataFrame(
        [(i, s.name, s.size, s.target, s.width) for i, s in enumerate(sources)],
        "s long, name string, source_size long, target double, width long")
    known = (sized.join(stats, F.col("source").eqNullSafe(F.col("name"))).drop("name"))
    return word_positions(known, sum(s.docs for s in sources), seed), sources


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
        most: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mixture, one row per slot and document in it, in any order.

    Columns: slot (the training order), epoch, source, block, doc_id, digest, size,
    start, source_size, target, from_word and words (the document's words
    ``from_word`` to ``from_word + words`` are taken in this slot). Sources, by code
    point with null last, get ``weights`` in turn. Rows with a null slot are blocks
    or empty documents that the mixture doesn't take.
    """
    placed, sources = place(docs, weights, share, most, seed, id_col, text_col, source_col)
    placed = materialise(placed, "mix-placed")
    slots = schedule(docs, sources)
    parts = pieces(placed)
    taken = parts.join(slots, ["s", "block"], "left")
    cols = ["slot", "epoch", "source", "block", "doc_id", "digest", "size", "start",
            "source_size", "target", "from_word", "words"]
    empty = placed.where("size = 0").select(
        *(F.col(c) if c in placed.columns else F.lit(None).cast("long").alias(c) for c in cols))
    return taken.select(*cols).unionByName(empty)


def words_taken(mixture: DataFrame) -> DataFrame:
    """Per document of ``mix``: doc_id, source, size, source_size, target, taken.

    A document with words is the only one of its source that starts where it does;
    documents without words keep a row each.
    """
    keys = ["source", "start", "doc_id", "size", "source_size", "target"]
    full = (mixture.where("size > 0").groupBy(*keys)
            .agg(F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0))
                 .cast("long").alias("taken")))
    empty = mixture.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return (full.unionByName(empty)
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2),
                  share: float = 1.5, most: float = 2.0, seed: int = 17,
                  id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """The mixed corpus in whole documents, with the columns of ``docs``.

    A document comes as often (0 to ``most`` times) as the block that holds its first
    word is played. Documents without words do not come. Rows that agree in id,
    source and text each come the rounded mean of their counts.
    """
    placed, sources = place(docs, weights, share, most, seed, id_col, text_col, source_col)
    slots = schedule(docs, sources).groupBy("s", "block").agg(F.count("*").alias("times"))
    starts = placed.where("size > 0").withColumn("block", F.expr("start div width"))
    counts = (starts.join(slots, ["s", "block"])
              .groupBy("doc_id", "source", "digest").agg(F.sum("times").alias("__times")))
    rows = placed.groupBy("doc_id", "source", "digest").agg(F.count("*").alias("__rows"))
    key = [F.col("c.doc_id").eqNullSafe(F.col(f"d.`{id_col}`")),
           F.col("c.source").eqNullSafe(F.col(f"d.`{source_col}`")),
           F.col("c.digest") == F.xxhash64(F.coalesce(F.col(f"d.`{text_col}`"), F.lit("")))]
    counts = materialise(
        counts.alias("a").join(rows.alias("b"), [F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")),
                                                 F.col("a.source").eqNullSafe(F.col("b.source")),
                                                 F.col("a.digest") == F.col("b.digest")])
        .select("a.doc_id", "a.source", "a.digest",
                F.round(F.col("__times") / F.col("__rows")).cast("int").alias("copies"))
        .where("copies > 0"), "mix-copies")
    return (docs.alias("d").join(counts.alias("c"), key)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("d.*"))
