"""Near-duplicate classes by BagMinHash signatures of word shingles.

A text is the bag of its runs of five words (one shorter run, if it has fewer).
BagMinHash gives each pair (shingle, weight interval) a Poisson process whose points
carry a time, a signature component and a weight level; the intervals (0, 1], (1, 2],
(2, 4], (4, 8], ... discretise the weights hierarchically, so a shingle of weight w
needs about log2(w) processes, of which points above level w are thinned out. A
component's value is its earliest point; two bags agree in a component with the
probability of their weighted Jaccard similarity. Points come in time order and stop
at a bound after which no component is left open, so a text costs about one hash a
shingle and m * log(m) points.

Banding and verification:

1. Equal texts collapse to one node (their digest); copies never meet each other.
2. Each band bucket has a hub: its node with the most company in all of its buckets,
   such as the text that many others were made from. All others are compared with the
   hub only; pairs of similarity 0.8 or more are links, and links give components.
3. A bucket with several components may hide a link between two nodes that were not
   compared. What is known bounds their similarity: shingles they share lie in the hub
   too (at most the smaller overlap with it) or not (at most the smaller number of
   shingles that are neither in the hub nor in a single text only); the same holds for
   any hub that both were compared with. Nodes that no
   node of their bucket can reach by this bound are left out, without listing pairs;
   of the others, pairs of different components that the bound admits are compared,
   about 256 nodes of a bucket with all others at first, then 4,096, ..., until all
   have been.

So each pair of a bucket is in one component, or compared, or cannot be similar, and
the pairs of a group of similar texts are never listed.

Nulls, empties, ties, repeats: a null text is the empty text; equal texts are always
one class, also texts without words; a class is named by its least doc_id (null if
all are); repeated rows are members like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import BROADCAST_KEYS, materialise, prepare, small, text_digest, texts_of
from aerolake.llm.components import connected_components
from aerolake.llm.textops import chunks, mix64, shingle_hashes, word_hashes

SHINGLE_WORDS = 5
#: Similarity of 0.8 as a fraction, compared in integers.
SIMILARITY = (4, 5)
#: A pair of similarity 0.8 shares no band of 4 rows in 20 with probability 3e-5.
BANDS, ROWS = 20, 4
#: Hubs a bucket in the first extra round, and the factor to the next.
HUBS, MORE_HUBS = 256, 16
#: What is kept of a node in a bucket whose nodes lie in several components.
OPEN = ("digest", "n", "common", "rest", "anchor", "near", "far")


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hash, weight, text number), sorted in each text."""
    words, bounds = word_hashes(texts)
    shingles, owner = shingle_hashes(words, bounds, SHINGLE_WORDS)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(ends[:-1], ends[1:]):
        shingles[a:b].sort()
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return shingles[at], np.diff(np.append(at, len(shingles))), owner[at]


def _earliest_points(x, weight, owner, n_texts: int, m: int) -> np.ndarray:
    """Signatures (n_texts, m): the identity of each component's earliest point."""
    total = np.bincount(owner, weights=weight, minlength=n_texts)
    values = np.zeros((n_texts, m), dtype=np.uint64)
    # Processes: the interval (0, 1] of each element, then higher ones of heavier elements.
    state, low, high, w, own = [mix64(x)], [np.zeros(len(x))], [np.ones(len(x))], [weight], [owner]
    level, j = 1, 1
    heavy = weight > level
    while heavy.any():
        k = np.flatnonzero(heavy)
        state.append(mix64(x[k] + np.uint64(j * 0xD1B54A32D192ED03 % 2 ** 64)))
        low.append(np.full(len(k), float(level)))
        high.append(np.full(len(k), 2.0 * level))
        w.append(weight[k])
        own.append(owner[k])
        level, j = 2 * level, j + 1
        heavy = weight > level
    state, low, high, w, own = map(np.concatenate, (state, low, high, w, own))
    open_ = np.flatnonzero(total > 0)
    slack = 2.0
    while len(open_):
        bound = np.zeros(n_texts)
        bound[open_] = (np.log(m) + slack) / total[open_]
        flat, time, ident = _points(state, low, high, w, own, bound, m)
        first = np.full(n_texts * m, np.inf)
        np.minimum.at(first, flat, time)
        win = time == first[flat]
        values.reshape(-1)[flat[win]] = ident[win]
        filled = np.isfinite(first.reshape(n_texts, m)).all(axis=1)
        open_ = open_[~filled[open_]]
        slack = 2 * slack + np.log(m)
    return values


def _points(state, low, high, w, own, bound, m):
    """All points before each text's time bound: (text * m + component, time, identity).

    A point's 64 hash bits give its waiting time (upper 44) and component (lower 20).
    """
    step, scale = 0x9E3779B97F4A7C15, 2.0 ** 44
    rate = m * (high - low)
    limit = bound[own]
    u = mix64(state + np.uint64(step))
    # The first arrival is before the bound where u is below its distribution function.
    live = np.flatnonzero((u >> np.uint64(20)) < -np.expm1(-limit * rate) * scale)
    u, time = u[live], np.zeros(len(live))
    state, rate, limit, own = state[live], rate[live], limit[live], own[live] * m
    low, span, w = low[live], (high - low)[live], w[live]
    wide = bool((span > 1).any())
    out, k = [], 1
    while len(u):
        time = time - np.log1p((u >> np.uint64(20)) * (-1 / scale)) / rate
        keep = time < limit
        if not keep.all():
            u, time, state, rate, limit, own = (
                x[keep] for x in (u, time, state, rate, limit, own))
            if wide:
                low, span, w = low[keep], span[keep], w[keep]
        flat = own + (((u & np.uint64(0xFFFFF)) * np.uint64(m)) >> np.uint64(20)).astype(np.int64)
        if wide:  # points above an element's weight are thinned out
            level = low + 1 + mix64(u) % span.astype(np.uint64)
            real = level <= w
            out.append((flat[real], time[real], u[real]))
        else:
            out.append((flat, time, u))
        k += 1
        u = mix64(state + np.uint64(k * step % 2 ** 64))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def signatures(texts: list[str | None], m: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of shingles, BagMinHash signature) of each text; zeros without words."""
    x, weight, owner = bags(texts)
    n = np.bincount(owner, weights=weight, minlength=len(texts)).astype(np.int64)
    return n, _earliest_points(x, weight, owner, len(texts), m)


def weighted_overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Size of the intersection of two bags (sorted hashes, weights)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if not len(a[0]):
        return 0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    return int(np.minimum(a[1][same], b[1][at[same]]).sum())


def sign(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest, n (shingles), bands (hashes; null without words). ``docs``: doc_id,
    digest, text."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts, 1 << 20):
                n, sig = signatures(texts[a:b], bands * rows)
                h = np.repeat(salt[None, :], b - a, axis=0)
                for r in range(rows):
                    h = mix64(h * np.uint64(31) ^ sig.reshape(-1, bands, rows)[:, :, r])
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a),
                    batch.column("digest").slice(a, b - a),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(ends),
                                             pa.array(h[n > 0].reshape(-1).view(np.int64)))],
                    names=["doc_id", "digest", "n", "bands"])

    return docs.select("doc_id", "digest", "text").mapInArrow(
        run, "doc_id long, digest binary, n long, bands array<long>")


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Common weight of the bags of the pairs (a, b) of digests: a, b, n_a, n_b, common.

    The rows come sorted by b; the bag of a repeated b is built once.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, hub = None, None
        for batch in batches:
            right, tb = batch.column("b").to_pylist(), batch.column("tb")
            ta, out = batch.column("ta").to_pylist(), []
            for s, e in chunks(ta):
                x, w, owner = bags(ta[s:e])
                ends = np.searchsorted(owner, np.arange(e - s + 1))
                for i in range(s, e):
                    if right[i] != last:
                        last, hub = right[i], bags([tb[i].as_py()])[:2]
                    lo, hi = ends[i - s], ends[i - s + 1]
                    out.append((int(w[lo:hi].sum()), int(hub[1].sum()),
                                weighted_overlap((x[lo:hi], w[lo:hi]), hub)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"),
                 *(pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3))],
                names=["a", "b", "n_a", "n_b", "common"])

    pairs = small(materialise(pairs.select("a", "b"), "to-compare"))
    rows = (texts.select(F.col("digest").alias("a"), F.col("text").alias("ta"))
            .join(pairs, "a")
            .join(texts.select(F.col("digest").alias("b"), F.col("text").alias("tb")).hint("merge"),
                  "b").select("a", "b", "ta", "tb"))
    return rows.mapInArrow(run, "a binary, b binary, n_a long, n_b long, common long")


def similar(common: str, n: str, m: str) -> F.Column:
    """Whether bags of sizes ``n`` and ``m`` with this common weight reach the similarity."""
    p, q = SIMILARITY
    return F.expr(f"({common}) > 0 and ({common}) * {q} >= (({n}) + ({m}) - ({common})) * {p}")


def single_counts(nodes: DataFrame, texts: DataFrame, few: bool = False) -> DataFrame:
    """digest, single: how much of each node's bag occurs in no other node of ``nodes``.

    Shingles are counted as (hash, least node number, texts, weight), with partial
    aggregation; a node's number is the first eight bytes of its digest.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            numbers = batch.column("number").to_numpy()
            ts = batch.column("text").to_pylist()
            for a, b in chunks(ts, 1 << 20):
                x, w, owner = bags(ts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)), pa.array(numbers[a:b][owner]),
                     pa.array(w.astype(np.int32))], names=["shingle", "number", "weight"])

    number = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long").alias("number")
    keys = materialise(nodes.select("digest").distinct().select("digest", number), "open-digests", few)
    own = texts.join(small(keys), "digest")
    single = (own.select("number", "text")
              .mapInArrow(run, "shingle long, number long, weight int")
              .groupBy("shingle").agg(F.count("*").alias("texts"), F.min("number").alias("number"),
                                      F.sum("weight").alias("weight"))
              .where("texts = 1").groupBy("number").agg(F.sum("weight").alias("single")))
    return keys.join(small(materialise(single, "single-counts", few)), "number", "left").select("digest", F.coalesce("single", F.lit(0)).alias("single"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, class_digest, class_id, class_size."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_digest(F.col(text_col)).alias("digest"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = materialise(sign(rows), "bag-signatures")
    nodes = (signed.where("n > 0").groupBy("digest")
             .agg(F.first("n").alias("n"), F.first("bands").alias("bands")))
    banded = materialise(nodes.select("digest", "n", F.explode("bands").alias("band")), "bands")
    buckets = materialise(banded.groupBy("band").agg(F.count("*").alias("size"))
                          .where("size > 1"), "buckets")
    found = materialise(banded.join(small(buckets), "band"), "bucket-nodes")
    company = materialise(
        found.groupBy("digest").agg(F.sum("size").alias("company")), "company")
    # of at most that many texts in buckets, what is kept of each bucket is a few rows
    few = company.count() <= BROADCAST_KEYS
    hubs = materialise(found.join(small(company), "digest").groupBy("band").agg(
        F.max(F.struct("company", "digest")).alias("hub")).select("band", "hub.digest")
        .withColumnRenamed("digest", "hub"), "hubs", few)
    members = materialise(found.join(small(hubs), "band"), "bucket-members", few)
    texts = materialise(texts_of(rows, company.select("digest"), "digest"), "bucket-texts")

    spokes = members.where("digest != hub").select(
        F.col("digest").alias("a"), F.col("hub").alias("b")).distinct()
    tested = materialise(compare(spokes, texts), "spokes")
    links = tested.where(similar("common", "n_a", "n_b")).select("a", "b")
    labels = connected_components(links)
    labelled = _label(members.join(
        small(tested.select(F.col("a").alias("digest"), F.col("b").alias("hub"), "common")),
        ["digest", "hub"], "left").withColumn("common", F.coalesce("common", "n")), labels)
    open_ = materialise(_mixed(labelled, few), "open-buckets", few)
    # What is in no other text, counted among all nodes of open buckets.
    # A node's anchor is the hub, of all its buckets, that it has most in common with.
    anchors = materialise(tested.groupBy(F.col("a").alias("digest")).agg(
        F.max(F.struct("common", "b")).alias("anchor")), "anchors", few)
    open_ = materialise(
        open_.join(small(materialise(single_counts(open_, texts, few), "single", few)), "digest")
        .join(small(anchors), "digest", "left")
        .withColumn("rest", F.greatest(F.expr("n - common - single"), F.lit(0)))
        .withColumn("near", F.coalesce("anchor.common", "n"))
        .withColumn("far", F.greatest(F.expr("n - near - single"), F.lit(0)))
        .withColumn("anchor", F.coalesce("anchor.b", "digest")), "open-nodes", few)
    reach = materialise(open_.groupBy("band").agg(F.min("n").alias("least"),
                                                  F.max("rest").alias("most")), "reach", few)
    open_ = (open_.join(small(reach), "band").withColumn("bound", F.expr("common + least(rest, most)"))
             .where(similar("bound", "n", "greatest(least, bound)"))
             .select("band", "label", *OPEN))
    done = 0
    seen = tested.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
    while True:
        open_ = materialise(_mixed(open_, few), "open-nodes", few)
        sizes = materialise(open_.groupBy("band").agg(F.count("*").alias("size"))
                            .where(F.col("size") > done), "open-sizes", few)
        if not sizes.limit(1).count():
            break
        now = HUBS if not done else done * MORE_HUBS
        # a pair is taken in the least of the buckets that both are in
        sets = materialise(open_.groupBy("digest").agg(F.collect_set("band").alias("bands")),
                           "band-sets", few)
        sized = open_.join(small(sizes), "band").join(small(sets), "digest")
        place = F.expr("pmod(xxhash64(band, digest), 1073741824) / 1073741824.0 * size")
        some = sized.where((place >= done) & (place < now)).select(
            "band", *(F.col(c).alias("_" + c) for c in ("label", "bands", *OPEN)))
        bound, other = ("least(common, _common) + least(rest, _rest)",
                        "least(near, _near) + least(far, _far)")
        pairs = (sized.join(some, "band").where("label != _label")
                 .where(similar(bound, "n", "_n"))
                 .where((F.col("anchor") != F.col("_anchor")) | similar(other, "n", "_n"))
                 .where(F.col("band") == F.array_min(F.array_intersect("bands", "_bands")))
                 .select(F.least("digest", "_digest").alias("b"),
                         F.greatest("digest", "_digest").alias("a")).distinct())
        pairs = materialise(compare(pairs.join(seen, ["a", "b"], "left_anti"), texts), "pairs")
        seen = seen.unionByName(pairs.select("a", "b"))
        more = pairs.where(similar("common", "n_a", "n_b")).select("a", "b")
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = connected_components(links)
            open_ = _label(open_.drop("label"), labels)
        done = now

    classed = (signed.select("doc_id", "digest")
               .join(small(labels.withColumnRenamed("node", "digest")), "digest", "left")
               .select("doc_id", "digest", F.coalesce("label", "digest").alias("class_digest")))
    classed = materialise(classed, "classes")
    names = materialise(classed.groupBy("class_digest").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "class-names")
    return classed.join(names, "class_digest").select(
        "doc_id", "digest", "class_digest", "class_id", "class_size")


def _label(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the component's label; a node without links is a component of its own."""
    return (nodes.join(small(labels.withColumnRenamed("node", "digest")), "digest", "left")
            .withColumn("label", F.coalesce("label", "digest")))


def _mixed(nodes: DataFrame, few: bool) -> DataFrame:
    """The rows of buckets whose nodes lie in several components."""
    nodes = materialise(nodes, "bucket-labels", few)
    mixed = materialise(
        nodes.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high").select("band"), "mixed-buckets", few)
    return nodes.join(small(mixed), "band")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one of the least (doc_id, digest).

    Of repeated rows (equal id and text) one stays.
    """
    # Both are read again: a large class is then combined before its exchange, and the
    # join deals its rows by all three keys.
    classes = materialise(near_duplicates(docs, id_col, text_col), "named-classes")
    best = materialise(
        classes.groupBy("class_digest")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest"))
             .alias("k")), "class-firsts")
    kept = classes.select("class_digest", "doc_id", "digest").alias("c")
    keep = materialise(
        best.select("k.doc_id", "k.digest", "class_digest").alias("k")
        .join(kept, (F.col("k.class_digest") == F.col("c.class_digest"))
              & F.col("k.doc_id").eqNullSafe(F.col("c.doc_id"))
              & (F.col("k.digest") == F.col("c.digest")))
        .groupBy(F.col("k.doc_id").alias("__id"), F.col("k.digest").alias("__digest"))
        .agg(F.count("*").alias("__rows")), "kept")
    digest = text_digest(F.col(f"d.`{text_col}`"))

    def take(some: DataFrame) -> DataFrame:
        return docs.alias("d").join(
            some.alias("k"), F.col(f"d.`{id_col}`").cast("long").eqNullSafe(F.col("k.__id"))
            & (digest == F.col("k.__digest")))

    once = take(keep.where("__rows = 1")).select("d.*")
    again = keep.where("__rows > 1")
    if not again.limit(1).count():
        return once
    repeated = (take(again).groupBy("k.__id", "k.__digest")
                .agg(F.first(F.struct("d.*")).alias("d")).select("d.*"))
    return once.unionByName(repeated)
