"""Nearest neighbours by multi-index hashing of learned binary codes.

Fit (on a bounded sample): vectors are reduced to their directions in one more
dimension that makes the largest inner product the smallest angle, and rotated so that
the signs of the coordinates lose least (iterative quantisation). The signs are a
64-bit code, cut into four substrings of 16 bits.

Index: every vector, once for each substring. A cell is a substring index and the
leading bits of that substring, as many as leave about CELL_ROWS codes in a cell;
cells with more are split. Two codes that differ in at most r bits differ in at most
r // 4 bits in some substring (in fewer in most), so a query probes, in each of the
four indexes, the cells whose leading bits are within that distance, and in a cell
the codes whose substring is. That finds every code within the radius exactly once:
a code that several substrings find is taken by the first of them. Codes found are
reranked by the inner product of the original vectors in double precision.

The radius is calibrated, not assumed: on sampled queries, against brute force over
all vectors in blocks, the least radius that holds the wanted share of true
neighbours. Queries with fewer than k codes within it are answered by the exact way:
they probe all cells without a radius.

Equal vectors are one entry with its least k + 1 ids (which is all that any answer can
use), so copies neither crowd a cell nor an answer. Nulls, empties, ties: vectors that
are null, zero, or hold null or non-finite components, or whose length differs from
the most frequent one, take no part; ties go to the smaller id; a repeated id counts
once for each distinct vector; with fewer than k candidates all are returned; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare

BITS, PARTS = 64, 4
WIDTH = BITS // PARTS
#: Vectors to fit the rotation on, and its rounds.
SAMPLE, ROUNDS = 20_000, 40
#: Queries to calibrate the radius on, and the share of true neighbours it must hold.
CALIBRATION, RECALL = 200, 0.96
#: Codes in a cell, and queries that are compared with it at once.
CELL_ROWS, QUERY_ROWS = 4096, 32_768


@dataclass
class Coder:
    """Learned projection of vectors of one length to 64-bit codes."""

    norm: float  # the greatest norm of an indexed vector
    mean: np.ndarray
    rotation: np.ndarray  # (dimensions + 1, BITS)

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        square = np.einsum("ij,ij->i", vectors, vectors)
        if query:
            flat = vectors / np.sqrt(square)[:, None]
            rest = np.zeros(len(vectors))
        else:
            flat = vectors / self.norm
            rest = np.sqrt(np.maximum(0.0, 1.0 - square / self.norm ** 2))
        signs = (np.column_stack([flat, rest]) - self.mean) @ self.rotation > 0
        return np.packbits(signs, axis=1).view(">u8")[:, 0].astype(np.uint64)


def fit(sample: np.ndarray, norm: float, seed: int = 5) -> Coder:
    """Principal directions of the sample, rotated to lose least by taking signs."""
    rng = np.random.default_rng(seed)
    square = np.einsum("ij,ij->i", sample, sample)
    full = np.column_stack([sample / norm, np.sqrt(np.maximum(0.0, 1.0 - square / norm ** 2))])
    mean = full.mean(axis=0)
    centred = full - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    rotations, bits = [], 0
    while bits < BITS:
        take = min(BITS - bits, len(axes))
        reduced = centred @ axes[:take].T
        rotation = np.linalg.qr(rng.normal(size=(take, take)))[0]
        for _ in range(ROUNDS):
            u, _, vt = np.linalg.svd(np.sign(reduced @ rotation).T @ reduced)
            rotation = (u @ vt).T
        rotations.append(axes[:take].T @ rotation)
        bits += take
    return Coder(norm, mean, np.column_stack(rotations))


def part_radii(radius: int) -> list[int]:
    """Bits in which each substring may differ, so that no code within the radius is lost."""
    whole, extra = divmod(radius, PARTS)
    return [whole if t <= extra else whole - 1 for t in range(PARTS)]


def _usable(v):
    """Whether a vector is there, finite throughout and not zero."""
    return (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & _usable(F.col("v")))
    usual = (rows.groupBy(F.size("v").alias("d")).count()
             .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    return rows.where(F.size("v") == (usual[0]["d"] if usual else 0))


def _matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix of doubles."""
    flat = column.flatten() if hasattr(column, "flatten") else column
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """One row for each distinct vector: key, v, ids (its least k + 1, ascending).

    The limit is taken map-side before the exchange, so copies do not meet in one task.
    """
    keyed = (rows.withColumn("key", F.xxhash64("v")).withColumn("key2", F.hash("v"))
             .dropDuplicates(["vec_id", "key", "key2"]))
    first = Window.partitionBy("key", "key2").orderBy("vec_id")
    return (keyed.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
            .groupBy("key", "key2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"),
                                        F.first("v").alias("v"))
            .select("key", "v", "ids"))


def _top(scores: np.ndarray, queries: np.ndarray, vectors: np.ndarray, n: int):
    """Places and exact scores of the n best columns of each row (-inf: not a candidate)."""
    n = min(n, scores.shape[1])
    place = np.argpartition(-scores, n - 1, axis=1)[:, :n]
    found = np.isfinite(np.take_along_axis(scores, place, axis=1))
    exact = (queries[:, None, :] * vectors[place]).sum(axis=2)
    return place, np.where(found, exact, -np.inf)


def _with_codes(entries: DataFrame, coder) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            code = coder.value.codes(_matrix(batch.column("v"))) if batch.num_rows else np.zeros(
                0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.view(np.int64))],
                                             names=[*batch.schema.names, "code"])

    return entries.mapInArrow(run, "key long, v array<double>, ids array<long>, code long")


def calibrate(entries: DataFrame, sample: np.ndarray, coder: Coder, k: int,
              recall: float = RECALL) -> int:
    """Least radius within which the share ``recall`` of true neighbours lies.

    The sampled queries meet all entries in blocks (a bounded query set).
    """
    spark = entries.sparkSession
    queries = spark.sparkContext.broadcast((sample, coder.codes(sample, query=True)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        q, qc = queries.value
        best: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            v, code = _matrix(batch.column("v")), batch.column("code").to_numpy().view(np.uint64)
            scores = q @ v.T
            n = min(k + 1, len(v))
            place = np.argpartition(-scores, n - 1, axis=1)[:, :n]
            best.append((np.take_along_axis(scores, place, axis=1),
                         np.bitwise_count(qc[:, None] ^ code[place])))
            if len(best) >= 16:
                best = [_merge(best, k + 1)]
        if best:
            s, h = _merge(best, k + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(s)), s.shape[1])), pa.array(s.ravel()),
                 pa.array(h.ravel().astype(np.int32))], names=["q", "score", "bits"])

    found = entries.select("v", "code").mapInArrow(run, "q long, score double, bits int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    # The first is as a rule the query itself.
    bits = (found.withColumn("rank", rank).where((F.col("rank") > 1) & (F.col("rank") <= k + 1))
            .groupBy("bits").count().collect())
    total, at = sum(r["count"] for r in bits), 0
    for r in sorted(bits, key=lambda r: r["bits"]):
        at += r["count"]
        if at >= recall * total:
            return r["bits"]
    return BITS


def _merge(best: list, n: int):
    s, h = (np.concatenate(c, axis=1) for c in zip(*best))
    place = np.argsort(-s, axis=1, kind="stable")[:, :n]
    return np.take_along_axis(s, place, axis=1), np.take_along_axis(h, place, axis=1)


def _cells(column: str, t: int, bits: int) -> str:
    """SQL for the leading ``bits`` of substring t of a code."""
    return f"(shiftrightunsigned({column}, {BITS - WIDTH * t - bits}) & {(1 << bits) - 1})"


def search(index: DataFrame, queries: DataFrame, radius: int, k: int, n_entries: int,
           n_queries: int) -> DataFrame:
    """query_id and found, the k nearest (score, vec_id) within the radius, nearest first.

    ``index``: key, v, ids, code. ``queries``: query_id, v, code.
    """
    bits = min(WIDTH, max(0, (n_entries // CELL_ROWS).bit_length()))
    radii = part_radii(radius)
    blocks = -(-n_queries // QUERY_ROWS)
    part = F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.expr(_cells("code", t, bits)).alias("cell"))
                               for t in range(PARTS))))
    placed = index.withColumn("p", part).select("key", "v", "ids", "code", "p.t", "p.cell")
    sizes = materialise(placed.groupBy("t", "cell").agg(
        F.ceil(F.count("*") / (2 * CELL_ROWS)).alias("splits")), "cells")
    placed = (placed.join(sizes, ["t", "cell"])
              .withColumn("split", F.expr("pmod(key, splits)"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    # Cells within reach of a query: distances of leading bits, never of pairs of codes.
    reach = [[c for c in range(1 << bits) if c.bit_count() <= rho] for rho in radii]
    probes = (queries.withColumn("p", F.explode(F.array(*(
        F.struct(F.lit(t).alias("t"), F.expr(_cells("code", t, bits)).alias("own"))
        for t in range(PARTS)))))
        .select("query_id", "v", "code", "p.t", "p.own")
        .withColumn("mask", F.explode(F.element_at(F.array(*(
            F.array(*map(F.lit, cells)).cast("array<long>") for cells in reach)), F.col("t") + 1)))
        .withColumn("cell", F.expr("own ^ mask"))
        .join(sizes, ["t", "cell"])
        .withColumn("split", F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)))
        .withColumn("block", F.expr(f"cast(pmod(xxhash64(query_id), {blocks}) as int)"))
        .select("t", "cell", "split", "block", "query_id", "v", "code"))

    def rerank(left, right):
        import pyarrow as pa

        out_ids, out_found = [], []
        if left.num_rows and right.num_rows:
            t = left.column("t")[0].as_py()
            vectors, code = _matrix(left.column("v").combine_chunks()), left.column(
                "code").to_numpy().view(np.uint64)
            ids = left.column("ids").combine_chunks()
            counts = np.diff(ids.offsets.to_numpy())
            first = ids.values.to_numpy()[ids.offsets.to_numpy()[:-1]]
            qid = right.column("query_id").to_numpy()
            qv = _matrix(right.column("v").combine_chunks())
            qc = right.column("code").to_numpy().view(np.uint64)
            step = max(1, (1 << 20) // len(code))
            for a in range(0, len(qid), step):
                x = qc[a:a + step, None] ^ code[None, :]
                hit = np.bitwise_count(x) <= radius
                for s in range(t + 1):
                    near = np.bitwise_count(
                        x >> np.uint64(BITS - WIDTH * (s + 1)) & np.uint64((1 << WIDTH) - 1)) <= radii[s]
                    hit &= near if s == t else ~near
                some = np.flatnonzero(hit.any(axis=1))
                if not len(some):
                    continue
                q = qv[a:a + step][some]
                scores = np.where(hit[some], q @ vectors.T, -np.inf)
                place, exact = _top(scores, q, vectors, k + 9)
                for i, query in enumerate(qid[a:a + step][some]):
                    row = [(e, v) for p, e in zip(place[i], exact[i]) if e > -np.inf
                           for v in ([first[p]] if counts[p] == 1 else ids[p].as_py())
                           if v != query]
                    row.sort(key=lambda f: (-f[0], f[1]))
                    out_ids.append(query)
                    out_found.append([{"score": e, "vec_id": v} for e, v in row[:k]])
        kind = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())]))
        return pa.table({"query_id": pa.array(out_ids, pa.int64()),
                         "found": pa.array(out_found, kind)})

    group = ["t", "cell", "split", "block"]
    found = placed.groupBy(*group).cogroup(probes.groupBy(*group)).applyInArrow(
        rerank, "query_id long, found array<struct<score: double, vec_id: long>>")
    best = F.array_sort(F.transform(F.flatten(F.collect_list("found")), lambda f: F.struct(
        (-f["score"]).alias("far"), f["vec_id"].alias("vec_id"), f["score"].alias("score"))))
    return found.groupBy("query_id").agg(F.slice(best, 1, k).alias("found"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each query among all other vectors.

    ``queries``: rows of the same columns as ``vectors``. Of an id that is repeated among
    them the least vector (compared entry by entry) that can take part is asked.
    """
    spark = vectors.sparkSession
    prepare(spark)
    out = "query_id long, rank int, vec_id long, score double"
    rows = materialise(_valid(vectors, id_col, vector_col), "vectors")
    entries = materialise(entries_of(rows, k), "distinct-vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    facts = entries.agg(F.count("*").alias("n"), F.max(square).alias("m"),
                        F.max(F.size("v")).alias("d")).first()
    if not facts["n"]:
        return spark.createDataFrame([], out)
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    # an id may be repeated: of its vectors that can be asked, the least is
    asked = (asked.where(F.col("query_id").isNotNull() & _usable(F.col("v")) & (F.size("v") == facts["d"]))
             .groupBy("query_id").agg(F.min("v").alias("v")))
    sample = np.array([r["v"] for r in entries.orderBy("key").limit(SAMPLE).collect()])
    coder = fit(sample, float(np.sqrt(facts["m"])))
    shared = spark.sparkContext.broadcast(coder)
    index = materialise(_with_codes(entries, shared), "codes")
    radius = calibrate(index, sample[:CALIBRATION], coder, k)

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            code = (shared.value.codes(_matrix(batch.column("v")), query=True)
                    if batch.num_rows else np.zeros(0, np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.view(np.int64))],
                                             names=["query_id", "v", "code"])

    asked = materialise(asked.mapInArrow(encode, "query_id long, v array<double>, code long"),
                        "queries")
    n_queries = asked.count()
    if not n_queries:
        return spark.createDataFrame([], out)
    found = materialise(search(index, asked, radius, k, facts["n"], n_queries), "found")
    enough = found.where(F.size("found") >= k).select("query_id")
    short = materialise(asked.join(enough, "query_id", "left_anti"), "short-queries")
    n_short = short.count()
    if n_short and radius < BITS:
        rest = materialise(search(index, short, BITS, k, facts["n"], n_short), "found")
        found = found.where(F.size("found") >= k).unionByName(rest)
    return (found.select("query_id", F.posexplode("found").alias("place", "f"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"),
                    F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")))
