"""Whitening of embeddings from exact covariances by polarisation.

Every entry c becomes the whole number ``x = floor(1024 * c) + 100000``. Two passes
over all vectors, each one partial aggregate per task, gather

1. the number of vectors and the sum of every dimension;
2. the sum of squares of every dimension and of every sum of two dimensions, of
   values centred at the whole number below the mean.

All sums are whole numbers and exact. What the centre lacks of the mean is a known
remainder r (the sum of the centred values), so ``n**2 * sum(y**2) - n * r**2`` is
exactly ``sum((n * x - S)**2)``. The covariance of two dimensions is half of the
variance of their sum less their own variances (polarisation); only that result is
rounded to double precision, and its eigenvectors are the components. The driver holds
d * d numbers for d dimensions, whatever the number of vectors.

Whitened values are then written as a table, and the covariance of what was written
is the check that is returned with them.

Nulls, empties, ties: vectors that are null, or hold null or non-finite entries, or
whose length differs from the most frequent one, take no part; zero vectors do; a null
id is kept; repeated rows count as often as they stand. A component whose variance is
zero to working precision has null whitened values and no part in the check (which is
null if there is no other); ``explained`` is null where all vectors are equal. An
empty table, or vectors without entries, give no rows. Entries of 2**40 and more in
size raise, as their squares would outgrow the exact sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare

# Scale and offset of the whole numbers.
SCALE, OFFSET = 1024, 100_000
#: Components that are returned.
COMPONENTS = 8
#: Greatest size of an entry, of a centred value whose square fits a 64-bit sum, and
#: the vectors of a batch that are squared at once.
LARGEST, SMALL, ROWS = float(1 << 40), 1 << 24, 1 << 12

SUMS = "i int, j int, total decimal(38,0)"


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    usual = (rows.groupBy(F.size("v").alias("d")).count()
             .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    return rows.where((F.size("v") == (usual[0]["d"] if usual else 0)) & (F.size("v") > 0))


def _whole(column) -> np.ndarray:
    """The whole numbers of an Arrow column of vectors, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if flat.size and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"an entry of {LARGEST:.0f} or more in size")
    return np.floor(flat * SCALE).astype(np.int64) + OFFSET


def _sums(rows: DataFrame, of_batch) -> list:
    """(i, j, total) over all vectors of what ``of_batch`` gives of a batch: a matrix (i, j)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(_whole(batch.column("v")))
                total = part if total is None else total + part
        if total is None:
            return
        i, j = np.nonzero(np.triu(np.ones(total.shape, dtype=bool)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
             pa.array([Decimal(int(t)) for t in total[i, j]], pa.decimal128(38, 0))],
            names=["i", "j", "total"])

    prepare(rows.sparkSession)
    return (rows.select("v").mapInArrow(run, SUMS)
            .groupBy("i", "j").agg(F.sum("total").alias("total")).collect())


def _column_sums(x: np.ndarray) -> np.ndarray:
    """One row: the number of vectors, then the sum of each dimension (Python integers)."""
    return np.concatenate([[len(x)], x.astype(object).sum(axis=0)]).reshape(1, -1)


def _pair_squares(y: np.ndarray) -> np.ndarray:
    """Sum of (y_i + y_j)**2 for i < j, and of y_i**2 for i = j (Python integers)."""
    d = y.shape[1]
    out = np.zeros((d, d), dtype=object)
    if np.abs(y).max() >= SMALL:
        y = y.astype(object)
    for at in range(0, len(y), ROWS):
        part = y[at:at + ROWS]
        for i in range(d):
            pair = part[:, i:] + part[:, i:i + 1]
            pair[:, 0] = part[:, i]
            out[i, i:] += (pair * pair).sum(axis=0).astype(object)
    return out


@dataclass
class Moments:
    """Exact first and second moments of whole vectors."""

    n: int
    sums: list[int]
    #: sum over all vectors of (n * x_i - sum_i) * (n * x_j - sum_j), exact
    products: list[list[int]]

    @property
    def centre(self) -> list[int]:
        return [s // self.n for s in self.sums]

    def covariance(self) -> np.ndarray:
        return np.array([[p / self.n ** 3 for p in row] for row in self.products])


def moments(rows: DataFrame) -> Moments | None:
    """Moments of all vectors ``v``, by polarisation; None without vectors."""
    first = {r.j: int(r.total) for r in _sums(rows, _column_sums)}
    if not first:
        return None
    n, d = first[0], len(first) - 1
    sums = [first[j + 1] for j in range(d)]
    centre = np.array([s // n for s in sums])
    rest = [s - n * int(c) for s, c in zip(sums, centre)]  # the sum of centred values
    squares = {(r.i, r.j): int(r.total) for r in _sums(rows, lambda x: _pair_squares(x - centre))}

    def deviation(i: int, j: int) -> int:
        """n**2 times the summed squares, centred at the mean, of one dimension or a pair."""
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * n * squares[i, j] - n * r * r

    own = [deviation(i, i) for i in range(d)]
    products = [[0] * d for _ in range(d)]
    for i in range(d):
        products[i][i] = own[i]
        for j in range(i + 1, d):
            products[i][j] = products[j][i] = (deviation(i, j) - own[i] - own[j]) // 2
    return Moments(n, sums, products)


@dataclass
class Whitener:
    """Components of a covariance, by falling variance."""

    moments: Moments
    axes: np.ndarray  # (dimensions, components), unit columns
    variance: np.ndarray
    explained: list[float | None]

    @property
    def scale(self) -> np.ndarray:
        """Columns divided by their standard deviation; NaN where there is none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.variance > 0, self.axes / np.sqrt(self.variance), np.nan)


def fit(found: Moments, components: int = COMPONENTS) -> Whitener:
    """Eigenvectors of the covariance; the entry of greatest size of each is positive."""
    covariance = found.covariance()
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components].copy(), vectors[:, ::-1][:, :components]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    trace = float(np.trace(covariance))
    noise = len(covariance) * np.finfo(float).eps * max(float(values[0]), 0.0)
    values[values <= noise] = 0.0
    return Whitener(found, vectors, values, [v / trace if trace else None for v in values.tolist()])


def transform(rows: DataFrame, model: Whitener) -> DataFrame:
    """vec_id, deviation decimal(38,0), whitened array<double> of every row of (vec_id, v)."""
    n, sums, scale = model.moments.n, model.moments.sums, model.scale
    centre = np.array(model.moments.centre)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre)], dtype=object)
    missing = np.isnan(scale).any(axis=0)
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            y = _whole(batch.column("v")) - centre
            lag = y.astype(object) * n - rest  # n * x - S
            white = (y - rest.astype(float) / n) @ np.nan_to_num(scale)
            hidden = np.broadcast_to(missing, white.shape)
            ends = np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"),
                 pa.array([Decimal(int(t)) for t in (lag * lag).sum(axis=1)], pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(ends, pa.array(white.ravel(), mask=hidden.ravel()))],
                names=["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>")


def identity_error(white: DataFrame, model: Whitener) -> float | None:
    """Largest entry, in size, of the covariance of ``whitened`` less the identity.

    ``covar_pop`` centres its values before it multiplies them.
    """
    used = [c for c in range(len(model.variance)) if model.variance[c] > 0]
    if not used:
        return None
    value = {c: F.col("whitened")[c] for c in used}
    entries = white.agg(*(F.covar_pop(value[a], value[b]).alias(f"{a}_{b}")
                          for a in used for b in used if a <= b)).first().asDict()
    return max(abs(v - (k.split("_")[0] == k.split("_")[1])) for k, v in entries.items())


WHITENED = ("vec_id {id}, component int, n long, deviation decimal(38,0), whitened double, "
            "explained double, identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part and each of the first components."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_col, vector_col)
    found = moments(rows)
    if found is None:
        return spark.createDataFrame(
            [], WHITENED.format(id=rows.schema["vec_id"].dataType.simpleString()))
    model = fit(found, components)
    white = materialise(transform(rows, model), "whitened")
    error = identity_error(white, model)
    explained = F.array(*(F.lit(e).cast("double") for e in model.explained))
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"),
        "deviation", "whitened", explained[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
