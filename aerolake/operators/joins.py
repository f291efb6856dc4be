"""Joins with an explicit size check before any broadcast.

A broadcast copies one side to every executor, so it is only used when that
side is proven small, by one of two checks:

* derived dimensions (the airport table, nation x region): ``fits_broadcast``
  runs a bounded probe, ``take(cap + 1)``, which reads incrementally (one
  partition first, then a growing number) and stops at ``cap + 1`` rows, so
  its cost is bounded by the cap, not by the table;
* base tables (customer, orders, supplier): ``stored_bytes`` sums the file
  sizes from file metadata only, the measure Spark's own threshold uses.

Above the cap the join is a sort-merge join, hinted so the planner cannot
broadcast the big side on a low estimate; AQE then splits a skewed key's
partition (``SortMergeJoin(skew=true)``, see ``tests/test_skew.py``).
Both checks look at the data as it is when the plan is built; nothing is memoised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.schema import SEED_COLUMNS, SEED_ROLE_COLUMNS
from aerolake.session import table_version

# A dimension up to this many rows is broadcast; the airport seed has 44.
DIMENSION_BROADCAST_MAX_ROWS = 100_000

def fits_broadcast(dim: DataFrame, max_rows: int = DIMENSION_BROADCAST_MAX_ROWS) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows now (bounded probe)."""
    return len(dim.select(F.lit(1).alias("one")).take(max_rows + 1)) <= max_rows


# A base table is broadcast up to this many bytes of stored files (compressed
# Parquet), the same measure Spark's own broadcast threshold uses.
TABLE_BROADCAST_MAX_BYTES = 16 * 1024 * 1024


def stored_bytes(spark, path: str) -> int:
    """Total size of the files under ``path`` now; only file metadata is read."""
    return table_version(spark, path)[1]


def bounded_broadcast(dim: DataFrame, max_rows: int = DIMENSION_BROADCAST_MAX_ROWS) -> DataFrame:
    """``dim`` with a broadcast hint if the probe proves it small, else unchanged."""
    return F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim


def join_with_checked_side(big: DataFrame, side: DataFrame, condition, side_table_path: str,
                           max_bytes: int = TABLE_BROADCAST_MAX_BYTES,
                           how: str = "inner") -> DataFrame:
    """Join ``big`` to ``side``: broadcast ``side`` when the stored table that bounds
    it (``side_table_path``) is small, otherwise a sort-merge join. The merge hint
    keeps the planner from broadcasting ``big`` on a low size estimate."""
    if stored_bytes(big.sparkSession, side_table_path) <= max_bytes:
        return big.join(F.broadcast(side), condition, how)
    return big.hint("merge").join(side, condition, how)


def role_dimension(airports: DataFrame, role: str) -> DataFrame:
    """The airport dimension renamed for one role (``origem`` / ``destino``)."""
    return airports.select(
        F.col("icao_aerodromo").alias(f"_{role}_icao"),
        *[F.col(src).alias(f"{role}_{suffix}") for src, suffix in SEED_ROLE_COLUMNS],
    )


def enrich_airports(flights: DataFrame, airports: DataFrame,
                    origin_col: str = "sg_icao_origem",
                    destination_col: str = "sg_icao_destino",
                    max_rows: int = DIMENSION_BROADCAST_MAX_ROWS) -> DataFrame:
    """J1 + J2: two LEFT joins to the same airport dimension (origin, destination).

    Unmatched or NULL codes keep the flight with NULL airport attributes. The
    dimension key must be unique (checked by the ``unique`` data test) or the
    join fans out.
    """
    dim = airports.select(*SEED_COLUMNS)
    origin, destination = role_dimension(dim, "origem"), role_dimension(dim, "destino")
    if fits_broadcast(dim, max_rows):
        origin, destination = F.broadcast(origin), F.broadcast(destination)
    out = flights.join(origin, flights[origin_col] == origin["_origem_icao"], "left")
    out = out.join(destination, out[destination_col] == destination["_destino_icao"], "left")
    return out.drop("_origem_icao", "_destino_icao")
