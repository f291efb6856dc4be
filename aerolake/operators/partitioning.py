"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aerolake.operators.joins import stored_bytes
from aerolake.session import default_parallelism

# A scan of more stored bytes than this is never shuffled to widen it.
SMALL_SCAN_BYTES = 256 * 1024 * 1024


def spread_small_scan(df: DataFrame, path: str) -> DataFrame:
    """Spread a small scan that yields fewer partitions than the session has cores.

    A Parquet row group cannot be split, so a small table written as one row group
    is read by one task. The decision is on stored bytes, so what the round-robin
    shuffle moves has a bound; a larger table is read as its splits come, however
    many cores there are. A fixed-count hash repartition on a join key would pin
    the partitioning and keep AQE from splitting a hot key in a later join.
    """
    if stored_bytes(df.sparkSession, path) > SMALL_SCAN_BYTES:
        return df
    target = default_parallelism(df.sparkSession)
    try:
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (Spark Connect): leave the scan as it is
        return df
    return df if splits >= target else df.repartition(target)
