"""Session helpers.

Library functions never rebuild or reconfigure the caller's session; they take
``spark`` as an argument. ``local_session`` is for tests and the benchmark only.
Shared scratch space comes from ``spark.checkpoint.dir`` (on a cluster this is
a shared filesystem folder); a local temporary folder is created only when that
setting is unset and the master is local, as in tests; on a cluster that raises.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "aerolake") -> SparkSession:
    """A local[N] session with the settings the library is designed for."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (memo keys); works without a SparkContext."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect exposes no SparkContext
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", None)
                   or spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session; set one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server side names the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Outside a cluster (tests): nothing names a shared folder.
        configured = tempfile.mkdtemp(prefix="aerolake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/aerolake/{tag}-{uuid.uuid4().hex[:12]}"


def table_version(spark: SparkSession, folder: str) -> tuple:
    """(files, bytes, checksum of the listing) of the files below a folder.

    From file metadata only; it changes whenever a file is added, removed or rewritten.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .load(folder).select("path", "length", "modificationTime"))
    row = listing.agg(F.count(F.lit(1)), F.sum("length"),
                      F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return int(row[0]), int(row[1] or 0), int(row[2] or 0)


# Partitions of the output that a task keeps open at once.
OPEN_PARTITIONS = 8
OPEN_PARTITIONS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_partitions(spark: SparkSession, most: int = OPEN_PARTITIONS):
    """Partitioned writes inside do not sort rows whose tasks meet few partitions.

    Without it every task sorts its rows by partition, wide as they are, and spills them;
    a task that meets more partitions than ``most`` sorts the rows that come after. The
    session's own setting is back afterwards.
    """
    with _setting(spark, OPEN_PARTITIONS_CONF, str(most)):
        yield


# Whether a query's shuffle files go when it ends.
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of the writes inside go as soon as each has ended.

    Without it they lie on the executors' disks until the driver happens to collect its
    garbage, so that those of many steps add up. The session's own setting is back afterwards.
    """
    with _setting(spark, SHUFFLE_CLEANUP_CONF, "true"):
        yield


@contextmanager
def _setting(spark: SparkSession, conf: str, value: str):
    before = spark.conf.get(conf)
    spark.conf.set(conf, value)
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def scale_settings(input_bytes: int, executors: int, cores_per_executor: int,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized for a run over ``input_bytes`` of input on a cluster.

    * file splits and AQE's target partition size are ``target_partition_bytes``
      (256 MB: large Parquet files, and each task's data fits executor memory);
    * the initial shuffle partition count covers the whole input at that size
      and at least three waves of the cluster's cores; AQE then coalesces small
      partitions and splits skewed ones (joins and REBALANCE), so the widest
      shuffle (the silver clustering) never lands in a few huge tasks.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(3 * cores, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_partition_bytes)),
        "spark.sql.files.maxPartitionBytes": str(int(target_partition_bytes)),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set runtime SQL settings on a session (static ones belong in spark-submit)."""
    for key, value in settings.items():
        spark.conf.set(key, value)
