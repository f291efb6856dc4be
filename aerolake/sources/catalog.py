"""Layer databases, the silver table and the gold views.

Tables are external (explicit ``LOCATION``/``path`` under a lake root the
caller chooses, e.g. a folder in the shared checkpoint area), so their data
survives the session and any executor loss.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.dates import calendar_parts, guarded_date
from aerolake.operators import gold
from aerolake.operators.silver import build_silver
from aerolake.session import open_partitions

LAYERS = ("bronze", "silver", "gold")
SILVER_TABLE = "silver_voos"
GOLD_VIEWS = {
    "gold_pontualidade": lambda: gold.PUNCTUALITY_SQL,
    "gold_volume_periodo": lambda: gold.VOLUME_SQL,
    "gold_ranking_rotas_atrasadas": lambda: gold.ranking_sql(ordered=True),
}


def _ident(name: str) -> str:
    if not name.replace("_", "").isalnum():
        raise ValueError(f"bad identifier: {name!r}")
    return f"`{name}`"


def create_layers(spark: SparkSession, lake_root: str, prefix: str = "") -> dict[str, str]:
    """``CREATE DATABASE IF NOT EXISTS`` for bronze / silver / gold."""
    names = {}
    for layer in LAYERS:
        db = f"{prefix}{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(db)} LOCATION '{lake_root}/{db}'")
        names[layer] = db
    return names


# Writing as-is makes one file per (task, month) pair; below this many rows per
# file on average the rows are clustered by month first (REBALANCE).
MIN_ROWS_PER_FILE = 200_000


def output_files(silver: DataFrame) -> DataFrame:
    """task, ym, count: rows per (input partition, month) pair, i.e. per file a direct
    partitioned write would create.

    Only the raw reference-date text is read (column pruning): text shaped
    ``DD/MM/YYYY`` is bucketed by its ``MM/YYYY`` part (its silver month),
    anything else into one bucket (the NULL partition it lands in). No regex
    or date parsing runs, so this costs a small fraction of the write it
    decides about.
    """
    dt = F.col("dt_referencia")
    shaped = (F.substring(dt, 3, 1) == "/") & (F.substring(dt, 6, 1) == "/")
    ym = F.when(shaped, F.substring(dt, 4, 7)).otherwise(F.lit(""))
    return silver.groupBy(F.spark_partition_id().alias("task"), ym.alias("ym")).count()


def rows_per_output_file(silver: DataFrame) -> float:
    """Average rows per (input partition, month) pair, i.e. per file a direct
    partitioned write would create."""
    return float(output_files(silver).agg(F.avg("count")).first()[0] or 0.0)


def needs_clustering(silver: DataFrame) -> bool:
    """Whether a direct partitioned write would leave small files that clustering avoids:
    few rows a file, and more than twice as many files as months and tasks call for.
    """
    row = output_files(silver).agg(
        F.avg("count"), F.count(F.lit(1)), F.count_distinct("task"), F.count_distinct("ym")).first()
    mean, files, tasks, months = (x or 0 for x in row)
    # input in the order of months: each task begins a month anew and holds undated rows
    return mean < MIN_ROWS_PER_FILE and files > 2 * (months + tasks)


def materialise_silver(silver: DataFrame, database: str, path: str,
                       table: str = SILVER_TABLE, cluster: bool | None = None) -> str:
    """Silver as a Parquet table partitioned by (ano, mes), replaced each run.

    Rows with an unparsed date have NULL ano/mes and land in the default
    partition; they read back unchanged (the punctuality model needs them).

    ``cluster=None`` decides from the data. Month-aligned input (large monthly
    source files: each split holds one or two months) is written as it is,
    one large file per split and month, with no shuffle. Input whose months
    are scattered over the splits would leave a small file per split and
    month, so it is first clustered with a REBALANCE hint, whose AQE-sized
    partitions also split a hot month over several tasks.
    """
    name = f"{_ident(database)}.{_ident(table)}"
    if cluster is None:
        cluster = needs_clustering(silver)
    out = silver.hint("rebalance", "ano", "mes") if cluster else silver
    with open_partitions(out.sparkSession):
        (out.write.mode("overwrite").format("parquet")
         .partitionBy("ano", "mes").option("path", path).saveAsTable(name))
    return name


def cluster_by_month(rows: DataFrame) -> DataFrame:
    """``rows`` with those of a month of ``dt_referencia`` together (REBALANCE), as they are otherwise."""
    parts = calendar_parts(guarded_date("dt_referencia"))
    keys = {"_ano": parts["ano"], "_mes": parts["mes"]}
    return rows.withColumns(keys).hint("rebalance", *keys).drop(*keys)


def materialise_silver_from_bronze(bronze: DataFrame, airports: DataFrame, database: str,
                                   path: str, table: str = SILVER_TABLE,
                                   widen: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """S19 from bronze: probe the direct write's file sizes on bronze's date column; when
    clustering is needed, cluster before the airport joins (narrower shuffle).

    Bronze that is not stored yet may be given as the narrow rows it is made of, with their
    ``dt_referencia``, and ``widen``, which makes the bronze row of each. They are probed and
    clustered as they are: the shuffle moves no text that its reader can make.
    """
    # one column of bronze, without the joins: silver has its rows
    cluster = needs_clustering(bronze)
    if widen is None:
        silver = build_silver(bronze, airports, cluster_by_month=cluster)
    else:
        silver = build_silver(widen(cluster_by_month(bronze) if cluster else bronze), airports)
    return materialise_silver(silver, database, path, table, cluster=False)


def create_gold_views(spark: SparkSession, database: str, silver_table: str) -> list[str]:
    """The three gold models as views over the silver table."""
    made = []
    for view, text in GOLD_VIEWS.items():
        name = f"{_ident(database)}.{_ident(view)}"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text().format(silver=silver_table)}")
        made.append(name)
    return made
