"""M1: bronze flight rows -> silver flights (typed, decomposed, enriched)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.dates import calendar_parts, guarded_date
from aerolake.functions.flags import flight_status, route_key
from aerolake.operators.joins import DIMENSION_BROADCAST_MAX_ROWS, enrich_airports
from aerolake.schema import (
    BRONZE_COLUMNS,
    SILVER_COLUMNS,
    SILVER_MEASURE_TYPES,
    SOURCE_FILE,
)


def conform_bronze(df: DataFrame) -> DataFrame:
    """Bronze shape for derived rows: columns they do not supply are NULL STRINGs."""
    present = set(df.columns)
    exprs = [
        f"`{c}`" if c in present else f"CAST(NULL AS STRING) AS `{c}`"
        for c in (*BRONZE_COLUMNS, SOURCE_FILE)
    ]
    return df.selectExpr(*exprs)


# Bronze columns that the silver model reads.
REQUIRED_COLUMNS = tuple(c for c in SILVER_COLUMNS if c in BRONZE_COLUMNS)


def require_columns(columns) -> None:
    """Raise if a column that silver reads is absent (names without regard to case)."""
    present = {c.lower() for c in columns}
    missing = [c for c in REQUIRED_COLUMNS if c not in present]
    if missing:
        raise ValueError(f"bronze lacks {len(missing)} columns that silver needs: "
                         + ", ".join(missing))


def required_bronze(df: DataFrame) -> DataFrame:
    """The columns silver reads, under their documented names; raises if one is absent."""
    require_columns(df.columns)
    actual = {c.lower(): c for c in df.columns}
    lineage = actual.get(SOURCE_FILE)
    return df.select(
        *(F.col(f"`{actual[c]}`").alias(c) for c in REQUIRED_COLUMNS),
        (F.col(f"`{lineage}`") if lineage else F.lit(None).cast("string")).alias(SOURCE_FILE))


def measure_text(column: str | Column):
    """A text number with a decimal point: ``1.234,5`` -> ``1234.5``, ``12,0`` -> ``12.0``.

    Points group thousands only where a comma follows; without a comma a point is
    the decimal point, as it is in text that was written with points.
    """
    c = F.col(column) if isinstance(column, str) else column
    comma = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(F.instr(c, ",") > 0, comma).otherwise(c)


def measure_cast(column: str, target: str):
    """try_cast of a text measure; whole numbers may be written with a zero fraction."""
    text = measure_text(column)
    if target == "bigint":
        exact = text.try_cast("decimal(38,10)")
        return F.when(exact == F.floor(exact), exact.try_cast("bigint")).alias(column)
    return text.try_cast(target).alias(column)


def cast_measures(df: DataFrame) -> DataFrame:
    """``df`` with its text measures as numbers, as ``measure_cast`` gives them.

    The measures of type double are cast as one array by one function. Written out column by
    column, a silver row is one generated method of 10,000 bytes; the JVM compiles none above
    8,000, so that it interpreted every row.
    """
    doubles = [c for c, t in SILVER_MEASURE_TYPES.items() if t == "double"]
    others = {c: t for c, t in SILVER_MEASURE_TYPES.items() if t != "double"}
    numbers = F.transform(F.array(*map(measure_text, doubles)), lambda c: c.try_cast("double"))
    return df.withColumn("_doubles", numbers).withColumns({
        **{c: measure_cast(c, t) for c, t in others.items()},
        **{c: F.col("_doubles")[i] for i, c in enumerate(doubles)},
    }).drop("_doubles")


def lost_measures(bronze: DataFrame) -> DataFrame:
    """(column_name, lost): values of each measure that are text but become NULL in silver."""
    counts = bronze.agg(*(
        F.count_if(F.col(c).isNotNull() & measure_cast(c, t).isNull()).alias(c)
        for c, t in SILVER_MEASURE_TYPES.items()))
    pairs = ", ".join(f"'{c}', `{c}`" for c in SILVER_MEASURE_TYPES)
    return counts.selectExpr(f"stack({len(SILVER_MEASURE_TYPES)}, {pairs}) AS (column_name, lost)")


def build_silver(bronze: DataFrame, airports: DataFrame,
                 max_dimension_rows: int = DIMENSION_BROADCAST_MAX_ROWS,
                 cluster_by_month: bool = False) -> DataFrame:
    """One row per bronze row (no filter); 70 columns in the documented order.

    Raises if bronze lacks a column the model reads.

    Narrow work only (one scan, projections, two broadcast hash joins), so the
    silver plan has no shuffle and keeps the input partitioning. With
    ``cluster_by_month`` the rows are clustered by (ano, mes) with a REBALANCE
    hint *before* the airport joins: the joins are narrow, so the result is
    the same, but the shuffle carries rows without the ten airport columns.
    """
    b = required_bronze(bronze)
    ref_date = guarded_date("dt_referencia")
    staged = b.withColumn("dt_referencia_ts", ref_date)
    staged = staged.withColumns(calendar_parts("dt_referencia_ts"))
    staged = staged.withColumns({
        "flag_situacao": flight_status("dt_chegada_real", "dt_partida_real"),
        "rota": route_key("sg_icao_origem", "sg_icao_destino"),
    })
    staged = cast_measures(staged)
    if cluster_by_month:
        staged = staged.hint("rebalance", "ano", "mes")
    enriched = enrich_airports(staged, airports, max_rows=max_dimension_rows)
    return enriched.select(*SILVER_COLUMNS)
