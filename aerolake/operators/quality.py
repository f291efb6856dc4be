"""Data-quality checks (Q1-Q12), each a single aggregate pass over its table.

Report rows have the shape ``(model, column_name, test, failures, passed)``:

* ``not_null``: failures = rows where the column is NULL;
* ``unique``: failures = non-NULL key values that occur more than once;
* ``accepted_values``: failures = distinct non-NULL values outside the list
  (a NULL value never fails, as in the declarative test it mirrors).

Checks report; they do not stop a pipeline unless ``strict=True`` is asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.schema import SEED_COLUMNS, STATUS_VALUES

REPORT_COLUMNS = ("model", "column_name", "test", "failures", "passed")

# The declared tests per model.
SILVER_NOT_NULL = (
    "sg_empresa_icao", "nr_voo", "sg_icao_origem", "sg_icao_destino", "flag_situacao",
    "rota", "ano", "mes", "dia", "dt_referencia_ts",
)
PUNCTUALITY_NOT_NULL = ("total_voos",)
VOLUME_NOT_NULL = ("total_voos",)
RANKING_NOT_NULL = ("ranking_volume_em_voo",)
SEED_NOT_NULL = SEED_COLUMNS
SEED_UNIQUE = "icao_aerodromo"
STATUS_COLUMN = "flag_situacao"


def _report(df: DataFrame, model: str, tests: Sequence[tuple[str, str, object]]) -> DataFrame:
    """One aggregate over ``df``; ``tests`` = (column, test, aggregate expr) -> rows."""
    if not tests:
        raise ValueError("no tests")
    aggs = [expr.cast("bigint").alias(f"f{i}") for i, (_, _, expr) in enumerate(tests)]
    stacked = ", ".join(
        f"'{col}', '{test}', f{i}" for i, (col, test, _) in enumerate(tests)
    )
    one_row = df.agg(*aggs)
    return one_row.selectExpr(
        f"'{model}' AS model",
        f"stack({len(tests)}, {stacked}) AS (column_name, test, failures)",
    ).withColumn("passed", F.col("failures") == 0)


def not_null(df: DataFrame, model: str, columns: Iterable[str]) -> DataFrame:
    return _report(df, model, [(c, "not_null", F.count_if(F.col(c).isNull())) for c in columns])


def _accepted_test(column: str, values: Sequence[str]):
    bad = F.when(~F.col(column).isin(list(values)), F.col(column))
    return (column, "accepted_values", F.count_distinct(bad))


def accepted_values(df: DataFrame, model: str, column: str,
                    values: Sequence[str] = STATUS_VALUES) -> DataFrame:
    return _report(df, model, [_accepted_test(column, values)])


def not_null_and_accepted(df: DataFrame, model: str, columns: Iterable[str], column: str,
                          values: Sequence[str] = STATUS_VALUES) -> DataFrame:
    """The not_null tests and one accepted_values test in a single pass over ``df``."""
    tests = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in columns]
    return _report(df, model, tests + [_accepted_test(column, values)])


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Duplicated key values. Grouping is partial + final, so a hot key is pre-counted."""
    dup_keys = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    return _report(dup_keys, model, [(column, "unique", F.count_if(F.col("n") > 1))])


def declared_tests(silver: DataFrame, seed: DataFrame, punctuality: DataFrame,
                   volume: DataFrame, ranking: DataFrame) -> DataFrame:
    """All 21 declared tests (19 not_null, 1 unique, 1 accepted_values)."""
    parts = [
        not_null_and_accepted(silver, "silver_voos", SILVER_NOT_NULL, STATUS_COLUMN),
        not_null(punctuality, "gold_pontualidade", PUNCTUALITY_NOT_NULL),
        not_null(volume, "gold_volume_periodo", VOLUME_NOT_NULL),
        not_null(ranking, "gold_ranking_rotas_atrasadas", RANKING_NOT_NULL),
        not_null(seed, "bronze_seed_aeroportos", SEED_NOT_NULL),
        unique(seed, "bronze_seed_aeroportos", SEED_UNIQUE),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforce(report: DataFrame) -> DataFrame:
    """strict mode: raise if any test failed (one small action on the report)."""
    failed = report.filter(~F.col("passed")).select("model", "column_name", "test", "failures")
    rows = failed.collect()  # at most one row for each declared test
    if rows:
        detail = "; ".join(f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in rows)
        raise AssertionError(f"data tests failed: {detail}")
    return report


# --- Q7-Q12: reconciliation and profile checks --------------------------------


def row_reconciliation(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Q7: bronze rows = silver rows (one scan of each via a tagged union)."""
    tagged = bronze.select(F.lit("bronze").alias("layer")).unionByName(
        silver.select(F.lit("silver").alias("layer"))
    )
    return tagged.agg(
        F.count_if(F.col("layer") == "bronze").alias("bronze_rows"),
        F.count_if(F.col("layer") == "silver").alias("silver_rows"),
    ).withColumn("rows_match", F.col("bronze_rows") == F.col("silver_rows"))


def null_routes(silver: DataFrame) -> DataFrame:
    """Q8: flights without a route key."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_voos"),
        F.count_if(F.col("rota").isNull()).alias("voos_sem_rota"),
    )


def status_distribution(silver: DataFrame) -> DataFrame:
    """Q9: flights per status; the counts add up to the total."""
    from aerolake.operators.gold import pct_sql

    counts = silver.groupBy("flag_situacao").agg(F.count(F.lit(1)).alias("total"))
    return counts.withColumn(
        "share_pct",
        F.expr(pct_sql("total", "sum(total) OVER ()")),
    )


def enrichment_coverage(silver: DataFrame) -> DataFrame:
    """Q10: how many flights found their origin / destination airport in the seed."""
    from aerolake.functions.flags import pct

    return silver.agg(
        F.count(F.lit(1)).alias("total_voos"),
        F.count("origem_cidade").alias("voos_origem_enriquecida"),
        F.count("destino_cidade").alias("voos_destino_enriquecida"),
    ).select(
        "*",
        pct("voos_origem_enriquecida", "total_voos").alias("cobertura_origem_pct"),
        pct("voos_destino_enriquecida", "total_voos").alias("cobertura_destino_pct"),
    )


def column_catalogue(df: DataFrame) -> DataFrame:
    """Q11: (position, name, type, nullable, non-NULL values) for every column.

    Names and types come from the schema; the non-NULL counts are one
    aggregate pass, unpivoted with ``stack``.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    stacked = ", ".join(
        f"{i + 1}, '{f.name}', '{f.dataType.simpleString()}', {str(f.nullable).lower()}, c{i}"
        for i, f in enumerate(fields)
    )
    return counts.selectExpr(
        f"stack({len(fields)}, {stacked}) AS (position, column_name, data_type, nullable, non_null)"
    )


def load_reconciliation(expected: DataFrame, loaded: DataFrame,
                        file_col: str = "source_file") -> DataFrame:
    """Q12: per file, rows found in the source listing vs rows present in the target.

    ``expected`` has (file_col, rows); ``loaded`` is the target table. The full
    outer join is between two per-file aggregates (one row per file).
    """
    got = loaded.groupBy(file_col).agg(F.count(F.lit(1)).alias("loaded_rows"))
    return (
        expected.withColumnRenamed("rows", "source_rows")
        .join(got, file_col, "full_outer")
        .withColumn("loaded_rows", F.coalesce("loaded_rows", F.lit(0)))
        .withColumn("source_rows", F.coalesce("source_rows", F.lit(0)))
        .withColumn("reconciled", F.col("source_rows") == F.col("loaded_rows"))
    )


def content_fingerprint(df: DataFrame, columns: Sequence[str], file_col: str = "source_file") -> DataFrame:
    """Per file: rows, and two sums of the halves of the row hashes of STRING columns.

    Order-free. One partial aggregate of three numbers per file; the sums of 32-bit
    halves stay within a BIGINT up to two thousand million rows a file. NULL is hashed as
    the character U+0000, since the hash function would pass over it.
    """
    h = F.xxhash64(*(F.coalesce(F.col(f"`{c}`"), F.lit("\x00")) for c in columns))
    return df.groupBy(F.col(file_col).alias(file_col)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(h.bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high"))


def content_reconciliation(source: DataFrame, loaded: DataFrame, columns: Sequence[str],
                           file_col: str = "source_file") -> DataFrame:
    """Q12 by content: per file, rows on both sides and whether their values are the same.

    A value that has moved to another row, column or file shows; the order of rows does not.
    """
    a = content_fingerprint(source, columns, file_col)
    b = content_fingerprint(loaded, columns, file_col).select(
        file_col, F.col("rows").alias("loaded_rows"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    return a.join(b, file_col, "full_outer").select(
        file_col, F.coalesce("rows", F.lit(0)).alias("source_rows"),
        F.coalesce("loaded_rows", F.lit(0)).alias("loaded_rows"),
        F.coalesce((F.col("rows") == F.col("loaded_rows")) & (F.col("low") == F.col("b_low"))
                   & (F.col("high") == F.col("b_high")), F.lit(False)).alias("reconciled"))
