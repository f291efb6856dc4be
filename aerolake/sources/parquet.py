"""Parquet file profile, validation, consolidation and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.schema import BRONZE_COLUMNS, SOURCE_FILE
from aerolake.sources.manifest import VERIFY_PAGES


def read_processed(spark: SparkSession, directory: str) -> DataFrame:
    """Lazy read of a processed dataset (all files, merged STRING schemas).

    A corrupt file raises; only ``validate_parquet`` reads past one.
    """
    return spark.read.option("mergeSchema", "true").parquet(directory)


def bronze_schema(columns: list[str]) -> T.StructType:
    """The schema bronze is written and read with: the documented record when the columns
    are its (else only those seen), then every further column seen so far, then lineage."""
    record = list(BRONZE_COLUMNS) if set(columns) & set(BRONZE_COLUMNS) else []
    names = [*record, *(c for c in columns if c not in record and c != SOURCE_FILE), SOURCE_FILE]
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def file_row_counts(df: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Rows per file. Grouping on a partition/metadata column reads no data pages."""
    key = F.col(by) if by in df.columns else F.col("_metadata.file_name")
    return df.groupBy(key.alias(SOURCE_FILE)).agg(F.count(F.lit(1)).alias("rows"))


def parquet_profile(spark: SparkSession, directory: str) -> DataFrame:
    """S7 + S9: (source_file, rows, columns) for every readable file of the dataset."""
    df = read_processed(spark, directory)
    n_cols = len([c for c in df.columns if c != SOURCE_FILE])
    return file_row_counts(df).withColumn("columns", F.lit(n_cols))


def validate_parquet(spark: SparkSession, directory: str, expected: DataFrame,
                     schema: T.StructType, paths: list[str] | None = None,
                     content: bool = True) -> DataFrame:
    """Per expected file (column ``source_file``): its rows and whether it is valid.

    A file is valid when it has rows and every Parquet file below its partition can be
    read. With a given ``schema`` no footer is needed to plan, so a file that is not
    Parquet at all is passed over by the scan and shows up as unread here. With
    ``content`` every page of every column is read and its checksum verified (Parquet
    writers store one for each page): a file whose pages give fewer rows than its footer
    names is not valid. Without it only footers are read. ``paths`` limits the check to
    some folders below ``directory``.
    """
    paths = [directory] if paths is None else paths
    if not paths:
        return expected.select(SOURCE_FILE, F.lit(0).cast("bigint").alias("rows"),
                               F.lit(False).alias("valid"), F.lit(0).cast("bigint").alias("files"))
    part = F.regexp_extract("path", f"{SOURCE_FILE}=([^/]+)/[^/]+$", 1)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").load(paths).select("path")
              .select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"),
                      F.url_decode(F.regexp_replace(part, "\\+", "%2B")).alias(SOURCE_FILE))
              .groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("files")))
    scan = (spark.read.schema(schema).option("ignoreCorruptFiles", "true").option(VERIFY_PAGES, "true")
            .option("basePath", directory).parquet(*paths))
    file = F.col("_metadata.file_name").alias("file")
    per_file = scan.groupBy(SOURCE_FILE, file).agg(F.count(F.lit(1)).alias("rows"))
    if content:
        stored = [F.col(f"`{c}`") for c in schema.names if c != SOURCE_FILE]
        # the hashes are summed, or the optimiser would count rows without any column
        decoded = scan.select(SOURCE_FILE, file, F.xxhash64(*stored).alias("h")) \
            .groupBy(SOURCE_FILE, "file").agg(F.count(F.lit(1)).alias("decoded"), F.bit_xor("h").alias("h"))
        per_file = per_file.join(decoded, [SOURCE_FILE, "file"], "left")
        sound = F.coalesce((F.col("decoded") == F.col("rows")) & F.col("h").isNotNull(), F.lit(False))
    else:
        sound = F.lit(True)
    read = per_file.groupBy(SOURCE_FILE).agg(F.sum("rows").alias("rows"),
                                             F.count_if(sound).alias("read"))
    return (
        expected.select(SOURCE_FILE).distinct()
        .join(listed, SOURCE_FILE, "left").join(read, SOURCE_FILE, "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0)).cast("bigint"))
        .withColumn("valid", F.coalesce((F.col("rows") > 0) & (F.col("read") == F.col("files")),
                                        F.lit(False)))
        .select(SOURCE_FILE, "rows", "valid", F.coalesce("files", F.lit(0)).alias("files"))
    )


def consolidate(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One dataset from many Parquet files/dirs (by column name, missing -> NULL),
    with ``source_file`` lineage when the files do not carry it already."""
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    if SOURCE_FILE not in df.columns:
        df = df.withColumn(SOURCE_FILE, F.col("_metadata.file_name"))
    return df


def sample_rows(df: DataFrame, target_dir: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows (no order promised) written to ``target_dir``, replaced."""
    df.limit(n).write.mode("overwrite").parquet(target_dir)
    return df.sparkSession.read.parquet(target_dir)


def column_type_profile(df: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Per file and STRING column, the narrowest type all its values fit.

    ``bigint`` if every non-NULL value casts to BIGINT, else ``double`` if every
    one casts to DOUBLE (decimal comma accepted), else ``string``; an all-NULL
    column reports ``null``. One aggregate pass, unpivoted with ``stack``; two
    files disagreeing on a column is the type drift a per-file inference
    would meet.
    """
    cols = [c for c, t in df.dtypes if t == "string" and c != by]
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.count(v.try_cast("bigint")).alias(f"i{i}"),
            F.count(F.regexp_replace(v, ",", ".").try_cast("double")).alias(f"d{i}"),
        ]
    per_file = df.groupBy(by).agg(*aggs)
    kinds = [
        f"'{c}', CASE WHEN n{i} = 0 THEN 'null' WHEN i{i} = n{i} THEN 'bigint' "
        f"WHEN d{i} = n{i} THEN 'double' ELSE 'string' END"
        for i, c in enumerate(cols)
    ]
    return per_file.selectExpr(
        f"`{by}`", f"stack({len(cols)}, {', '.join(kinds)}) AS (column_name, inferred_type)")


def type_drift(profile: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Columns whose inferred type differs between files (NULL-only files ignored)."""
    typed = profile.filter(F.col("inferred_type") != "null")
    return typed.groupBy("column_name").agg(
        F.count_distinct("inferred_type").alias("types"),
        F.count(F.lit(1)).alias("files"),
        F.array_sort(F.collect_set("inferred_type")).alias("inferred_types"),
    ).filter(F.col("types") > 1)
