"""Records that span lines, from files that are still split over many tasks.

A quoted field may hold line ends, so where a record begins depends on the quotes before
it, back to the start of the file. Whole files are not read in one task for that: every
line is a function of one bit (does it begin inside a quoted field?) to one bit (does
it end inside one?), and such functions compose. Four exist: most lines keep the bit,
some flip it, and lines with stray quotes may set it whatever it was.

1. Lines are read by splits. In each split (a block of a file) a running composition over
   its lines is taken, and every line is written once with what stands before it in
   its block.
2. The blocks of a file, a few numbers each, are composed in turn; that gives the bit each
   block begins with, and whether the file ends inside a quoted field.
3. A line that begins outside a quoted field begins a record. Lines that begin and end
   outside are records by themselves and stay where they are. The others are grouped by the
   place where their record began, which may be in an earlier block.

A file that ends inside a quoted field is reported and has no records, so a quote that is
never closed does not gather the rest of its file into one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.session import scratch_dir
from aerolake.sources.encoding import FIELD_SEPARATOR, UTF8, UTF16_BE, UTF16_LE, scan_quotes


def read_lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """file_path, block, pos, text: decoded lines of files of one encoding, by splits.

    Lines end with LF; a CR before it stays. ``pos`` orders the lines of a block.
    """
    reader = spark.read.option("lineSep", "\n")
    if encoding in (UTF16_BE, UTF16_LE):
        reader = reader.option("encoding", encoding)
    value = F.col("value")
    text = value if encoding == UTF8 else F.decode(value.cast("binary"), encoding)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), text.alias("text"))


@dataclass(frozen=True)
class _Run:
    """A composition of line functions, as columns: what a later stretch begins with.

    ``fixed`` is the bit set by the last line that sets it, null without one; ``flips``
    counts the flips since.
    """

    fixed: Column
    flips: Column

    def after(self, begins_inside: Column) -> Column:
        start = F.coalesce(self.fixed, begins_inside)
        return F.when(self.flips % 2 == 1, ~start).otherwise(start)


def _composed(fixed: Column, flips: Column, window) -> _Run:
    """Composition over a window of stretches given by (fixed, flips) columns."""
    total = F.sum(flips).over(window)
    # flips of the stretch that fixes the bit come after it was fixed
    last = F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("fixed"), flips.alias("own"),
                                                     F.col("flips_to").alias("to"))), True).over(window)
    since = F.when(last.isNull(), total).otherwise(total - last["to"] + last["own"])
    return _Run(last["fixed"], F.coalesce(since, F.lit(0)))


def stitch_records(spark: SparkSession, paths: list[str], encoding: str,
                   sep: str = FIELD_SEPARATOR) -> tuple[DataFrame, set[str]]:
    """(records, unclosed): file_path, text, fields of every record but the header line of
    each file, and the paths of files that end inside a quoted field (without records)."""
    lines = read_lines(spark, paths, encoding)
    lines = lines.select("*", scan_quotes(F.col("text"), sep).alias("out"),
                         scan_quotes(F.col("text"), sep, inside=True).alias("in"))
    fixes, flips = F.col("out.open") == F.col("in.open"), ~F.col("in.open") & F.col("out.open")
    lines = lines.select("*", F.when(fixes, F.col("out.open")).alias("fixed"),
                         flips.cast("long").alias("flips"))
    in_block = Window.partitionBy("file_path", "block").orderBy("pos")
    lines = lines.withColumn("flips_to", F.sum("flips").over(
        in_block.rowsBetween(Window.unboundedPreceding, 0)))
    before = _composed(F.col("fixed"), F.col("flips"), in_block.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.select(
        "file_path", "block", "pos", "text", "out", "in", "fixed", "flips",
        before.fixed.alias("fixed_before"), before.flips.alias("flips_before"),
        F.row_number().over(in_block).alias("number"))
    folder = scratch_dir(spark, "text-lines")
    lines.write.parquet(folder)
    lines = spark.read.schema(lines.schema).parquet(folder)

    # blocks: the composition of all their lines, then of all blocks before
    whole_fixed = F.coalesce(F.col("fixed"), F.col("fixed_before"))
    whole_flips = F.when(F.col("fixed").isNotNull(), 0).otherwise(F.col("flips_before") + F.col("flips"))
    blocks = lines.groupBy("file_path", "block").agg(
        F.max_by(F.struct(whole_fixed.alias("fixed"), whole_flips.alias("flips")), "pos").alias("f")) \
        .select("file_path", "block", "f.*")
    in_file = Window.partitionBy("file_path").orderBy("block")
    blocks = blocks.withColumn("flips_to", F.sum("flips").over(
        in_file.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = _composed(F.col("fixed"), F.col("flips"), in_file.rowsBetween(Window.unboundedPreceding, -1))
    own = _Run(F.col("fixed"), F.col("flips"))
    begins = F.coalesce(earlier.after(F.lit(False)), F.lit(False))
    blocks = blocks.withColumn("begins", begins).withColumn("ends", own.after(F.col("begins")))
    blocks_dir = scratch_dir(spark, "text-blocks")
    blocks.select("file_path", "block", "begins", "ends").write.parquet(blocks_dir)
    blocks = spark.read.parquet(blocks_dir)
    unclosed = {r.file_path for r in blocks.groupBy("file_path").agg(
        F.max_by("ends", "block").alias("open")).where("open").select("file_path").collect()}

    # lines: where they begin and end, and the record they are of
    inside = _Run(F.col("fixed_before"), F.col("flips_before")).after(F.col("begins"))
    lines = lines.join(blocks.select("file_path", "block", "begins"), ["file_path", "block"])
    if unclosed:
        lines = lines.where(~F.col("file_path").isin(sorted(unclosed)))
    lines = (lines.where((F.col("block") > 0) | (F.col("number") > 1))  # the header
             .withColumn("inside", inside)
             .withColumn("open", F.when(F.col("inside"), F.col("in.open")).otherwise(F.col("out.open")))
             .withColumn("separators", F.when(F.col("inside"), F.col("in.separators"))
                         .otherwise(F.col("out.separators"))))
    whole = lines.where(~F.col("inside") & ~F.col("open")).select(
        "file_path", "text", (F.col("separators") + 1).alias("fields"))
    # A record that is open at the end of a block goes on in the next blocks up to the first
    # line there that ends outside: its key is the block it began in.
    parts = lines.where(F.col("inside") | F.col("open"))
    first = F.last(F.when(~F.col("inside"), F.col("pos")), True).over(
        in_block.rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("began", first)
    latest = parts.groupBy("file_path", "block").agg(F.max("began").alias("latest"))
    origin = blocks.join(latest, ["file_path", "block"], "left").select(
        "file_path", "block", "latest",
        F.last(F.when(F.col("latest").isNotNull(), F.struct("block", "latest")), True).over(
            in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    parts = parts.join(origin.select("file_path", "block", "carried"), ["file_path", "block"]).withColumn(
        "key", F.coalesce(F.when(F.col("began").isNotNull(), F.struct("block", F.col("began").alias("latest"))),
                          F.col("carried")))
    pieces = F.array_sort(F.collect_list(F.struct("block", "pos", "text")))
    spanning = parts.groupBy("file_path", "key").agg(
        F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"),
        (F.sum("separators") + 1).cast("int").alias("fields"))
    records = whole.unionByName(spanning.select("file_path", "text", "fields"))
    # a CR LF ends a record; blank lines are no records, as in the line reader
    text = F.regexp_replace("text", r"\r\z", "")
    records = records.withColumn("text", text).where(F.trim("text") != "")
    return records, unclosed
