"""S3: per-file encoding detection as one distributed pass over the raw bytes.

``spark.read.text`` keeps each line's raw bytes (it does not decode), so one
aggregation grouped by file decides the encoding of every file at once:

1. the first line starts with a UTF-16 byte-order mark -> ``UTF-16BE`` or
   ``UTF-16LE`` by the mark, so the file can still be split into lines;
2. every line is valid UTF-8 -> ``UTF-8`` (a UTF-8 BOM is dropped by the line
   reader, so UTF-8 with BOM lands here too);
3. some byte is one that windows-1252 leaves undefined -> ``ISO-8859-1``;
4. otherwise ``windows-1252``, the safe default for these files.

Files of 3 and 4 with bytes that older code pages use for accented letters are marked
``may_be_legacy``; ``codepages.py`` decides on those.

The same pass records what the reader needs next: the header line, its field
count, the largest field count of any line (a line with more fields than the
header makes the whole file fail, as a pandas reader would), whether a field
opens with a quote and leaves it open (records then span lines, see
``records.py``; a stray quote inside a field does not), and whether UTF-16 lines end with CR LF.
Every byte is inspected, not a leading sample, so a late accent is not missed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Byte-order marks and the five bytes windows-1252 leaves undefined.
UTF16_BE_BOM = "FEFF"
UTF16_LE_BOM = "FFFE"
CP1252_UNDEFINED_BYTES = ("81", "8D", "8F", "90", "9D")

UTF8 = "UTF-8"
UTF16 = "UTF-16"
UTF16_BE = "UTF-16BE"
UTF16_LE = "UTF-16LE"
LATIN1 = "ISO-8859-1"
CP1252 = "windows-1252"

FIELD_SEPARATOR = ";"
# What a line of a file may show, as bits.
NOT_UTF8, UNDEFINED, OPEN_QUOTE, LEGACY = 1, 2, 4, 8
QUOTE = '"'


def _count_char(text: Column, ch: str) -> Column:
    """Occurrences of an ASCII character, counted in bytes.

    ``length`` would read an undecoded accent byte as the start of a longer
    character and swallow the separators after it.
    """
    without = F.replace(text, F.lit(ch), F.lit(""))
    return F.octet_length(text.cast("binary")) - F.octet_length(without.cast("binary"))


OUTSIDE, INSIDE, CLOSED = 0, 1, 2


def scan_quotes(line: Column, sep: str = FIELD_SEPARATOR, inside: bool = False) -> Column:
    """struct(open, separators) of a line that begins outside (or inside) a quoted field.

    ``open`` says whether the line ends inside a quoted field; ``separators`` counts
    those outside of one. A quote opens a field only as its first character and closes
    it unless it is doubled; a quote elsewhere is an ordinary character.

    The text between quotes is folded once from left to right, so time is linear in the
    line and nothing recurses, however long a field is. Lines without a quote are only
    counted.
    """
    parts = F.split(line, QUOTE)
    begin = F.lit(INSIDE if inside else OUTSIDE)

    def behind_quote(last: Column, text: Column) -> Column:
        """State behind a quote; ``last`` is what stands before it."""
        before, state = last["text"], last["state"]
        opens = F.endswith(before, F.lit(sep)) | (last["first"] & (before == ""))
        doubled = (state == CLOSED) & (before == "")
        return (F.when(state == INSIDE, F.lit(CLOSED))
                .when(doubled, F.lit(INSIDE))
                .when((state == OUTSIDE) | (before != ""),
                      F.when(opens, F.lit(INSIDE)).otherwise(F.lit(OUTSIDE)))
                .otherwise(F.lit(OUTSIDE)))

    def fold(last: Column, text: Column) -> Column:
        state = behind_quote(last, text)
        return F.struct(
            state.alias("state"), text.alias("text"), F.lit(False).alias("first"),
            (last["separators"] + F.when(state == INSIDE, F.lit(0)).otherwise(_count_char(text, sep)))
            .alias("separators"))

    head = F.struct(begin.alias("state"), parts[0].alias("text"), F.lit(not inside).alias("first"),
                    (F.lit(0) if inside else _count_char(parts[0], sep)).alias("separators"))
    folded = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), head, fold,
                         lambda last: F.struct((last["state"] == INSIDE).alias("open"), last["separators"]))
    plain = F.struct(F.lit(inside).alias("open"),
                     (F.lit(0) if inside else _count_char(line, sep)).alias("separators"))
    return F.when(F.instr(line, QUOTE) > 0, folded).otherwise(plain)


def field_count(line: Column, sep: str = FIELD_SEPARATOR) -> Column:
    """Fields of one record, separators inside quoted fields not counted."""
    return scan_quotes(line, sep)["separators"] + F.lit(1)


def opens_quote(line: Column, sep: str = FIELD_SEPARATOR) -> Column:
    """Whether a field of the line opens with a quote and is left open."""
    return scan_quotes(line, sep)["open"]


def profile_text_files(raw: DataFrame, sep: str = FIELD_SEPARATOR) -> DataFrame:
    """One row per file of a ``spark.read.text`` frame (with ``_metadata``).

    Columns: file_path, file_name, lines, encoding, multiline, crlf, header,
    header_bytes, header_key (64-bit hash of the header line), header_fields,
    max_fields, too_many_fields. ``too_many_fields`` is final for files of one
    byte a separator and one line a record. In UTF-16 files, whose lines are not split at
    characters here, the decoded lines decide that and ``multiline`` (false here), see
    ``text.utf16_lines``; in files with quoted fields over several lines the stitched
    records do (``records.stitch_records``).
    """
    raw_value = F.col("value")
    as_bytes = raw_value.cast("binary")
    utf8 = F.is_valid_utf8(raw_value)
    # byte checks only on lines that are not valid UTF-8 (CASE branches are lazy)
    undefined = F.when(~utf8, reduce(
        lambda a, b: a | b,
        [F.contains(as_bytes, F.unhex(F.lit(x))) for x in CP1252_UNDEFINED_BYTES],
    )).otherwise(F.lit(False))
    # bytes that MS-DOS and Mac code pages use for small accented letters
    legacy = F.when(~utf8, F.decode(as_bytes, "ISO-8859-1").rlike(r"[\x80-\xa3]")).otherwise(F.lit(False))
    lines = raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(F.input_file_block_start().alias("block"),
                 F.monotonically_increasing_id().alias("pos")).alias("order"),
        raw_value.alias("line"),
        utf8.alias("utf8"),
        undefined.alias("undefined"),
        legacy.alias("legacy"),
        scan_quotes(raw_value, sep).alias("scan"),
        # between the bytes of a UTF-16 CR LF, and after a last little-endian LF
        (as_bytes == F.unhex(F.lit("00"))).alias("stub"),
    )
    # What a line shows, as a small set: most lines show nothing. (A set is also gathered
    # by hash; the header alone would have all lines sorted by file.)
    shown = (F.when(F.col("utf8"), F.lit(0)).otherwise(F.lit(NOT_UTF8))
             + F.when(F.col("undefined"), F.lit(UNDEFINED)).otherwise(F.lit(0))
             + F.when(F.col("scan.open"), F.lit(OPEN_QUOTE)).otherwise(F.lit(0))
             + F.when(F.col("legacy"), F.lit(LEGACY)).otherwise(F.lit(0)))
    lines = lines.select("file_path", "order", "line", "stub", F.nullif(shown, F.lit(0)).alias("shown"),
                         (F.col("scan.separators") + 1).alias("fields"))
    per_file = lines.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min_by(F.struct("line", "fields"), "order").alias("first"),
        F.max("fields").alias("max_fields"),
        F.collect_set("shown").alias("shown"),
        F.count_if("stub").alias("stubs"),
        F.max_by("stub", "order").alias("last_is_stub"),
    )

    def any_shows(flag: int) -> Column:
        return F.exists("shown", lambda s: s.bitwiseAND(flag) != 0)

    per_file = per_file.select(
        "*", F.substring_index("file_path", "/", -1).alias("raw_name"), F.col("first.line").alias("header"),
        F.col("first.fields").alias("header_fields"), (~any_shows(NOT_UTF8)).alias("all_utf8"),
        any_shows(UNDEFINED).alias("any_undefined"), any_shows(LEGACY).alias("any_legacy"),
        any_shows(OPEN_QUOTE).alias("any_open_quote"),
    ).withColumn("file_name", F.url_decode(F.replace("raw_name", F.lit("+"), F.lit("%2B"))))
    head_hex = F.hex(F.substring(F.col("header").cast("binary"), 1, 2))
    encoding = (
        F.when(head_hex == UTF16_BE_BOM, F.lit(UTF16_BE))
        .when(head_hex == UTF16_LE_BOM, F.lit(UTF16_LE))
        .when(F.col("all_utf8"), F.lit(UTF8))
        .when(F.col("any_undefined"), F.lit(LATIN1))
        .otherwise(F.lit(CP1252))
    )
    multiline = F.col("any_open_quote") & ~encoding.isin(UTF16_BE, UTF16_LE)
    # Every line ends with CR LF, but perhaps a last one without any line end.
    ended = F.col("last_is_stub").cast("int")
    pairs = F.col("stubs") - F.when(encoding == UTF16_LE, ended).otherwise(F.lit(0))
    crlf = (pairs > 0) & (pairs >= F.col("lines") - F.col("stubs") - 1 + ended)
    return per_file.select(
        "file_path", "file_name", "lines",
        encoding.alias("encoding"),
        (F.col("any_legacy") & encoding.isin(CP1252, LATIN1)).alias("may_be_legacy"),
        multiline.alias("multiline"),
        crlf.alias("crlf"),
        "header", F.col("header").cast("binary").alias("header_bytes"),
        F.xxhash64("header").alias("header_key"), "header_fields", "max_fields",
        (~F.col("any_open_quote") & ~encoding.isin(UTF16_BE, UTF16_LE)
         & (F.col("max_fields") > F.col("header_fields"))).alias("too_many_fields"),
    )


def detect_encodings(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Encoding profile of the given text files (see ``profile_text_files``)."""
    return profile_text_files(spark.read.text(paths))


def decode_header(raw: bytes | bytearray | None, encoding: str) -> str | None:
    """Header text from the raw first line of a file (driver side, once per header)."""
    if raw is None:
        return None
    data = bytes(raw)
    if encoding in (UTF16_BE, UTF16_LE):
        data = data[2:]                       # the byte-order mark
        if len(data) % 2:                     # split at 0x0A inside the newline char
            data = data[:-1] if encoding == UTF16_BE else data[1:]
        text = data.decode("utf-16-be" if encoding == UTF16_BE else "utf-16-le", "replace")
    else:
        codec = {UTF8: "utf-8-sig", CP1252: "cp1252", LATIN1: "latin-1"}.get(encoding, "latin-1")
        text = data.decode(codec, "replace")
    return text.replace("\x00", "").rstrip("\r")
