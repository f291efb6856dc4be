"""S3: telling single-byte code pages apart by how likely their text is.

Bytes alone do not say whether a file is windows-1252, MS-DOS Portuguese (cp860) or Mac
Turkish: all give every byte a character. Decoded wrongly, though, the accented letters
of a word become signs or letters that such words never hold. So every byte above 127
is counted with what stands beside it (a letter on both sides, on one, on none; small
or capital letters), and each code page is given the log-likelihood of the characters
it reads there. The default stays unless another page is likelier by ``PRIOR``.

Counting is one aggregation over the lines that are not UTF-8 of the files in question;
the scores come from a table of 128 bytes x contexts, built from the code pages and the
fixed weights below.
"""

from __future__ import annotations

import unicodedata
from math import inf

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Java names of the legacy code pages, and Python's names of all candidates.
CP860 = "IBM860"
MAC_TURKISH = "x-MacTurkish"
CODECS = {"windows-1252": "cp1252", "ISO-8859-1": "latin-1", CP860: "cp860", MAC_TURKISH: "mac_turkish"}

# Natural logarithms of about how often an accented letter of Portuguese text
# is this one, and of how often a sign beside letters is one that typesetting uses.
LETTERS = {"ã": -1.6, "ç": -1.8, "á": -2.1, "é": -2.1, "í": -2.5, "ó": -2.5, "õ": -3.0, "ê": -3.0,
           "ú": -3.0, "â": -3.5, "à": -3.5, "ô": -3.9, "ü": -6.0, "ñ": -7.0}
OTHER_LETTER, WRONG_CASE, CONTROL = -8.0, -4.0, -12.0
TYPESET = "‘’“”–—…•ªº°§"
#: Log-likelihood a less usual page must be ahead by, whatever the file's size.
PRIOR = 6.0

MID, EDGE, ALONE = "mid", "edge", "alone"
SMALL, CAPITAL = "small", "capital"


def weight(char: str, place: str, case: str) -> float:
    """Log-likelihood of a character above ASCII beside letters of a case."""
    if char == "�" or unicodedata.category(char) == "Cc":
        return CONTROL
    if not char.isalpha() or char in TYPESET:
        if char in TYPESET:
            return -5.0 if place == MID else -2.0
        return -9.0 if place == MID else -5.0
    known = LETTERS.get(char.lower(), OTHER_LETTER)
    wrong = char.isupper() != (case == CAPITAL) if place != ALONE else False
    return known + (WRONG_CASE if wrong else 0.0) - {MID: 0.0, EDGE: 0.5, ALONE: 1.5}[place]


def weights(spark: SparkSession) -> DataFrame:
    """byte (as its Latin-1 character), place, case, and a column of weights per page."""
    rows = []
    for b in range(128, 256):
        chars = [bytes([b]).decode(codec, "replace") for codec in CODECS.values()]
        rows += [(chr(b), place, case, *(weight(c, place, case) for c in chars))
                 for place in (MID, EDGE, ALONE) for case in (SMALL, CAPITAL)]
    columns = ", ".join(f"w{i} double" for i in range(len(CODECS)))
    return spark.createDataFrame(rows, f"byte string, place string, case string, {columns}")


def likely_pages(spark: SparkSession, paths: list[str]) -> dict[str, dict[str, float]]:
    """file path -> log-likelihood of every code page, for files that are not UTF-8."""
    raw = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"),
                                        F.col("value").alias("line"))
    text = F.decode(F.col("line").cast("binary"), "ISO-8859-1")  # a character a byte
    runs = raw.where(~F.is_valid_utf8("line")).select(
        "file_path", F.explode(F.regexp_extract_all(text, F.lit(r"[A-Za-z]?[\x80-\xff]+[A-Za-z]?"), F.lit(0)))
        .alias("run"))
    counted = runs.groupBy("file_path", "run").agg(F.count(F.lit(1)).alias("n"))
    sides = F.length(F.regexp_replace("run", r"[\x80-\xff]", ""))
    place = F.when(sides == 2, MID).when(sides == 1, EDGE).otherwise(ALONE)
    case = F.when(F.col("run").rlike("[a-z]") | (sides == 0), SMALL).otherwise(CAPITAL)
    high = F.split(F.regexp_replace("run", r"[\x00-\x7f]", ""), "")
    per_byte = (counted.select("file_path", "n", place.alias("place"), case.alias("case"),
                               F.explode(high).alias("byte"))
                .groupBy("file_path", "place", "case", "byte").agg(F.sum("n").alias("n")))
    scores = per_byte.join(F.broadcast(weights(spark)), ["place", "case", "byte"]).groupBy("file_path").agg(
        *(F.sum(F.col("n") * F.col(f"w{i}")).alias(f"s{i}") for i in range(len(CODECS))))
    return {r.file_path: {page: r[f"s{i}"] for i, page in enumerate(CODECS)} for r in scores.collect()}


def choose(default: str, scores: dict[str, float] | None) -> str:
    """The default page, or a legacy one that is likelier by more than ``PRIOR``."""
    if not scores:
        return default
    best = max((CP860, MAC_TURKISH), key=lambda page: scores.get(page, -inf))
    return best if scores[best] - PRIOR > scores[default] else default
