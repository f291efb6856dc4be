"""Secret scans over an incremental ledger of content-addressed blobs.

Every historical version of a path is a blob, addressed by the SHA-256 of its text.
The ledger is a Parquet table below a shared folder with one row for each blob and
rule version that was scanned, with all spans found. A scan takes only pairs of blob
and rule version that the ledger lacks, whatever paths they are found at, and spans
are joined back to all paths that have the blob.

A ledger row is complete in itself: whatever part of an interrupted run was committed
stays valid, and the next run scans the blobs that are still missing. One scan at a
time may write to a ledger.

Rules: three base kinds (assign, access, hex) and further ones (private keys, signed
web tokens, credentials in URLs, tokens with well-known prefixes). Matches of a kind
are leftmost and don't overlap. Spans count code points, the end is exclusive.

Nulls, empties, repeats: a null text is empty and has no findings; equal texts are
scanned once and reported for every row; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare, texts_of
from aerolake.session import scratch_dir

# Patterns of the three base kinds and their least lengths.
BASE = ("assign", "access", "hex")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 8
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 16
HEX = r"[0-9a-f]+"
HEX_LENGTH = 32

#: Added kinds: pattern and flags.
ADDED = {
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----BEGIN )[\s\S])*?"
                    r"-----END [A-Z ]*PRIVATE KEY-----"),
    "web_token": r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "url_login": r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{3,100}@[A-Za-z0-9.-]+",
    "prefixed": (r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                 r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})"),
}
KINDS = (*BASE, *ADDED)


def rule_version() -> str:
    """Changes whenever a rule does."""
    rules = repr((ASSIGN, ASSIGN_LENGTH, ACCESS, ACCESS_LENGTH, HEX, HEX_LENGTH, ADDED))
    return hashlib.sha256(rules.encode()).hexdigest()[:16]


_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
# A run of the class is matched whole or not at all, so its least length can stand in
# the pattern; for assign a short match must still use up its text.
_access = re.compile(f"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}")
_hex = re.compile(f"[0-9a-f]{{{HEX_LENGTH},}}")
_added = {kind: re.compile(pattern, re.ASCII) for kind, pattern in ADDED.items()}
_hints = {"private_key": "PRIVATE KEY", "web_token": "eyJ", "url_login": "://"}


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets, by start, then kind as listed."""
    out = [("assign", *m.span()) for m in _assign.finditer(text)
           if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _access.finditer(text)]
    out += [("hex", *m.span()) for m in _hex.finditer(text)]
    for kind, pattern in _added.items():
        if _hints.get(kind, "") in text:
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SCANS = "blob string, rules string, spans array<struct<kind: string, start: int, end: int>>"


def blob_id(text) -> F.Column:
    """Content address of a text column (null counts as empty)."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_blobs(blobs: DataFrame, rules: str) -> DataFrame:
    """A ledger row for each of ``blobs`` (blob, text)."""
    prepare(blobs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                   ("end", pa.int32())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t.as_py() or "")]
                     for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), pa.array([rules] * len(spans), pa.string()),
                 pa.array(spans, span)], names=["blob", "rules", "spans"])

    return blobs.select("blob", "text").mapInArrow(run, SCANS)


class Ledger:
    """What has been scanned, in a Parquet table below a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root}/scans"

    def rows(self, rules: str | None = None) -> DataFrame:
        """blob, spans of every blob scanned under a rule version (default: today's)."""
        try:
            table = self.spark.read.schema(SCANS).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            table = self.spark.createDataFrame([], SCANS)
        return table.where(F.col("rules") == (rules or rule_version())).select("blob", "spans")

    def scan(self, versions: DataFrame, text_col: str = "text") -> None:
        """Scan the blobs of ``versions`` that are new under today's rules.

        The ledger is asked by blob alone; then one text of each new blob is fetched, with
        copies collapsed in their task, and scanned once. Without a new blob no text moves.
        """
        text = F.coalesce(F.col(text_col), F.lit(""))
        blobs = versions.select(blob_id(F.col(text_col)).alias("blob"), text.alias("text"))
        new = materialise(blobs.select("blob").distinct()
                          .join(self.rows().select("blob"), "blob", "left_anti"), "new-blobs")
        scan_blobs(texts_of(blobs, new, "blob"), rule_version()).write.mode("append").parquet(self.path)

    def report(self, versions: DataFrame, path_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
        """path, blob, spans of every row of ``versions``, joined back by blob.

        Both sides are exchanged, so a blob with very many paths is split at run time.
        """
        paths = versions.select(F.col(path_col).alias("path"),
                                blob_id(F.col(text_col)).alias("blob"))
        return paths.join(self.rows(), "blob", "left").select("path", "blob", "spans")


def summary(spans) -> dict[str, F.Column]:
    """Counts and digests of a column of spans."""
    written = lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return {
        "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
        "base_sha256": F.sha2(F.array_join(F.transform(base, written), ",").cast("binary"), 256),
        "spans": F.array_join(F.transform(spans, written), ","),
    }


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   ledger: Ledger | None = None) -> DataFrame:
    """Scan what is new and report doc_id, blob, counts and spans of every document."""
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, scratch_dir(spark, "secret-ledger"))
    ledger.scan(docs, text_col)
    return ledger.report(docs, id_col, text_col).select(
        F.col("path").alias("doc_id"), "blob",
        *(c.alias(k) for k, c in summary(F.col("spans")).items()))
