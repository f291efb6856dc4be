"""WARC archives with an index, and coalesced range reads of selected records.

Each record is a gzip member of its own, as usual for ``.warc.gz`` files, so any
record can be read by its byte range. Index first: the writer reports offset,
length, URL and digest of every record in a Parquet index that Spark commits; a
read selects rows of the index, sorts them by file and offset, and merges near
ranges into few reads.

Deduplication is decided on (digest, bytes) before anything is written: of equal
payloads of at least ``min_bytes``, the record with the largest id is the response
and the others are revisits that carry headers only.

Writers name their files by attempt; only files of committed attempts are in the
index. Nulls, empties, ties, repeats: a null payload is empty; a null URL is an
empty header; rows with equal ids are records of their own, of which, among equal
payloads, exactly one is the response; an empty table gives an empty index.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.common import filesystem, in_read_order, materialise, prepare, read_spans
from aerolake.session import scratch_dir

#: Payloads shorter than this are never revisits.
MIN_REVISIT_BYTES = 1000
#: Bytes of an archive after which the task starts the next one.
ARCHIVE_BYTES = 64 << 20
#: A read of near records: the widest gap to read over, and its most bytes.
READ_GAP, READ_BYTES = 64 << 10, 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()),
])

RECORD = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
])


def _header(text: str) -> str:
    """A header value: no line breaks, percent-encoded where there were some."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unheader(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str,
                 refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit's payload is not written."""
    import base64

    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{sha1}",
             f"X-Payload-Length: {size}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if is_revisit:
        lines += [f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>",
                  f"WARC-Profile: {PROFILE}"]
        payload = b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one gzip member; raises if the record is damaged."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                   for line in lines)
    n = int(headers["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("damaged record block")
    return headers, rest[:n]


def shared_payloads(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """digest, bytes and the largest id of payloads that occur more than once.

    ``pages``: page_id, digest, bytes. The groups are aggregated map-side first; the
    table is materialised, so that its join with the pages exchanges both sides and a
    hot payload is split at run time.
    """
    return materialise(
        pages.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "bytes", "last"), "warc-shared")


def write_archives(pages: DataFrame, root: str, min_bytes: int = MIN_REVISIT_BYTES,
                   id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> DataFrame:
    """Write one record per row below ``root``; return the index.

    Rows that tie for the largest id of their payload are all responses.
    """
    spark = pages.sparkSession
    prepare(spark)
    files, base = filesystem(root)
    files.create_dir(base, recursive=True)
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    keys = [F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("digest"),
            F.octet_length(payload).cast("long").alias("bytes")]
    shared = shared_payloads(pages.select(*keys), min_bytes)
    rows = (pages.select(*keys, F.col(url_col).alias("url"), payload.alias("payload"))
            .join(shared, ["digest", "bytes"], "left")
            .select("page_id", "digest", "bytes", "url", "payload",
                    F.col("last").alias("refers_to"),
                    (F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")))
                    .alias("is_revisit")))

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                 pa.string()]
        fs, folder = filesystem(root)
        task, shard, out, at = uuid.uuid4().hex, -1, None, 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    record = record_bytes(row["page_id"], row["url"], row["payload"],
                                          row["bytes"], row["digest"], row["refers_to"],
                                          row["is_revisit"])
                    if out is None or at and at + len(record) > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        shard, at = shard + 1, 0
                        name = f"pages-{task}-{shard:05d}.warc.gz"
                        # The records are compressed already.
                        out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    out.write(record)
                    index.append((name, at, len(record), row["page_id"], row["url"],
                                  row["digest"], "revisit" if row["is_revisit"] else "response"))
                    at += len(record)
                cols = list(zip(*index)) or [[] for _ in types]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)], names=INDEX.names)
        finally:
            if out is not None:
                out.close()

    return materialise(rows.mapInArrow(write, INDEX), "warc-index")


def read_archives(index: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """Read the records that ``index`` (any selection of its rows) points at.

    Returns the fields of each record, and with ``payloads`` its payload (null for a
    revisit). A response whose bytes or digest differ from its headers raises.
    """
    schema = T.StructType([*RECORD.fields, *([T.StructField("payload", T.BinaryType())]
                                             if payloads else [])])

    def read(batches: Iterator) -> Iterator:
        import base64
        import hashlib

        import pyarrow as pa

        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                 *([pa.binary()] if payloads else [])]
        page = re.compile("<urn:page:(-?[0-9]+|null)>")

        def number(text):
            found = page.fullmatch(text)[1]
            return None if found == "null" else int(found)

        def spans():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(3)))

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        out, size = [], 0
        for span, member in read_spans(root, spans(), READ_GAP, READ_BYTES):
            headers, payload = parse_record(member)
            digest = base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex()
            n, kind = int(headers["X-Payload-Length"]), headers["WARC-Type"]
            if kind == "response" and (n, digest) != (len(payload),
                                                      hashlib.sha1(payload).hexdigest()):
                raise ValueError(f"{span[0]}: damaged payload at {span[1]}")
            url = headers.get("WARC-Target-URI")
            row = (number(headers["WARC-Record-ID"]), None if url is None else _unheader(url),
                   n, digest, kind,
                   number(headers["WARC-Refers-To"]) if kind == "revisit" else None)
            out.append((*row, payload if kind == "response" else None) if payloads else row)
            size += 256 + (len(payload) if payloads else 0)
            if size > READ_BYTES:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    return in_read_order(index.select("file", "offset", "length")).mapInArrow(read, schema)


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Write all pages as archives and read them back, without payloads."""
    root = scratch_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, root, **options), root, payloads=False)
