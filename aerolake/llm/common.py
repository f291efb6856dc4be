"""Helpers shared by the operators: tables, materialised intermediates, shared files.

Conventions that all operators keep:

* An operator first selects the columns it needs under its own names, so extra
  columns of the input, whatever they are called, never clash with its own.
* A null text counts as the empty text, unless the operator's docstring says
  otherwise. A row is identified by (id, text digest): repeated rows are copies.
* Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading
  it again, so a lost executor costs the tasks it ran and nothing more.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import aerolake
from aerolake.session import default_parallelism, scratch_dir

#: Rows and bytes of an Arrow batch: a batch of long texts must fit a Python worker.
ARROW_ROWS = 512
ARROW_BYTES = 4 << 20
#: Keys that are broadcast rather than exchanged, at most (some 100 bytes each).
BROADCAST_KEYS = 1 << 16
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Ready a session for the operators' Python functions.

    Lowers the Arrow batch limits so that whole texts fit a worker, and ships the
    package to the executors, once an application, so that workers can import it
    wherever they run.
    """
    for conf, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = spark.conf.get(conf)
        if not now.isdigit() or not 0 < int(now) <= most:  # "64m" is above either bound
            spark.conf.set(conf, str(most))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(aerolake.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    folder = scratch_dir(spark, "code")
    files, base = filesystem(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/aerolake.zip") as out:
        out.write(packed.getvalue())
    context.addPyFile(f"{folder}/aerolake.zip")
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, tag: str, few: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    ``few``: its short rows are known to be some multiple of ``BROADCAST_KEYS`` at most,
    so a task for each core writes them, however many partitions exchanges have.
    """
    spark = df.sparkSession
    if few:
        df = df.coalesce(default_parallelism(spark))
    path = scratch_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(keyed: DataFrame) -> DataFrame:
    """A stored table of short rows as the right side of a join: broadcast if it has few
    rows, so the other side stays where it is; exchanged like any other beyond the bound."""
    return F.broadcast(keyed) if keyed.count() <= BROADCAST_KEYS else keyed


def text_digest(text) -> F.Column:
    """16-byte content address of a text column (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def texts_of(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``key``, text: one text of ``rows`` for each of ``keys``, a stored table of distinct keys.

    Rows of one key have one text. Few keys are broadcast, so texts of no key stay where
    they are. Copies collapse in their task before the exchange, which a key leaves with
    at most one row a task; beyond the bound the keys meet what is left, dealt alike.
    """
    texts = rows.select(key, "text")
    few = keys.count() <= BROADCAST_KEYS
    if few:
        texts = texts.join(F.broadcast(keys), key, "left_semi")
    texts = texts.groupBy(key).agg(F.first("text").alias("text"))
    return texts if few else texts.join(keys.hint("merge"), key, "left_semi")


def filesystem(uri: str):
    """(pyarrow file system, path) of a shared folder; executors call this too."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    if parsed.scheme in ("s3a", "s3n"):
        uri = "s3" + uri[len(parsed.scheme):]
    return fs.FileSystem.from_uri(uri)


def masked_crc(data: bytes) -> int:
    """CRC-32 of ``data``, rotated and offset so a checksum of checksums stays strong."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def coalesce_ranges(
    spans: Iterable[tuple], max_gap: int, max_bytes: int
) -> Iterator[tuple[str, int, int, list]]:
    """Merge (file, offset, length, extra) spans, sorted by file and offset, into reads.

    Yields (file, start, end, spans). Two spans share a read when they are in one
    file, at most ``max_gap`` bytes apart, and the read stays below ``max_bytes``;
    a longer single span is a read of its own.
    """
    group: list = []
    name, start, end = None, 0, 0
    for span in spans:
        f, offset, length = span[0], span[1], span[2]
        if group and f == name and offset - end <= max_gap and offset + length - start <= max_bytes:
            group.append(span)
            end = max(end, offset + length)
            continue
        if group:
            yield name, start, end, group
        group, name, start, end = [span], f, offset, offset + length
    if group:
        yield name, start, end, group


def in_read_order(index: DataFrame, task_bytes: int = 32 << 20) -> DataFrame:
    """Rows of an index (file, offset, length, ...) in ranges of near records, sorted.

    Partitions hold about ``task_bytes`` of records, fewer where the session has cores
    to spare; a file's records stay together but at a border of two partitions.
    """
    size = index.agg(F.sum("length").alias("n")).first()["n"] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-size // task_bytes), min(2 * cores, -(-size // (1 << 20))), 1)
    return (index.repartitionByRange(parts, "file", "offset")
            .sortWithinPartitions("file", "offset"))


def read_spans(
    root: str, spans: Iterable[tuple], max_gap: int, max_bytes: int
) -> Iterator[tuple[tuple, bytes]]:
    """(span, its bytes) for each span, by coalesced sorted byte-range reads."""
    files, base = filesystem(root)
    opened, handle = None, None
    try:
        for name, start, end, group in coalesce_ranges(spans, max_gap, max_bytes):
            if name != opened:
                if handle is not None:
                    handle.close()
                handle, opened = files.open_input_file(f"{base}/{name}"), name
            data = handle.read_at(end - start, start)
            if len(data) != end - start:
                raise OSError(f"{name}: {end - start} bytes at {start}, got {len(data)}")
            for span in group:
                at = span[1] - start
                yield span, data[at:at + span[2]]
    finally:
        if handle is not None:
            handle.close()
