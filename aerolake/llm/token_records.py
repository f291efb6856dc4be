"""Token-ID output as length-delimited binary records with a separate offset index.

A shard file is a sequence of frames, one per document, in ascending document order:

    uint64 length | uint32 masked checksum of the length |
    payload       | uint32 masked checksum of the payload        (little-endian)

The payload is the document's token ids, two bytes each when the vocabulary has at
most 65,536 ids and four otherwise. The index is a Parquet table with one row per
frame: shard file, byte offset and length of the frame, document id, first token's
position and token count, so a shuffled reader can fetch any set of frames.

Tasks write shard files under names that are unique to the attempt and report them
through the index; the index is committed by Spark, so files of a lost or repeated
attempt are never referenced.

Nulls, empty texts, ties, repeated rows: a null text is empty and has the end id
alone; rows are ordered by (doc_id nulls first, digest of the text), so equal
rows are neighbours and each has its own frame; an empty table gives an empty index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.chunk_encoder import ChunkEncoder
from aerolake.llm.common import (
    filesystem, in_read_order, masked_crc, materialise, prepare, read_spans,
)
from aerolake.session import scratch_dir

#: Bytes of a shard after which the task starts the next one.
SHARD_BYTES = 64 << 20
#: A read of adjacent frames: the widest gap to read over, and its most bytes.
READ_GAP, READ_BYTES = 64 << 10, 4 << 20
#: Texts' bytes for each task that writes.
TASK_BYTES = 32 << 20
#: Characters encoded at once, whose distinct parts are encoded once.
ENCODE_CHARS = 1 << 20

INDEX = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("first", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
])
FRAME_HEAD = struct.Struct("<QI")
FRAME_TAIL = struct.Struct("<I")


def frame(payload: bytes) -> bytes:
    """One length-delimited record."""
    head = struct.pack("<Q", len(payload))
    return b"".join((head, FRAME_TAIL.pack(masked_crc(head)), payload,
                     FRAME_TAIL.pack(masked_crc(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of a record; raises if a length or checksum is wrong."""
    length, crc = FRAME_HEAD.unpack_from(record)
    if crc != masked_crc(record[:8]) or len(record) != length + 16:
        raise ValueError("damaged record length")
    payload = record[12:12 + length]
    if FRAME_TAIL.unpack_from(record, 12 + length)[0] != masked_crc(payload):
        raise ValueError("damaged record payload")
    return payload


def _traits(tokenizer_path: str) -> tuple[bool, bool]:
    """Whether the tokenizer drops white space and marks word ends, as ChunkEncoder needs,
    and whether it lower-cases."""
    import json

    with open(tokenizer_path) as f:
        spec = json.load(f)
    return (spec["model"].get("end_of_word_suffix") == "</w>"
            and "Removed" in json.dumps(spec.get("pre_tokenizer"))
            and all(" " not in t["content"] and not t["lstrip"] and not t["rstrip"]
                    for t in spec.get("added_tokens", [])),
            "Lowercase" in json.dumps(spec.get("normalizer")))


_encoders: dict[str, tuple] = {}


def text_encoder(tokenizer_path: str):
    """(function from texts to ids as bytes, width of an id), one for each worker process."""
    import numpy as np
    from tokenizers import Tokenizer

    if tokenizer_path not in _encoders:
        tokenizer = Tokenizer.from_file(tokenizer_path)
        width = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        splits, lower = _traits(tokenizer_path)
        if splits:
            encode = ChunkEncoder(tokenizer, width, lower=lower).encode
        else:
            def encode(texts):
                return [np.asarray(e.ids, dtype=width).tobytes() for e in
                        tokenizer.encode_batch_fast([t or "" for t in texts],
                                                    add_special_tokens=False)]
        _encoders[tokenizer_path] = encode, width
    return _encoders[tokenizer_path]


class _Writer:
    """Shard files of one task attempt."""

    def __init__(self, root: str, part: int):
        self.files, self.base = filesystem(root)
        self.name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        self.shard, self.out, self.offset = -1, None, 0

    def add(self, record: bytes) -> tuple[int, str, int]:
        if self.out is None or self.offset + len(record) > SHARD_BYTES and self.offset:
            self.close()
            self.shard, self.offset = self.shard + 1, 0
            self.out = self.files.open_output_stream(f"{self.base}/{self.path()}")
        at = self.offset
        self.out.write(record)
        self.offset += len(record)
        return self.shard, self.path(), at

    def path(self) -> str:
        return f"{self.name}-{self.shard:04d}.rec"

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_records(docs: DataFrame, tokenizer_path: str, root: str, end_id: int = 2,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all texts, write the shards below ``root`` and return the index.

    One range partitioning by (id, digest) gives the global order; token positions
    come from running counts in each part plus the totals of the parts before.
    """
    spark = docs.sparkSession
    prepare(spark)
    files, base = filesystem(root)
    files.create_dir(base, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-int(size) // TASK_BYTES))
    ordered = (rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "digest")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "digest")
               .select("doc_id", "text"))

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from aerolake.llm.textops import chunks

        encode, width = text_encoder(tokenizer_path)
        end = np.asarray([end_id], dtype=width).tobytes()
        part = TaskContext.get().partitionId()
        writer, first = _Writer(root, part), 0
        schema = pa.schema([
            ("part", pa.int32()), ("shard", pa.int32()), ("file", pa.string()),
            ("offset", pa.int64()), ("length", pa.int64()), ("doc_id", pa.int64()),
            ("first", pa.int64()), ("n_tokens", pa.int64())])
        try:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                out = []
                for a, b in chunks(texts, ENCODE_CHARS):
                    for doc, payload in zip(ids[a:b], encode(texts[a:b])):
                        record = frame(payload + end)
                        shard, name, at = writer.add(record)
                        n = len(payload + end) // len(end)
                        out.append((part, shard, name, at, len(record), doc, first, n))
                        first += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*out), schema)]
                    if out else [pa.array([], t.type) for t in schema], schema=schema)
        finally:
            writer.close()

    index = materialise(ordered.mapInArrow(write, INDEX), "token-index")
    # One row per part, of which there is one per TASK_BYTES of text.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (index.join(totals, "part")
            .select("file", "part", "shard", "offset", "length", "doc_id",
                    (F.col("base") + F.col("first")).alias("start"), "n_tokens"))


READ = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def read_records(index: DataFrame, root: str, digest_only: bool = False,
                 width: str = "<u2") -> DataFrame:
    """Read the indexed frames back, by coalesced byte ranges of each shard.

    ``index`` may be any selection of the index's rows. Returns doc_id, start,
    n_tokens, ids_crc32 (of the ids as 32-bit little-endian integers) and, unless
    ``digest_only``, the ids. Checksums are verified and a count that differs from
    the index raises.
    """
    schema = READ if digest_only else T.StructType(
        [*READ.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        types = [pa.int64()] * 4 + ([] if digest_only else [pa.list_(pa.int32())])

        def spans():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(6)))

        def batch(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=[f.name for f in schema])

        out, size = [], 0
        for span, record in read_spans(root, spans(), READ_GAP, READ_BYTES):
            ids = np.frombuffer(unframe(record), dtype=width)
            if len(ids) != span[5]:
                raise ValueError(f"{span[0]}: {len(ids)} ids at {span[1]}, not {span[5]}")
            row = (span[3], span[4], len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
            out.append(row if digest_only else (*row, ids.astype("<i4")))
            size += 64 if digest_only else 4 * len(ids)
            if size > READ_BYTES:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    cols = index.select("file", "offset", "length", "doc_id", "start", "n_tokens")
    return in_read_order(cols).mapInArrow(read, schema)


def encode_to_records(docs: DataFrame, tokenizer_path: str, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents as records and read back doc_id, start, n_tokens, ids_crc32."""
    root = scratch_dir(docs.sparkSession, "token-records")
    index = write_records(docs, tokenizer_path, root, end_id, id_col, text_col)
    return read_records(index, root, digest_only=True, width=id_width(tokenizer_path))


def id_width(tokenizer_path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
