"""Token files (operator 4): length-delimited binary records with an index.

A record frames one document::

    length    u64 little-endian, bytes of the payload
    check     u32, masked crc32 of the eight length bytes
    payload   u8 (1: the document has an id), i64 doc_id, then the ids
    check     u32, masked crc32 of the payload
    end       one byte 0x0A

where masked(c) = rotate_right(c, 15) + 0xA282EAD8 mod 2**32. Documents are
range-partitioned by doc_id, so files in the order of their part numbers hold
ascending ids. Files
are written by Spark's own writer (rows of raw bytes whose end byte is the
line separator): task commits make a lost executor or a second attempt
harmless, and any file system that Spark can write works. The index is a
table of (file, part, ordinal, offset, length, ...) made from the finished
files, so that readers can visit records in any order: ``records_at`` cuts
the records that index rows name out of their files, and reads no others.

Edge cases: a null or empty text is the end id alone; null doc ids come
first; repeated rows are written each (rows of one id by a hash of the text,
equal rows in the order they were read, spread over files like any others);
an empty table gives no files' records and no rows; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memberscope.llm import token_ids
from memberscope.llm.common import ship, text_or_empty
from memberscope.session import scratch_path

#: Text bytes per file: a file is read back as one value, so it stays small.
FILE_TEXT_BYTES = 16 << 20
VOCABULARY = "byte_bpe_50k.json"
#: Files whose sums one task adds up.
FILES_TOGETHER = 4096
END_BYTE = b"\n"
HEAD = struct.Struct("<QI")
KEY = struct.Struct("<Bq")
CHECK = struct.Struct("<I")
RECORDS = ("file string, part long, ordinal long, offset long, length long, doc_id long, "
           "start_in_file long, n_tokens long, ids_crc32 long")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    payload = KEY.pack(doc_id is not None, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join([length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload)),
                     END_BYTE])


def unframe(data: memoryview, offset: int = 0):
    """(offset, length, doc_id, packed ids) of each record from ``offset``
    on; raises ValueError where a check fails or a record is cut short."""
    while offset < len(data):
        if offset + HEAD.size > len(data):
            raise ValueError(f"record head cut short at {offset}")
        n, check = HEAD.unpack_from(data, offset)
        if check != masked(data[offset:offset + 8]):
            raise ValueError(f"length check fails at {offset}")
        at = offset + HEAD.size
        size = HEAD.size + n + CHECK.size + len(END_BYTE)
        if offset + size > len(data):
            raise ValueError(f"record cut short at {offset}")
        payload = data[at:at + n]
        if CHECK.unpack_from(data, at + n)[0] != masked(payload):
            raise ValueError(f"payload check fails at {offset}")
        has, doc = KEY.unpack_from(payload)
        yield offset, size, doc if has else None, payload[KEY.size:]
        offset += size


def write_records(docs: DataFrame, path: str, vocab: str | None = None, end: int = 0,
                  file_text_bytes: int = FILE_TEXT_BYTES) -> None:
    """Encode every text and write the record files below ``path``."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    total = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    files = max(1, math.ceil(total / file_text_bytes))

    def run(batches):
        path_ = vocab or public_tokenizers.path(VOCABULARY)  # where the worker has it
        encode, dtype = token_ids.encoder(path_), token_ids.id_dtype(path_)
        tail = np.array([end], dtype).tobytes()
        for batch in batches:
            # the writer adds the end byte as its line separator
            frames = [frame(d, encode(t) + tail)[:-1] for d, t in
                      zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["record"])

    # the row number keeps equal rows from meeting in one file
    (docs.repartitionByRange(files, "doc_id", F.xxhash64("text"), "row")
     .sortWithinPartitions("doc_id", F.xxhash64("text"), "row")
     .mapInArrow(run, "record binary")
     .select(F.col("record").cast("string"))
     .write.option("lineSep", END_BYTE.decode()).text(path))


def part_number(file: Column) -> Column:
    """The number in a part file's name: names are padded to five digits, so
    their order as texts is wrong from the hundred thousandth file on."""
    return F.regexp_extract(file, "^part-([0-9]+)", 1).cast("long")


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def read_records(spark: SparkSession, path: str, vocab: str | None = None) -> DataFrame:
    """Every record of the files, both checks verified, with its place and a
    digest of its ids (unsigned crc32 of little-endian 32-bit ids)."""
    ship(spark)

    def run(batches):
        dtype = token_ids.id_dtype(vocab or public_tokenizers.path(VOCABULARY))
        for batch in batches:
            for name, part, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           batch.column(2)):
                rows, start = [], 0
                data = memoryview(content.as_buffer())
                for k, (offset, size, doc, packed) in enumerate(unframe(data)):
                    ids = np.frombuffer(packed, dtype)
                    rows.append((name, part, k, offset, size, doc, start, len(ids),
                                 zlib.crc32(ids.astype("<u4"))))
                    start += len(ids)
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(SCHEMA.names, r)) for r in rows], schema=SCHEMA)

    return _files(spark, path).select("file", part_number(F.col("file")).alias("part"), "content").mapInArrow(
        run, RECORDS)


SCHEMA = pa.schema([("file", pa.string())] + [
    (c, pa.int64()) for c in ("part", "ordinal", "offset", "length", "doc_id", "start_in_file",
                              "n_tokens", "ids_crc32")])


def build_index(spark: SparkSession, path: str, index_path: str, vocab: str | None = None) -> DataFrame:
    """Write the offset index of the files below ``path`` and read it."""
    read_records(spark, path, vocab).write.parquet(index_path)
    return spark.read.schema(RECORDS).parquet(index_path)


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index with ``place``, a seeded random visiting order."""
    return index.withColumn("place", F.xxhash64("file", "offset", F.lit(seed))).orderBy(
        "place", "file", "offset")


def records_at(spark: SparkSession, path: str, picks: DataFrame, vocab: str | None = None) -> DataFrame:
    """The records that ``picks`` (index rows: file, offset, length, any
    others) name, with doc_id and ids (array) decoded from them. Each is cut
    out of its file at its offset; both its checks are verified."""
    ship(spark)
    others = [c for c in picks.columns if c not in ("doc_id", "ids")]
    cut = _files(spark, path).join(picks.select(*others), "file").select(
        *others, F.substring("content", F.col("offset").cast("int") + 1, F.col("length").cast("int")).alias("record"))

    def run(batches):
        dtype = token_ids.id_dtype(vocab or public_tokenizers.path(VOCABULARY))
        for batch in batches:
            found = [next(unframe(memoryview(r.as_buffer())))[2:] for r in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([d for d, _ in found], pa.int64()),
                 pa.array([np.frombuffer(i, dtype).astype(np.int64) for _, i in found], pa.list_(pa.int64()))],
                names=[*others, "doc_id", "ids"])

    schema = T.StructType([picks.schema[c] for c in others]).add("doc_id", "long").add(
        "ids", T.ArrayType(T.LongType()))
    return cut.mapInArrow(run, schema)


def with_starts(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32.
    Files are summed in blocks of ``FILES_TOGETHER``, each block in a task of
    its own; one window runs over the blocks."""
    def before(*by: str):
        return Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "block", F.floor(F.col("part") / FILES_TOGETHER))
    blocks = files.groupBy("block").agg(F.sum("n").alias("n"), F.min("part").alias("part"))
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(before()), F.lit(0)).alias("base"))
    inside = files.select("part", "block", F.coalesce(F.sum("n").over(before("block")), F.lit(0)).alias("inner"))
    base = inside.join(blocks, "block").select("part", (F.col("base") + F.col("inner")).alias("base"))
    return index.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str | None = None, vocab: str | None = None) -> DataFrame:
    """Write the files and their index below ``path`` (by default a new
    folder in ``spark.checkpoint.dir``); the per-document digest is read back
    from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    write_records(docs, f"{path}/data", vocab)
    return with_starts(build_index(spark, f"{path}/data", f"{path}/index", vocab))
