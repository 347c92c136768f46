"""Token-id files: one zstandard frame per document, one shared dictionary.

A file is a run of blocks, each followed by a line feed::

    b"TKZ1" | u32 index bytes | u64 data bytes | 32-byte SHA-256 of the dictionary | index | data

The index has one entry per document: i64 doc_id, u8 null flag, u64 start
(ids before it in its part), u32 ids, u64 offset and u32 length of its frame in
data. ``read_document`` decompresses a single frame. Ids are unsigned 32-bit
little-endian. The dictionary is written beside the blocks.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.llm.common import Scratch
from docloom.llm.tokens import default_tokenizer, encoder

MAGIC = b"TKZ1"
HEAD = struct.Struct("<4sIQ32s")
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("start", "<u8"), ("n", "<u4"), ("offset", "<u8"), ("length", "<u4")])
#: Documents and compressed bytes of a block, blocks of a file.
BLOCK_DOCS, BLOCK_BYTES, FILE_BLOCKS = 4_096, 4 << 20, 4
#: Ranges of ids for each input partition: a task sorts only so much text at once.
RANGES = 4
#: The dictionary is trained on at most this many documents of at most this many ids each.
SAMPLE_DOCS, SAMPLE_IDS, DICT_BYTES = 1_000, 2_000, 64 << 10
LEVEL = 3
END_ID = 0


def train_dictionary(docs: DataFrame, text: str, tokenizer: str) -> bytes:
    """A zstandard dictionary of serialized id arrays, from a bounded sample of documents.

    The sample is the distinct texts with the smallest hashes, so reruns agree,
    and of a long text a window at a hashed place. Samples too few or too
    uniform for training are used as raw content.
    """
    hashed = docs.select(F.xxhash64(text).alias("h"), F.col(text).alias("t")).where("t IS NOT NULL AND t <> ''")
    lowest = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).collect()]
    window = 4 * SAMPLE_IDS
    start = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length("t") - window + 1)).cast("int") + 1
    chosen = (
        hashed.where(F.col("h") <= (lowest[-1] if lowest else 0))
        .select("h", F.substring("t", start, F.lit(window)).alias("t"))
        .dropDuplicates(["h"])
        .orderBy("h")
    )
    encode = encoder(tokenizer).encode
    samples = [encode(r["t"])[: 4 * SAMPLE_IDS] for r in chosen.collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(content)


def pack_block(rows: list[tuple[int | None, int, bytes]], compressor: zstandard.ZstdCompressor, digest: bytes) -> bytes:
    """One block from ``(doc_id, start, frame source ids)``."""
    index, frames, offset = np.zeros(len(rows), INDEX), [], 0
    for k, (doc_id, start, ids) in enumerate(rows):
        frame = compressor.compress(ids)
        index[k] = (doc_id or 0, doc_id is None, start, len(ids) // 4, offset, len(frame))
        frames.append(frame)
        offset += len(frame)
    table = index.tobytes()
    return HEAD.pack(MAGIC, len(table), offset, digest) + table + b"".join(frames)


def blocks_of(content: bytes) -> Iterator[tuple[bytes, np.ndarray, memoryview]]:
    """``(dictionary digest, index, data)`` of each block of a file."""
    view, at = memoryview(content), 0
    while at < len(view):
        magic, n_index, n_data, digest = HEAD.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEAD.size
        index = np.frombuffer(view[at : at + n_index], INDEX)
        yield digest, index, view[at + n_index : at + n_index + n_data]
        at += n_index + n_data + 1


def read_document(content: bytes, dictionary: bytes, doc_id: int) -> np.ndarray | None:
    """The ids of one document of a file, decompressing only its frame."""
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    for digest, index, data in blocks_of(content):
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("another dictionary is needed")
        for row in index[(index["doc_id"] == doc_id) & (index["null"] == 0)]:
            frame = data[int(row["offset"]) : int(row["offset"]) + int(row["length"])]
            return np.frombuffer(reader.decompress(frame), "<u4")
    return None


def write_ids(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode ``docs`` in ascending doc_id order to files under ``path``; returns the part totals ``(part, n)``.

    Texts are range-partitioned by id once and encoded once. A null text is
    empty, a null id comes first, repeated ids follow each other by text.
    File names sort in the order of the ids.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    dictionary = train_dictionary(docs, text, tokenizer)
    spark.createDataFrame([(dictionary,)], "content binary").write.parquet(f"{path}/dictionary")
    sent = spark.sparkContext.broadcast(dictionary)
    schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("n", pa.int64()), ("value", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        content = sent.value
        digest, part = hashlib.sha256(content).digest(), TaskContext.get().partitionId()
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(content))
        to_ids = encoder(tokenizer).encode_batch
        rows, held, start, first = [], 0, 0, 0

        def block() -> pa.RecordBatch:
            value = pack_block(rows, compressor, digest)
            return pa.RecordBatch.from_pylist([{"part": part, "first": first, "n": start - first, "value": value}], schema)

        for batch in batches:
            texts = (body.as_py() for body in batch.column(1))
            for key, ids in zip(batch.column(0).to_pylist(), to_ids(texts)):
                ids += end
                rows.append((key, start, ids))
                start += len(ids) // 4
                held += len(ids)
                if len(rows) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield block()
                    rows, held, first = [], 0, start
        if rows:
            yield block()

    cores = spark.sparkContext.defaultParallelism
    pieces = RANGES * max(cores, docs.rdd.getNumPartitions())
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(pieces, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    blocks = ordered.mapInArrow(encode, "part int, first long, n long, value binary")
    (
        blocks.select(F.col("value").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", FILE_BLOCKS)
        .text(f"{path}/blocks")
    )
    return _part_totals(spark, path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    # Spark's writer numbers files by task, then by file of the task.
    name = F.element_at(F.split("path", "/"), -1)
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/blocks")
        .select(
            F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("part"),
            "content",
        )
    )


def _part_totals(spark: SparkSession, path: str) -> DataFrame:
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                n = sum(int(index["n"].sum()) for _, index, _ in blocks_of(content.as_py()))
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int64())})

    return _files(spark, path).mapInArrow(total, "part int, n long").groupBy("part").agg(F.sum("n").alias("n"))


def read_ids(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)`` from the files, checked against the dictionary hash.

    ``start`` counts the ids of all documents before: the totals of the parts
    before (one number per write task) plus the start kept in the index.
    """
    totals = sorted((r["part"], r["n"]) for r in _part_totals(spark, path).collect())
    base, before = {}, 0
    for part, n in totals:
        base[part], before = before, before + n
    stored = spark.read.parquet(f"{path}/dictionary").first()
    sent = spark.sparkContext.broadcast((stored["content"], base))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())
    ])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, bases = sent.value
        wanted = hashlib.sha256(dictionary).digest()
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for part, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for digest, index, data in blocks_of(content.as_py()):
                    if digest != wanted:
                        raise ValueError("a block was written with another dictionary")
                    rows = []
                    for r in index.tolist():
                        key, null, start, n, offset, length = r
                        raw = reader.decompress(data[offset : offset + length])
                        if len(raw) != 4 * n:
                            raise ValueError(f"document {key} has {len(raw)} bytes for {n} ids")
                        rows.append({
                            "doc_id": None if null else key, "start": bases[part] + start, "n_tokens": n,
                            "ids_crc32": zlib.crc32(raw), "ids": raw if ids else None,
                        })
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return _files(spark, path).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """Write ``docs`` as id files in the shared folder and read them back.

    An empty table writes no block and gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "ids")
    write_ids(docs, scratch.path, doc_id, text, tokenizer)
    return read_ids(docs.sparkSession, scratch.path, ids)
