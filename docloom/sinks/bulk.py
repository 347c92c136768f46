"""Bulk request files as a Spark data source: ``write_bulk`` and ``read_bulk``.

Each task writes one part, cut into request bodies, and an index of them; its commit
message carries only counts. The commit of the job removes what failed or
repeated attempts left, and writes the manifest, which names the parts that count.
Files are opened through ``pyarrow.fs``, so a path may be local or a URI.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docloom.operators.documents import BATCH_BYTES, BATCH_DOCS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "docloom_bulk"
MANIFEST = "manifest.json"
COUNTS = ("n_docs", "n_bytes", "n_batches")

# Bytes of request bodies that a task reads.
TASK_BYTES = 64 * 1024 * 1024


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path in it."""
    if path.startswith("file:/"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class PartWritten(WriterCommitMessage):
    """What one task wrote: names within the folder, and counts."""

    name: str
    n_docs: int
    n_bytes: int
    n_batches: int


def cut(values: pa.Array, docs: int, size: int, max_docs: int, max_bytes: int) -> Iterator[tuple[int, int, int, bool]]:
    """``(low, high, bytes, closed)`` stretches of lines, continuing a batch of ``docs`` lines and ``size`` bytes.

    A batch is closed at ``max_docs`` lines or once it holds ``max_bytes``.
    """
    total = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False))])
    low = 0
    while low < len(values):
        full = int(np.searchsorted(total, total[low] + max_bytes - size))
        high = min(max(full, low + 1), low + max_docs - docs, len(values))
        held = int(total[high] - total[low])
        docs, size = docs + high - low, size + held
        closed = docs >= max_docs or size >= max_bytes
        yield low, high, held, closed
        if closed:
            docs = size = 0
        low = high


class BulkWriter(DataSourceArrowWriter):
    def __init__(self, path: str, max_docs: int, max_bytes: int) -> None:
        self.path, self.max_docs, self.max_bytes = path.rstrip("/"), max_docs, max_bytes
        self.folder = f"{self.path}/parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartWritten:
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        system, folder = opened(self.folder)
        system.create_dir(folder)
        done = PartWritten(name, 0, 0, 0)
        docs = size = 0
        with system.open_output_stream(f"{folder}/{name}.bulk") as out, system.open_output_stream(f"{folder}/{name}.json") as index:

            def close() -> None:
                nonlocal docs, size
                entry = {"part": name, "batch": done.n_batches, "start": done.n_bytes - size, "n_docs": docs, "n_bytes": size}
                index.write((json.dumps(entry) + "\n").encode())
                done.n_batches += 1
                docs = size = 0

            for batch in iterator:
                values = batch.column("value").drop_null().cast(pa.large_binary())
                if not len(values):
                    continue
                values = pa.concat_arrays([values])
                offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
                for low, high, held, closed in cut(values, docs, size, self.max_docs, self.max_bytes):
                    out.write(values.buffers()[2][int(offsets[low]) : int(offsets[high])])
                    docs, size = docs + high - low, size + held
                    done.n_docs, done.n_bytes = done.n_docs + high - low, done.n_bytes + held
                    if closed:
                        close()
            if docs:
                close()
        return done

    def commit(self, messages: list[PartWritten | None]) -> None:
        parts = [m for m in messages if m is not None]
        system, folder = opened(self.folder)
        system.create_dir(folder)
        counted = {f"{m.name}{end}" for m in parts for end in (".bulk", ".json")}
        for entry in system.get_file_info(fs.FileSelector(folder)):
            if entry.base_name not in counted:
                system.delete_file(entry.path)
        manifest = {"folder": self.folder.rsplit("/", 1)[1], "parts": [m.name for m in parts]}
        manifest |= {c: sum(getattr(m, c) for m in parts) for c in COUNTS}
        with system.open_output_stream(f"{opened(self.path)[1]}/{MANIFEST}") as out:
            out.write(json.dumps(manifest).encode())

    def abort(self, messages: list[PartWritten | None]) -> None:
        system, folder = opened(self.folder)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class BulkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id string, value string"

    def writer(self, schema, overwrite: bool) -> BulkWriter:
        options = self.options
        return BulkWriter(options["path"], int(options.get("max_docs", BATCH_DOCS)), int(options.get("max_bytes", BATCH_BYTES)))


def read_manifest(path: str) -> dict:
    """The manifest of a complete load: folder, parts and counts."""
    system, at = opened(path.rstrip("/"))
    with system.open_input_stream(f"{at}/{MANIFEST}") as stream:
        return json.loads(stream.read())


def write_bulk(lines: DataFrame, path: str, max_docs: int = BATCH_DOCS, max_bytes: int = BATCH_BYTES) -> dict:
    """Write the bulk lines ``(doc_id, value)`` under the new folder ``path``; gives ``n_docs``, ``n_bytes`` and ``n_batches``.

    Partitions are written as they are, without a shuffle; a task holds one Arrow
    batch. A null ``value`` is no document. The counts come from the tasks' commit
    messages. An empty frame gives a load without batches. A folder that
    holds a load is refused.
    """
    system, at = opened(path.rstrip("/"))
    if system.get_file_info(f"{at}/{MANIFEST}").type != fs.FileType.NotFound:
        raise FileExistsError(f"{path} holds a load")
    spark = lines.sparkSession
    spark.dataSource.register(BulkSource)
    rows = lines.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("value").cast("string").alias("value"))
    rows.write.format(FORMAT).mode("append").option("max_docs", max_docs).option("max_bytes", max_bytes).save(path)
    manifest = read_manifest(path)
    return {c: manifest[c] for c in COUNTS}


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """``(part, batch, n_docs, n_bytes, payload)``: the request bodies of a load, from the parts its manifest names.

    Their index, a short row each, is dealt over the tasks, whatever the sizes of the parts.
    """
    manifest = read_manifest(path)
    folder = f"{path.rstrip('/')}/{manifest['folder']}"
    schema = "part string, batch long, start long, n_docs long, n_bytes long"
    if not manifest["n_batches"]:
        return spark.createDataFrame([], "part string, batch long, n_docs long, n_bytes long, payload string")
    tasks = max(spark.sparkContext.defaultParallelism, -(-manifest["n_bytes"] // TASK_BYTES))
    index = spark.read.schema(schema).option("pathGlobFilter", "*.json").json(folder).repartition(tasks)
    out = pa.schema([("part", pa.string()), ("batch", pa.int64()), ("n_docs", pa.int64()), ("n_bytes", pa.int64()), ("payload", pa.string())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{at}/{row['part']}.bulk") as stream:
                    content = stream.read_at(row["n_bytes"], row["start"])
                del row["start"]
                yield pa.RecordBatch.from_pylist([row | {"payload": content.decode()}], out)

    return index.mapInArrow(load, "part string, batch long, n_docs long, n_bytes long, payload string")
