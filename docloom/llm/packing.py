"""Hierarchical packing of token ids into windows of several lengths.

Documents are encoded once per task. Whole long windows are cut off first; what
is left is routed to the smallest tier that holds it. Windows are opened by the
longest pieces; their gaps are filled with the longest pieces of shorter tiers
that fit, and the last gap with a cut of the shortest piece. A window thus has
exactly the size of its tier. Only the last window of a task can be short.

Steps gather windows of one tier so that every full step has the same number of tokens.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import spread_input
from docloom.llm.tokens import default_tokenizer, encoder

WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16_384
END_ID = 1
#: Pieces held back so that later documents find gaps to fill, and documents encoded at once.
HELD_PIECES = 256
DOCS_AT_ONCE = 64

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "window int, step long, ids binary"
)


class Packer:
    """Fills windows from pieces ``(length, number, start)`` of documents held by number."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, held: int = HELD_PIECES) -> None:
        self.tiers, self.longest, self.held = sorted(tiers), max(tiers), held
        self.pool: list[tuple[int, int, int]] = []

    def add(self, number: int, length: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Take a document; give the windows ``(size, pieces)`` it fills alone."""
        whole = length - length % self.longest
        for start in range(0, whole, self.longest):
            yield self.longest, [(self.longest, number, start)]
        if length > whole:
            insort(self.pool, (length - whole, number, whole))

    def windows(self, finish: bool = False) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Give filled windows until only the held pieces are left, or none with ``finish``."""
        while len(self.pool) > (0 if finish else self.held):
            first = self.pool.pop()
            size = next(t for t in self.tiers if t >= first[0])
            pieces, gap = [first], size - first[0]
            while gap and self.pool:
                at = bisect_right(self.pool, (gap, 1 << 62, 0)) - 1
                if at >= 0:
                    piece = self.pool.pop(at)
                else:
                    length, number, start = self.pool.pop(0)
                    piece = (gap, number, start)
                    insort(self.pool, (length - gap, number, start + gap))
                pieces.append(piece)
                gap -= piece[0]
            yield size, pieces


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    ids: bool = False,
) -> DataFrame:
    """One row per piece: document, position in it, length, CRC-32, sequence and offset there.

    ``window`` is the length the sequence is filled to: its tier's, or for the
    last short one of a task the longest window, which it is padded to.
    ``step`` numbers groups of windows of one tier with 16,384 tokens each.
    With ``ids`` the pieces' ids come along.

    A null text is empty: one piece with the end id. Null ids stay null, and
    repeated rows are packed separately. No row is shuffled; the pieces of a
    row lie in the task that read it. An empty table gives an empty result.
    """
    tokenizer = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([
        *((c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
        ("window", pa.int32()), ("step", pa.int64()), ("ids", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        to_ids, packer = encoder(tokenizer), Packer()
        held: dict[int, list] = {}  # number -> [doc_id, ids, tokens not yet in a window]
        made: dict[int, int] = {}
        rows: list[list] = []
        sequence = number = 0

        def emit(size: int, pieces: list[tuple[int, int, int]]) -> None:
            nonlocal sequence
            filled = sum(p[0] for p in pieces)
            if filled & (filled - 1) == 0:
                window = filled
            else:
                window = size if filled == size else WINDOW
            tier = packer.tiers.index(size)
            made[size] = made.get(size, 0) + 1
            step = task + (tier << 28) + (made[size] - 1) * size // STEP_TOKENS
            offset = 0
            for length, at, start in pieces:
                entry = held[at]
                piece = entry[1][4 * start : 4 * (start + length)]
                rows.append([
                    entry[0], start, length, zlib.crc32(piece), len(entry[1]) // 4, task + sequence, offset,
                    window, step, piece if ids else None,
                ])
                offset += length
                entry[2] -= length
                if not entry[2]:
                    del held[at]
            sequence += 1

        def taken() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[] for _ in schema]
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            rows.clear()
            return out

        for batch in batches:
            for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(low, DOCS_AT_ONCE)
                for key, found in zip(some.column(0).to_pylist(), to_ids.encode_many(some.column(1).to_pylist())):
                    found += end
                    held[number] = [key, found, len(found) // 4]
                    for window in packer.add(number, len(found) // 4):
                        emit(*window)
                    number += 1
                for window in packer.windows():
                    emit(*window)
                yield taken()
        for window in packer.windows(finish=True):
            emit(*window)
        yield taken()

    rows = spread_input(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    packed = rows.mapInArrow(run, SCHEMA)
    return packed if ids else packed.drop("ids")
