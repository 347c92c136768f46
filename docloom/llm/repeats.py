"""Removing byte strings that occur twice, found by merging shard Burrows-Wheeler transforms.

Windows of 200 bytes are dealt by their anchor, so equal ones meet wherever
they stand. An anchor with a single segment has no repeat; one whose segments
are all equal repeats wholly. Where segments of an anchor differ, their bytes
form shards, each with its transform; transforms are merged by refining their
interleave, and neighbours whose common prefix reaches 200 bytes are the
repeated windows. Windows never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.anchors import PLACE, WINDOW, segments
from docloom.llm.bwt import repeated_places
from docloom.llm.common import Scratch, spread_input, text_or_empty

BYTES_AT_ONCE = 1 << 20
#: Texts hashed at once: eight bytes and more for each of theirs are to stay in the cache.
HASHED_AT_ONCE = 1 << 18
#: Segments of one anchor merged in a task (at most 1.5 MB). The windows of an
#: anchor with more are counted one by one by their hashes instead.
ANCHOR_SEGMENTS = 4_096
MERGE_BYTES = 1 << 20

ID = ["doc_id", "text_hash"]


def _slices(batch: pa.RecordBatch, column: int, at_once: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    low = held = 0
    for k, value in enumerate(batch.column(column)):
        size = len(value.as_buffer()) if value.is_valid else 0
        if k > low and held + size > at_once:
            yield batch.slice(low, k - low)
            low, held = k, 0
        held += size
    if batch.num_rows > low:
        yield batch.slice(low)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, list[pa.Array]]:
    """Row number and fields of all structs in a column of their lists."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().flatten()


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = text_or_empty(text)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.cast("binary").alias("bytes"))


def segment_rows(texts: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, anchor, segment, place)`` of all segments."""
    schema = pa.schema([(c, pa.int64()) for c in (*ID, "anchor", "segment", "place")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch, 2, HASHED_AT_ONCE):
                number, anchor, hashed, place = segments(some.column(2).to_pylist())
                at = pa.array(number)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(at), some.column(1).take(at), pa.array(anchor), pa.array(hashed), pa.array(place)], schema=schema
                )

    return spread_input(texts).mapInArrow(run, "doc_id long, text_hash long, anchor long, segment long, place long")


def _contents(marked: DataFrame) -> DataFrame:
    """``(anchor, segment, bytes)`` of the segments that have to be compared."""
    schema = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch, 0):
                number, (anchor, segment, place) = _flat(some.column(1))
                texts = some.column(0).to_pylist()
                start, windows = np.divmod(place.to_numpy(), PLACE)
                cut = [texts[k][a:b] for k, a, b in zip(number.tolist(), start.tolist(), (start + windows + WINDOW - 1).tolist())]
                yield pa.RecordBatch.from_arrays([anchor, segment, pa.array(cut, pa.binary())], schema=schema)

    cuts = F.transform(F.filter("cuts", lambda x: x["differs"]), lambda x: F.struct(x["anchor"], x["segment"], x["place"]))
    rows = marked.where(F.exists("cuts", lambda x: x["differs"])).select("bytes", cuts.alias("cuts"))
    return rows.mapInArrow(run, "anchor long, segment long, bytes binary")


WHERE = "anchor long, segment long, windows array<int>"
_WHERE = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("windows", pa.list_(pa.int32()))])


def _where(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    rows = [r for r in rows if len(r[2])]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2].astype(np.int32) for r in rows], _WHERE.field(2).type)], schema=_WHERE,
    )


def _merged(contents: DataFrame) -> DataFrame:
    """Repeated windows of segments, anchor by anchor: several anchors share a merge, none is cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int]] = []
        strings: list[bytes] = []
        held, last = 0, None

        def flush() -> pa.RecordBatch:
            found = repeated_places(strings, WINDOW)
            out = _where([(a, s, f) for (a, s), f in zip(keys, found)])
            keys.clear(), strings.clear()
            return out

        for batch in batches:
            for anchor, segment, content in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != last and held >= MERGE_BYTES:
                    yield flush()
                    held = 0
                keys.append((anchor, segment)), strings.append(content)
                held, last = held + len(content), anchor
        if strings:
            yield flush()

    parts = contents.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = contents.select("anchor", "segment", "bytes").repartition(int(parts), "anchor").sortWithinPartitions("anchor", "segment")
    return dealt.mapInArrow(run, WHERE)


def _counted(contents: DataFrame) -> DataFrame:
    """Repeated windows of segments, by counting 128-bit window hashes: for anchors with very many segments."""
    schema = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("window", pa.int32()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, segment, content in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(content) - WINDOW + 1
                digests = [hashlib.blake2b(content[k : k + WINDOW], digest_size=16).digest() for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * n, pa.int64()), pa.array([segment] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array(digests, pa.binary())], schema=schema,
                )

    windows = contents.select("anchor", "segment", "bytes").mapInArrow(run, "anchor long, segment long, window int, digest binary")
    again = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    again = Scratch(contents.sparkSession, "repeats").table(again, "again")
    return windows.join(again, "digest").groupBy("anchor", "segment").agg(F.sort_array(F.collect_list("window")).alias("windows"))


def _span(start: Column, windows: Column) -> Column:
    return F.struct(start.cast("long").alias("from"), (start + windows + WINDOW - 1).cast("long").alias("to"))


def _spans_of(windows: Column) -> Column:
    """Runs of window starts as ``(from, to)`` of the bytes they cover in the segment."""
    return F.aggregate(
        windows,
        F.array().cast("array<struct<from: int, to: int>>"),
        lambda acc, w: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["to"] >= w),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["from"].alias("from"), (w + WINDOW).cast("int").alias("to"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(w.alias("from"), (w + WINDOW).cast("int").alias("to"))))),
    )


def _joined(row: np.ndarray, spans: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, from, to)`` of the maximal runs that spans of rows cover, in order; spans that touch are joined."""
    low, high = (x.to_numpy() for x in spans)
    by = np.lexsort((low, row))
    row, low, high = row[by], low[by], high[by]
    reach = np.maximum.accumulate(row * (1 << 32) + high)  # texts are shorter than 2^31 bytes: no row reaches into the next
    first = np.append(True, (row * (1 << 32) + low)[1:] > reach[:-1])[: len(row)]
    last = np.append(first[1:], True)[: len(row)]
    return row[first], low[first], reach[last] - (row[last] << 32)


def _cut(texts: DataFrame) -> DataFrame:
    """Remove ``spans`` from ``bytes``: ``(doc_id, n_bytes, n_removed, n_spans, kept, spans)``."""
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept", pa.binary()), ("spans", kind),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch, 1):
                contents = some.column(1).to_pylist()
                row, low, high = _joined(*_flat(some.column(2)))
                at = np.searchsorted(row, np.arange(len(contents) + 1))
                kept, lows, highs = [], low.tolist(), high.tolist()
                for content, a, z in zip(contents, at[:-1].tolist(), at[1:].tolist()):
                    ends, starts = [0, *highs[a:z]], [*lows[a:z], len(content)]
                    kept.append(b"".join([content[x:y] for x, y in zip(ends, starts)]) if z > a else content)
                n = np.fromiter(map(len, contents), np.int64, len(contents))
                left = np.fromiter(map(len, kept), np.int64, len(kept))
                spans = pa.StructArray.from_arrays([pa.array(low), pa.array(high)], fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(n), pa.array(n - left), pa.array(np.diff(at)), pa.array(kept, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans, type=kind)], schema=schema,
                )

    return texts.select("doc_id", "bytes", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<from: long, to: long>>"
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anchor_segments: int = ANCHOR_SEGMENTS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept, spans)`` per row of ``docs``.

    Every byte covered by a 200-byte string that also starts anywhere else is
    removed; ``kept`` holds the others (not always valid UTF-8), ``spans`` the
    maximal removed runs. A null text is empty. A row is known by its id and a
    64-bit hash of its text: repeated rows count as places of their own and
    are all removed, like other copies. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = _texts(docs, doc_id, text)
    found = scratch.table(segment_rows(texts), "segments")  # read twice
    anchors = (
        found.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("segment").alias("low"), F.max("segment").alias("high"))
        .where("n > 1")
        .select("anchor", (F.col("low") != F.col("high")).alias("differs"))
    )
    anchors = scratch.table(anchors, "anchors")
    cuts = found.join(anchors, "anchor").groupBy(*ID).agg(
        F.collect_set(F.struct("anchor", "segment", "place", "differs")).alias("cuts")
    )
    cuts = scratch.table(cuts, "cuts")
    scratch.drop("segments")
    right = cuts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "cuts").hint("merge")
    marked = texts.join(right, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left").drop("_id", "_hash")
    marked = scratch.table(marked, "marked")

    # One copy of each segment; a segment that occurs twice repeats wholly.
    places = cuts.select(*ID, F.explode(F.filter("cuts", lambda x: x["differs"])).alias("c")).select(*ID, "c.anchor", "c.segment", "c.place")
    contents = _contents(marked).groupBy("anchor", "segment").agg(F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    contents = scratch.table(contents, "contents")
    crowded = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > anchor_segments).select("anchor")
    crowded = scratch.table(crowded, "crowded")
    windows = _merged(contents.join(crowded, "anchor", "left_anti")).unionByName(
        _counted(contents.join(crowded, "anchor", "left_semi"))
    )
    spans = windows.select("anchor", "segment", _spans_of(F.col("windows")).alias("spans"))
    whole = contents.where("n > 1").select(
        "anchor", "segment",
        F.array(F.struct(F.lit(0).alias("from"), F.octet_length("bytes").alias("to"))).alias("spans"),
    )
    repeated = scratch.table(spans.unionByName(whole), "repeated")
    here = F.floor(F.col("place") / PLACE)
    by_text = (
        places.join(repeated, ["anchor", "segment"])
        .select(*ID, F.transform("spans", lambda s: F.struct((s["from"] + here).alias("from"), (s["to"] + here).alias("to"))).alias("spans"))
        .groupBy(*ID)
        .agg(F.flatten(F.collect_list("spans")).alias("found"))
    )
    by_text = scratch.table(by_text, "spans")
    scratch.drop("cuts")
    scratch.drop("contents")
    by_text = by_text.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "found").hint("merge")
    equal = F.transform(
        F.filter("cuts", lambda c: ~c["differs"]),
        lambda c: _span(F.floor(c["place"] / PLACE), F.pmod(c["place"], F.lit(PLACE))),
    )
    nothing = F.array().cast("array<struct<from: long, to: long>>")
    compared = F.exists("cuts", lambda c: c["differs"])
    # Only texts with compared segments meet their spans; the others are done.
    open_ = marked.where(compared).join(
        by_text, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left"
    ).select("doc_id", "bytes", F.concat(equal, F.coalesce("found", nothing)).alias("spans"))
    plain = marked.where(~F.coalesce(compared, F.lit(False))).select("doc_id", "bytes", F.coalesce(equal, nothing).alias("spans"))
    return _cut(open_).unionByName(_cut(plain))
