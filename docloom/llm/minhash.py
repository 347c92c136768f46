"""Near duplicates: fast similarity sketches, banding, exact verification.

Documents with one shingle set form a class. Classes meet in the buckets of
32 bands of 4 sketch values: a pair of similarity 0.8 misses them all with
probability 5e-8. First each class is verified against the smallest id it
meets, which joins most groups with one comparison per document. Buckets that
then still hold several components are searched in blocks, once, for rows with
a partner whose sketch agrees; only these go on. First the best partner of each
is verified, then every pair that still lies in different components, where it
is found: a block cell has the full sets, joins what it links at once, and puts
out one link for each two components it joins, however many pairs agree. Links
are decided on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docloom.llm.common import Scratch, spread_input
from docloom.llm.components import components
from docloom.llm.shingles import WORDS, mixed, shared, shingle_sets, sketch

BINS, BAND = 128, 4
PERCENT = 80
#: Equal values that two sketches need to be verified. At similarity 0.8 their
#: number is 102 on average with a deviation of 4.5: five deviations below.
MIN_EQUAL = 80
#: Classes of a bucket compared in one go, and bytes of their sets at once.
BLOCK = 2_048
BLOCK_BYTES = 32_000_000
DOCS_AT_ONCE = 64


def row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two longs, never null, that only rows of one doc_id and text share."""
    number = doc_id.cast("long")
    return F.coalesce(number, F.lit(0).cast("long")), F.xxhash64(number.isNull(), text)


def sketches(docs: DataFrame, doc_id: str, text: str, size: int = WORDS) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, set_key, bands, sketch)``; the last three are null for an empty set.

    ``text_hash`` tells apart rows that share a doc_id (``row_key``), ``set_key``
    is a 128-bit digest of the set, ``sketch`` has 16 bits a value.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
        ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()),
    ])
    salts = mixed(np.arange(BINS // BAND, dtype=np.uint64) + np.uint64(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(low, DOCS_AT_ONCE)
                keys, bands, values = [], [], []
                sets = shingle_sets(some.column(1).to_pylist(), size)
                for items in sets:
                    if not len(items):
                        keys.append(None), bands.append(None), values.append(None)
                        continue
                    found = sketch(items, BINS)
                    rows = found.reshape(-1, BAND)
                    hashed = salts
                    for column in rows.T:
                        hashed = mixed(hashed ^ column) * np.uint64(0x9E3779B97F4A7C15)
                    keys.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    bands.append(hashed.view(np.int64))
                    values.append(mixed(found).astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).cast(pa.int64()), some.column(2).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(values, pa.binary())], schema=schema,
                )

    text_hash = row_key(F.col(doc_id), F.col(text))[1]
    rows = spread_input(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), text_hash.alias("text_hash")))
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>, sketch binary")


def verify(pairs: DataFrame, percent: int = PERCENT, size: int = WORDS) -> DataFrame:
    """The links ``(u, v)`` among ``pairs(u, v, text_u, text_v)``, decided on the full sets."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(low, DOCS_AT_ONCE)
                us, vs, a, b = (c.to_pylist() for c in some.columns)
                texts = list(dict.fromkeys([*a, *b]))  # a hub's text comes once
                sets = dict(zip(texts, shingle_sets(texts, size)))
                links = []
                for u, v, x, y in zip(us, vs, a, b):
                    both = shared(sets[x], sets[y])
                    if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both) and both:
                        links.append((u, v))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], schema=schema
                )

    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    first = texts.select(F.col("id").alias("u"), F.col("text").alias("text_u"))
    second = texts.select(F.col("id").alias("v"), F.col("text").alias("text_v"))
    return pairs.hint("merge").join(first, "u").join(second.hint("merge"), "v")


def _cell(cell: pa.Table, key: tuple[pa.Scalar, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Sketch values, band hashes and row numbers of the two blocks of a cell, and its band."""
    values = np.frombuffer(b"".join(cell.column("sketch").to_pylist()), np.uint16).reshape(-1, BINS)
    bands = np.array(cell.column("bands").to_pylist(), np.int64)
    side = cell.column("side").to_numpy()
    return values, bands, np.flatnonzero(side == key[1].as_py()), np.flatnonzero(side == key[2].as_py()), cell.column("band")[0].as_py()


def _agreeing(rows: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of different roots in one block cell: for each row the best partner whose sketch agrees on MIN_EQUAL values.

    ``rows`` is ``(bucket, band, left, right, side, id, root, bands, sketch)``: a cell
    ``(bucket, left, right)`` compares its block ``left`` with ``right`` and
    holds at most two blocks. A pair is given in the first band it shares
    alone, by the 64-bit values that made the buckets.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
        values, bands, left, right, band = _cell(cell, key)
        ids, roots = cell.column("id").to_numpy(), cell.column("root").to_numpy()
        found = [np.zeros((0, 2), np.int64)]
        for at in left:
            others = right[roots[right] != roots[at]]
            equal = (values[others] == values[at]).sum(1)
            first = (bands[others] == bands[at]).argmax(1) == band
            fits = np.flatnonzero((equal >= MIN_EQUAL) & first)
            if len(fits):
                best = others[fits[equal[fits].argmax()]]
                found.append(np.array([[max(ids[best], ids[at]), min(ids[best], ids[at])]], np.int64))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return rows.groupBy("bucket", "left", "right").applyInArrow(compare, "u long, v long")


def _candidates(rows: DataFrame) -> DataFrame:
    """The ``rows`` of ``_agreeing`` that have in their cell a partner of another root with a sketch that agrees, at most each once."""

    def compare(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
        values, bands, left, right, band = _cell(cell, key)
        roots = cell.column("root").to_numpy()
        wanted = np.zeros(len(roots), bool)
        for at in left:
            others = right[roots[right] != roots[at]]
            equal = (values[others] == values[at]).sum(1)
            fits = others[(equal >= MIN_EQUAL) & ((bands[others] == bands[at]).argmax(1) == band)]
            if len(fits):
                wanted[at] = wanted[fits] = True
        return cell.filter(pa.array(wanted))

    return rows.groupBy("bucket", "left", "right").applyInArrow(compare, rows.schema)


def _linking(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``(u, v)`` that join the roots of each block cell as far as its pairs do: under one for each root.

    ``rows`` is as for ``_agreeing``, with ``items``, the set of each class. Pairs whose
    roots are joined already need no look; all others that agree are decided on their sets.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
        values, bands, left, right, band = _cell(cell, key)
        ids = cell.column("id").to_numpy()
        names, roots = np.unique(cell.column("root").to_numpy(), return_inverse=True)
        sets = [np.frombuffer(x, np.uint64) for x in cell.column("items").to_pylist()]
        links = []
        for at in left:
            others = right[roots[right] != roots[at]]
            equal = (values[others] == values[at]).sum(1)
            fits = np.flatnonzero((equal >= MIN_EQUAL) & ((bands[others] == bands[at]).argmax(1) == band))
            for other in others[fits[np.argsort(-equal[fits], kind="stable")]]:
                if roots[other] == roots[at]:
                    continue
                both = shared(sets[at], sets[other])
                if both and 100 * both >= percent * (len(sets[at]) + len(sets[other]) - both):
                    links.append((max(ids[at], ids[other]), min(ids[at], ids[other])))
                    roots = np.where(roots == roots[other], roots[at], roots)
        return pa.Table.from_arrays([pa.array([int(x[0]) for x in links], pa.int64()), pa.array([int(x[1]) for x in links], pa.int64())], schema=schema)

    return rows.groupBy("bucket", "left", "right").applyInArrow(compare, "u long, v long")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``(id, items)`` of ``texts(id, text)``: the shingle sets as packed numbers."""
    schema = pa.schema([("id", pa.int64()), ("items", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(low, DOCS_AT_ONCE)
                found = shingle_sets(some.column(1).to_pylist(), size)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([items.tobytes() for items in found], pa.binary())], schema=schema)

    return texts.select("id", "text").mapInArrow(run, "id long, items binary")


def _blocked(rooted: DataFrame, several: DataFrame, *carried: str) -> DataFrame:
    """The block cells of the buckets ``several(bucket, blocks)``: each block meets each other one, and itself."""
    return (
        rooted.select("id", "root", "bands", "sketch", *carried, F.posexplode("bands").alias("band", "bucket"))
        .join(several, "bucket")
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", "band", F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right"), "side", "id", "root", "bands", "sketch", *carried)
    )


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with ``root``, the component of ``id`` so far."""
    rows = rows.join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    return rows.withColumn("root", F.coalesce("root", "id"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at least
    ``percent``; ``kept`` marks the row that carries it, of several the one
    with the smallest text hash. A null or empty text has no shingles and links
    with nothing. Rows are told apart by doc_id and text, so that rows with one
    doc_id can lie in several components; rows that agree in both are judged
    alike. A component without any doc_id has a null ``component_id`` and keeps
    a row as well. An empty table gives an empty result.

    Only class representatives are linked; copies follow by their set. Classes
    are numbered in the order of doc_id. Joins that carry texts are sort-merge
    joins at every size.
    """
    return _judged(docs, Scratch(docs.sparkSession, "near"), doc_id, text, size, percent).drop("text_hash")


def _judged(docs: DataFrame, scratch: Scratch, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """``near_groups`` with ``text_hash``."""
    rows = scratch.table(sketches(docs, doc_id, text, size), "sketches")
    key = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("_k1"), F.col("text_hash").alias("_k2")
    )
    classes = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min(key).alias("best"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles")
    )
    classes = scratch.table(classes.orderBy("best").withColumn("id", F.monotonically_increasing_id()), "classes")
    met = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = met.groupBy("bucket").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = scratch.table(buckets, "buckets")
    hubs = met.join(buckets, "bucket").groupBy("id").agg(F.min("hub").alias("hub"))
    hubs = scratch.table(hubs, "hubs")
    leading = hubs.where("hub < id").select(F.col("hub").alias("id")).distinct().withColumn("leads", F.lit(True))
    keys = classes.select("id", "best._k1", "best._k2")
    chosen = scratch.table(hubs.join(leading, "id", "left").join(keys, "id"), "chosen")
    k1, k2 = row_key(F.col(doc_id), F.col(text))
    texts = docs.select(k1.alias("_k1"), k2.alias("_k2"), F.col(text).alias("text")).join(chosen.hint("merge"), ["_k1", "_k2"])
    texts = texts.groupBy("_k1", "_k2", "id", "hub", "leads").agg(F.first("text").alias("text"))  # repeated rows fold into one
    texts = scratch.table(texts.select("id", "hub", "leads", "text"), "texts")
    scratch.drop("buckets")
    scratch.drop("chosen")
    stars = texts.where("hub < id").select(F.col("id").alias("u"), F.col("hub").alias("v"), F.col("text").alias("text_u"))
    hub_texts = texts.where("leads").select(F.col("id").alias("v"), F.col("text").alias("text_v"))
    first = scratch.table(verify(stars.join(hub_texts, "v"), percent, size).distinct(), "links1")
    roots = components(first, Scratch(docs.sparkSession, "near1"))

    met = classes.select("id", "bands", "sketch", "n_shingles").join(hubs.select("id"), "id", "left_semi")
    rooted = scratch.table(_with_roots(met, roots), "rooted")
    scratch.drop("hubs")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(8 * F.sum("n_shingles") / BLOCK_BYTES)).cast("int")
    several = (
        rooted.select("root", "n_shingles", F.explode("bands").alias("bucket"))
        .groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), blocks.alias("blocks"))
        .where("a <> b").select("bucket", "blocks")
    )
    several = scratch.table(several, "several")
    # Later steps only join roots, so rows without a candidate now never get one: texts and cells of the others are all they need.
    cells = scratch.table(_candidates(_blocked(rooted, several)), "cells")
    scratch.drop("rooted")
    scratch.drop("several")
    wanted = texts.select("id", "text").join(cells.select("id").distinct().hint("merge"), "id", "left_semi")
    wanted = scratch.table(wanted, "wanted")
    scratch.drop("texts")
    pairs = scratch.table(_agreeing(cells).distinct(), "pairs")
    best = scratch.table(verify(_with_texts(pairs, wanted), percent, size).distinct(), "best")
    links = first.unionByName(best)
    roots = components(links, Scratch(docs.sparkSession, "near2"))

    left = scratch.table(_candidates(_with_roots(cells.drop("root"), roots).select(cells.columns)), "left")
    sets = scratch.table(_sets(wanted.join(left.select("id").distinct().hint("merge"), "id", "left_semi"), size), "sets")
    links = links.unionByName(scratch.table(_linking(left.join(sets.hint("merge"), "id"), percent), "found"))
    for name in ("cells", "wanted", "pairs", "left", "sets"):
        scratch.drop(name)
    roots = components(links, Scratch(docs.sparkSession, "near3"))

    member = classes.select("set_key", "id").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select(
        "set_key", F.coalesce("root", "id").alias("root")
    )
    # The root is the class that comes first in its component, so its best row is the component's.
    member = scratch.table(member.join(classes.select(F.col("id").alias("root"), "best"), "root").select("set_key", "best"), "members")
    out = rows.select("doc_id", "text_hash", "n_shingles", "set_key").join(member, "set_key", "left")
    component = F.when(F.col("best").isNull(), F.col("doc_id")).when(~F.col("best.unnamed"), F.col("best._k1"))
    return out.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), (F.col("best").isNull() | (F.col("best") == key)).alias("kept")
    )


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns; rows without shingles stay."""
    scratch = Scratch(docs.sparkSession, "near")
    judged = _judged(docs, scratch, doc_id, text, size, percent).select(
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("_k1"), F.col("text_hash").alias("_k2"), "n_shingles", "kept"
    )
    judged = scratch.table(judged, "judged")
    k1, k2 = row_key(docs[doc_id], docs[text])
    dropped = scratch.table(judged.where("NOT kept").select("_k1", "_k2").distinct(), "dropped").hint("merge")
    left = docs.join(dropped, (k1 == dropped["_k1"]) & (k2 == dropped["_k2"]), "left_anti")
    repeated = judged.where("kept AND n_shingles > 0").groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = scratch.table(repeated.select("_k1", "_k2"), "repeated")
    if repeated.isEmpty():
        return left
    repeated = repeated.hint("merge")
    same = (k1 == repeated["_k1"]) & (k2 == repeated["_k2"])
    first = docs.join(repeated, same, "left_semi").select(k1.alias("_k1"), k2.alias("_k2"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return left.join(repeated, same, "left_anti").union(first.dropDuplicates(["_k1", "_k2"]).select("row.*"))
