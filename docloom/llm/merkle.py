"""Merkle manifest of a dataset: a tree of digests for each group of rows, and a tree over the groups.

Every node is labelled with the interval ``[lo, hi]`` of leaf ranks it covers.
Ranks come from one distributed sort and the counts of its partitions. Levels
are taken in bands of at most ``SPAN`` leaves: a band's nodes meet in the
bucket of their rank interval, where one task grows the levels of the band and
joins each entry with the nodes that contain its interval. What such a node
covers besides the child on the way to it, the difference of the two
intervals, names the siblings. The top of a bucket enters the next band, and
the way from the top down is joined back by the interval that contains an
entry: a table of N leaves takes log(N) / log(SPAN) rounds, each with one row
for an entry, and no bucket exceeds ``SPAN`` entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.llm.common import Scratch

#: Entries of a bucket at most.
SPAN = 1_024

STEP = "struct<pos: int, others: array<string>>"
NODE = (
    "tree long, n long, level int, lo long, hi long, digest string, parent_lo long, parent_hi long, "
    "top boolean, ended boolean, path array<" + STEP + ">"
)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""

    def up(digest: Column, step: Column) -> Column:
        others, pos = step["others"], step["pos"]
        before = F.slice(others, F.lit(1), pos)
        after = F.slice(others, pos + 1, F.greatest(F.size(others) - pos, F.lit(0)))
        return F.sha2(F.array_join(F.concat(before, F.array(digest), after), ""), 256)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of ``path``, from the leaf's up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: s["others"])), ""), 256)


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[Column], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` plus ``rank`` (from 0, in ``order``) and ``n`` (rows) within the groups.

    ``order`` sorts by the columns ``group`` first. One sort by ranges; what is added up after it is a
    row for each group and partition.
    """
    sorted_rows = scratch.table(rows.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()), name)
    part = F.shiftright("_row", 33)
    pieces = sorted_rows.groupBy(*group, part.alias("_part")).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    pieces = scratch.table(pieces, f"{name}_pieces")
    # Sums over the earlier partitions of the same group: the window holds a row for each partition.
    before = Window.partitionBy(*group).orderBy("_part")
    pieces = pieces.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), "_first",
        (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"), F.sum("_rows").over(Window.partitionBy(*group)).alias("n"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    on = F.col("_part") == F.col("_p")
    for s in same:
        on = on & s
    joined = sorted_rows.withColumn("_part", part).join(pieces, on)
    return joined.select(*rows.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias("rank"), "n")


def levels_of(n: int, arity: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels, span = 0, 1
    while span < n:
        levels, span = levels + 1, span * arity
    return levels


def _grow(arity: int, first: int, height: int) -> Callable[[pa.Table], pa.Table]:
    """For a bucket of entries ``(tree, n, lo, hi, digest)`` of level ``first``: its nodes up to ``height`` levels higher."""

    schema = pa.schema([
        ("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("digest", pa.string()),
        ("parent_lo", pa.int64()), ("parent_hi", pa.int64()), ("top", pa.bool_()), ("ended", pa.bool_()),
        ("path", pa.list_(pa.struct([("pos", pa.int32()), ("others", pa.list_(pa.string()))]))),
    ])

    def run(entries: pa.Table) -> pa.Table:
        entries = entries.sort_by("lo")
        tree, n = entries.column("tree")[0].as_py(), entries.column("n")[0].as_py()
        lo, hi, digests = entries.column("lo").to_numpy(), entries.column("hi").to_numpy(), entries.column("digest").to_pylist()
        rise = max(0, min(height, levels_of(n, arity) - first))
        ended = first + rise == levels_of(n, arity)
        # Node labels by level: intervals of ranks, and digests of what they cover.
        labels = [(lo, hi, digests)]
        for _ in range(rise):
            lo, hi, digests = labels[-1]
            starts = np.arange(0, len(lo), arity)
            ends = np.minimum(starts + arity, len(lo))
            made = [hashlib.sha256("".join(digests[a:b]).encode()).hexdigest() for a, b in zip(starts, ends)]
            labels.append((lo[starts], hi[ends - 1], made))
        # Containment: for each node the node one level higher whose interval holds its own.
        above = []
        for (low, high, _), (up_low, up_high, _) in zip(labels, labels[1:]):
            at = np.searchsorted(up_low, low, side="right") - 1
            if not ((up_low[at] <= low) & (high <= up_high[at])).all():
                raise ValueError("a node lies in no interval of the next level")
            above.append(at)

        def step(level: int, node: int) -> dict:
            low, high, digests = labels[level]
            up_low, up_high, _ = labels[level + 1]
            parent = above[level][node]
            # What the parent covers besides the node: the ranks before lo and those after hi.
            left = np.searchsorted(low, up_low[parent])
            right = np.searchsorted(low, up_high[parent], side="right")
            return {"pos": int(node - left), "others": [*digests[left:node], *digests[node + 1 : right]]}

        steps = [[step(level, node) for node in range(len(labels[level][0]))] for level in range(rise)]
        out = []
        for level, (low, high, digests) in enumerate(labels):
            top = level == rise
            for node in range(len(low)):
                parent = None if top else above[level][node]
                path = None
                if level == 0:
                    path, at = [], node
                    for k in range(rise):
                        path.append(steps[k][at])
                        at = above[k][at]
                up = (None, None) if top else (int(labels[level + 1][0][parent]), int(labels[level + 1][1][parent]))
                out.append((tree, n, first + level, int(low[node]), int(high[node]), digests[node], *up, top, top and ended, path))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _height(arity: int) -> int:
    """Levels of a band: a bucket has ``SPAN`` entries at most."""
    height = 1
    while arity ** (height + 1) <= SPAN:
        height += 1
    return height


def _bands(leaves: DataFrame, arity: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """The nodes of all trees over ``leaves(tree, n, rank, digest)``, a written table for each band of levels, lowest first."""
    height = _height(arity)
    most = leaves.agg(F.max("n")).first()[0] or 0
    entries = leaves.select("tree", "n", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "digest")
    bands: list[DataFrame] = []
    while not bands or len(bands) * height < levels_of(most, arity):
        first = len(bands) * height
        bucketed = entries.withColumn("bucket", F.expr(f"lo div {arity ** (first + height)}"))
        grown = bucketed.groupBy("tree", "bucket").applyInArrow(_grow(arity, first, height), NODE)
        bands.append(scratch.table(grown, f"{name}_band{len(bands)}"))
        # Finished trees end here; the others go on from the tops of their buckets.
        entries = bands[-1].where("top AND NOT ended").select("tree", "n", "lo", "hi", "digest")
    return bands


def _paths(bands: list[DataFrame], arity: int) -> DataFrame:
    """``(tree, lo, root, path)`` of all leaves: the band's own part of the way, then that of the bucket's top."""
    height = _height(arity)
    above = None
    for number in reversed(range(len(bands))):
        band, span = bands[number], arity ** ((number + 1) * height)
        entries = band.where(F.col("path").isNotNull()).select("tree", "lo", "hi", "path", F.expr(f"lo div {span}").alias("bucket"))
        tops = band.where("top").select(
            F.col("tree").alias("t"), F.expr(f"lo div {span}").alias("b"), F.col("lo").alias("top_lo"), F.col("hi").alias("top_hi"), "digest"
        )
        if above is not None:
            tops = tops.join(
                above.select(F.col("tree").alias("t"), F.col("lo").alias("top_lo"), F.col("root").alias("up"), F.col("path").alias("rest")),
                ["t", "top_lo"], "left",
            )
        else:
            tops = tops.select("*", F.lit(None).cast("string").alias("up"), F.lit(None).cast(f"array<{STEP}>").alias("rest"))
        # The bucket of the level holds one top; its interval must contain the entry's.
        inside = (F.col("tree") == F.col("t")) & (F.col("bucket") == F.col("b")) & F.col("lo").between(F.col("top_lo"), F.col("top_hi"))
        none = F.array().cast(f"array<{STEP}>")
        above = entries.join(tops, inside).select(
            "tree", "lo", F.coalesce("up", "digest").alias("root"), F.concat("path", F.coalesce("rest", none)).alias("path")
        )
    return above


class Manifest:
    """``rows``: what was given, plus ``subroot``, ``root`` and ``path``; ``nodes``: every node with its interval."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, groups: DataFrame) -> None:
        self.rows, self.nodes, self.groups = rows, nodes, groups


def manifest(docs: DataFrame, group: str, order: str, leaf: Column, keep: Sequence[Column] = (), arity: int = 2) -> Manifest:
    """Merkle trees over ``docs``.

    The rows of each value of ``group`` (null is a value of its own) are the
    leaves of a tree, in ascending ``order``; rows with equal ``order`` follow
    their leaf digests, nulls come first. ``leaf`` is the digest of a row. While
    a level has several nodes, every ``arity`` consecutive ones become the
    digest of their concatenated hex digests; a last run of fewer, even one,
    does too. A lone leaf is its tree's root. The roots of the groups, null
    first and then by UTF-8 bytes, are the leaves of one more tree.

    ``rows`` has ``leaf``, ``subroot``, ``root`` and ``path`` (the steps to the
    root: a node's position in its run and the run's others) and ``row``, a
    struct of the group, the order and ``keep``; columns of ``docs`` in no
    other way, so their names clash with nothing. Equal rows are a leaf each.
    ``nodes`` holds ``(tree, level, lo, hi, digest, parent_lo, parent_hi)``
    of every node, ``groups`` names each tree's group. No row: no rows and no nodes.
    """
    if arity < 2:
        raise ValueError("a run needs two nodes at least")
    scratch = Scratch(docs.sparkSession, "merkle")
    picked = docs.select(
        F.col(group).alias("g"), F.col(order).alias("o"), leaf.alias("digest"),
        F.struct(F.col(group).alias("group"), F.col(order).alias("order"), *keep).alias("row"),
    )
    leaves = scratch.table(picked, "leaves")  # texts are read and hashed once, the sort takes digests
    by_rank = [F.col("g").asc_nulls_first(), F.col("o").asc_nulls_first(), F.col("digest")]
    placed = scratch.table(ranked(leaves, ["g"], by_rank, scratch, "sorted"), "placed")
    groups = ranked(placed.select("g").where("rank = 0"), [], [F.col("g").asc_nulls_first()], scratch, "groups")
    groups = scratch.table(groups.withColumnRenamed("rank", "tree").withColumnRenamed("n", "trees"), "trees")
    # A group's name becomes its number; a hot group's rows stay where they are if AQE broadcasts or splits.
    numbered = groups.select(F.col("g").alias("named"), "tree")
    placed = placed.join(numbered, F.col("g").eqNullSafe(F.col("named"))).select("tree", "n", "rank", "digest", "row")
    placed = scratch.table(placed, "numbered")
    bands = _bands(placed.select("tree", "n", "rank", "digest"), arity, scratch, "group")
    paths = _paths(bands, arity)
    roots = scratch.table(paths.where("lo = 0").select("tree", F.col("root").alias("subroot")), "subroots")
    tops = roots.join(groups, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("trees").alias("n"), F.col("tree").alias("rank"), F.col("subroot").alias("digest")
    )
    top_bands = _bands(scratch.table(tops, "tops"), arity, scratch, "top")
    upper = _paths(top_bands, arity).select(F.col("lo").alias("tree"), F.col("root").alias("whole"), F.col("path").alias("rest"))
    upper = scratch.table(upper, "upper")
    way = paths.select("tree", F.col("lo").alias("rank"), F.col("root").alias("subroot"), "path").join(upper, "tree")
    rows = placed.join(way, ["tree", "rank"]).select(
        "row", "tree", "rank", F.col("digest").alias("leaf"), "subroot", F.col("whole").alias("root"), F.concat("path", "rest").alias("path")
    )
    labels = ["tree", "level", "lo", "hi", "digest", "parent_lo", "parent_hi"]
    # The top of a band that goes on is an entry of the next one as well.
    nodes = reduce(DataFrame.unionByName, [band.where("NOT top OR ended").select(*labels) for band in bands])
    return Manifest(rows, nodes, groups.select("tree", F.col("g").alias("group")))
