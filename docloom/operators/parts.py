"""Bounded groups: split the few oversized groups of a key into ordered parts.

Folding a group into one array or one string needs the group in one row. That
is fine for almost every key, but one key may hold a large share of all rows.
``ordered_parts`` numbers the rows of such keys ``part`` 0, 1, 2, ... so that
every ``(key, part)`` is bounded and the parts, read in order, are the whole
group. All other keys get part 0 and pay only for the size check. Nothing is
split unless the caller names a limit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docloom.session import broadcast_if_small, cut_lineage

# Range partitions used to order the rows of oversized keys: the driver samples
# each and hears from each, so their number follows what a task can order.
MAX_SLICES = 20_000
SLICE_WEIGHT = 16 * 1024 * 1024


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    # NULL is a group of its own, as in GROUP BY.
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def oversized_keys(df: DataFrame, keys: Sequence[str], weight: Column, limit: int) -> DataFrame:
    """``(keys, total)`` of the groups whose summed ``weight`` exceeds ``limit``.

    Partial sums make the shuffle one row per key and map task, whatever the
    skew; the result has at most ``sum(weight) / limit`` rows.
    """
    return (
        df.groupBy(*keys)
        .agg(F.sum(weight).alias("total"))
        .filter(F.col("total") > limit)
    )


def split_by_size(
    df: DataFrame, keys: Sequence[str], weight: Column, limit: int
) -> tuple[DataFrame, DataFrame | None, int]:
    """Separate the rows of oversized groups: ``(rest, oversized or None, total weight)``."""
    hot = oversized_keys(df, keys, weight, limit)
    total = hot.agg(F.sum("total")).first()[0]
    if total is None:
        return df, None, 0
    hot = broadcast_if_small(cut_lineage(hot.select(*keys)))
    match = _same(df, hot, keys)
    return df.join(hot, match, "left_anti"), df.join(hot, match, "left_semi"), total


def slice_count(df: DataFrame, total: int, limit: int, held: int) -> int:
    """Slices for rows of weight ``total``: of about ``held`` each, if all cores have one.

    Never more than two for each ``limit`` of weight.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(MAX_SLICES, 2 * (total // limit + 1), max(cores, total // held + 1)))


def slice_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int
) -> DataFrame:
    """Merge equal rows (``_copies``) and add ``_slice``: the number of the range
    partition of ``(keys, order, other columns)`` a row falls into.

    Within a key, slice order is row order. Equal rows are merged first, so
    no range is made of copies of one row and every slice stays bounded.
    The result is materialized: slice numbers never change on a retry.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    merged = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = merged.repartitionByRange(slices, *keys, *order, *rest)
    return cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))


def add_start(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column) -> DataFrame:
    """Add ``_start``: the summed weight of all earlier rows of the key.

    Ordering happens inside ``(key, _slice)``; across slices only one total per
    slice and key is ordered, at most as many rows as there are slices.
    """
    before = (Window.unboundedPreceding, -1)
    tie = [c for c in sliced.columns if c not in keys and c not in order and c not in ("_slice", "_copies")]
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order, *tie).rowsBetween(*before)
    across = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*before)
    spread = weight * F.col("_copies")
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.sum(spread).alias("_slice_weight"))
        .withColumn("_offset", F.coalesce(F.sum("_slice_weight").over(across), F.lit(0)))
        .drop("_slice_weight")
    )
    local = sliced.withColumn("_start", F.coalesce(F.sum(spread).over(inside), F.lit(0)))
    joined = local.join(
        offsets, _same(local, offsets, keys) & (local["_slice"] == offsets["_slice"]), "inner"
    )
    return joined.select(
        *[local[c] for c in sliced.columns], (F.col("_start") + F.col("_offset")).alias("_start")
    )


def bounded_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: Column,
    limit: int,
    reduce_hot: Callable[[DataFrame], DataFrame] = lambda hot: hot,
) -> tuple[DataFrame, DataFrame | None]:
    """``(rest, cut)``: the rows of keys within ``limit``, and, if there are
    others, the rows of oversized keys with their ``part``.

    Every ``(keys, part)`` weighs at most ``limit`` plus one row. ``weight`` must
    be a positive integer expression over the columns of ``df``, none of which
    may be of map type. ``reduce_hot`` may drop rows of oversized keys that do
    not matter to the caller.
    """
    rest, hot, total = split_by_size(df, keys, weight, limit)
    if hot is None:
        return df, None
    hot = reduce_hot(hot)
    slices = slice_count(df, total, limit, SLICE_WEIGHT)
    placed = add_start(slice_in_order(hot, keys, order, slices), keys, order, weight)
    size = weight.cast("long")
    first = F.floor(F.col("_start") / limit).cast("long")
    last = F.floor((F.col("_start") + (F.col("_copies") - 1) * size) / limit).cast("long")

    def copies_before(bound: Column) -> Column:
        # Copies start at start, start + size, ...: those below the bound.
        reached = F.ceil((bound - F.col("_start")) / size).cast("long")
        return F.least(F.col("_copies"), F.greatest(F.lit(0).cast("long"), reached))

    part = F.col("part")
    cut = (
        placed.withColumn("part", F.explode(F.sequence(first, last)))
        .withColumn("_n", copies_before((part + 1) * limit) - copies_before(part * limit))
        # Copies are spread over the parts before they are written out.
        .repartition(*keys, "part")
        .filter("_n > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    )
    return rest, cut.select(*df.columns, "part")


def ordered_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: Column,
    limit: int,
) -> DataFrame:
    """``df`` plus ``part``, see :func:`bounded_parts`."""
    rest, cut = bounded_parts(df, keys, order, weight, limit)
    rest = rest.withColumn("part", F.lit(0).cast("long"))
    return rest if cut is None else rest.unionByName(cut)
