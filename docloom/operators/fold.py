"""Folds: many rows of a key into one array or one text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docloom.operators.parts import bounded_parts


def fold_rows(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    make: Callable[[Column], Column],
    weight: Column,
    out: str,
    limit: int | None = None,
) -> DataFrame:
    """``(keys, part, out)``: the rows of each key as an array sorted by ``columns``.

    ``make`` turns one collected row, a struct of ``columns``, into an element.
    Without ``limit`` a key is one row, of ``part`` 0, whatever its size. With it
    groups heavier than ``limit`` continue in parts 1, 2, ...; see
    :mod:`docloom.operators.parts`.
    """
    rest, cut = (df, None) if limit is None else bounded_parts(df, keys, columns, weight, limit)
    items = F.sort_array(F.collect_list(F.struct(*columns)))
    value = F.transform(items, make).alias(out)
    # Grouped by the keys alone, so that a join on them needs no other shuffle.
    whole = rest.groupBy(*keys).agg(value)
    whole = whole.select(*keys, F.lit(0).cast("long").alias("part"), out)
    return whole if cut is None else whole.unionByName(cut.groupBy(*keys, "part").agg(value))


def fold_pairs(
    df: DataFrame,
    key: str,
    k: str,
    v: str,
    order: Sequence[str] = (),
    out: str = "pairs",
    limit: int | None = None,
) -> DataFrame:
    """``(key, part, out)`` with ``out`` an array of one-pair maps ``{k: v}``.

    Pairs are sorted by ``order``, then key and value, so the array does not
    depend on the partitioning. NULL values are kept as pairs.
    """
    order = list(order)
    rows = df.select(key, *order, F.col(k).cast("string").alias("pk"), F.col(v).cast("string").alias("pv"))
    weight = F.octet_length("pk") + F.coalesce(F.octet_length("pv"), F.lit(0)) + F.lit(8)
    return fold_rows(
        rows,
        [key],
        [*order, "pk", "pv"],
        lambda row: F.create_map(row["pk"], row["pv"]),
        weight.cast("long"),
        out,
        limit,
    )


def concat_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sep: str = ",",
    distinct: bool = False,
    order: Sequence[str] = (),
    max_len: int | None = None,
    out: str = "text",
    limit: int | None = None,
) -> DataFrame:
    """``(keys, part, out)``: GROUP_CONCAT with a stated order.

    NULLs are skipped; a group of only NULLs gives NULL. ``distinct`` removes
    repeats per key before anything is collected. ``max_len`` keeps the first
    ``max_len`` characters of the whole text: these lie in part 0, so the
    later parts of an oversized group are not needed.
    """
    keys, order = list(keys), list(order)
    if distinct and order:
        raise ValueError("distinct values are ordered by themselves")
    if max_len is not None and not sep:
        raise ValueError("max_len needs a separator")
    rows = df.select(*keys, *order, F.col(value).cast("string").alias("item"))
    if distinct:
        rows = rows.distinct()

    def one_null(hot: DataFrame) -> DataFrame:
        # Enough to keep a group that holds nothing else.
        void = hot.filter("item IS NULL").select(*keys).distinct()
        return hot.filter("item IS NOT NULL").unionByName(void, allowMissingColumns=True)

    weight = (F.coalesce(F.octet_length("item"), F.lit(0)) + F.lit(8)).cast("long")
    if max_len is not None and limit is not None:
        # A weight is at most 8 times the characters an item adds (4 bytes
        # each, one separator), so part 0 covers the first max_len.
        limit = max(limit, 8 * (max_len + 1))
    rest, cut = (rows, None) if limit is None else bounded_parts(rows, keys, [*order, "item"], weight, limit, one_null)
    items = F.sort_array(F.collect_list(F.when(F.col("item").isNotNull(), F.struct(*order, "item"))))
    text = F.array_join(F.transform(items, lambda row: row["item"]), sep)
    if max_len is not None:
        text = F.left(text, F.lit(max_len))
    value = F.when(F.count("item") > 0, text).alias(out)
    whole = rest.groupBy(*keys).agg(value).select(*keys, F.lit(0).cast("long").alias("part"), out)
    if cut is None:
        return whole
    if max_len is not None:
        cut = cut.filter("part = 0")
    return whole.unionByName(cut.groupBy(*keys, "part").agg(value))
