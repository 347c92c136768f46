"""Ordered windows that survive one oversized partition key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from docloom.operators.parts import slice_count, slice_in_order, split_by_size

# Rows of one key that a single task may order.
KEY_ROWS = 5_000_000

# Rows of a slice of a larger key, if a smaller limit is named.
SLICE_ROWS = 500_000


def _plain(df, keys, order, lag, running):
    window = Window.partitionBy(*keys).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {
            "rn": F.row_number().over(window).cast("long"),
            **{name: F.lag(col).over(window) for name, col in lag.items()},
            **{name: F.sum(col).over(so_far) for name, col in running.items()},
        }
    )


def running_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lag: Mapping[str, str] | None = None,
    running: Mapping[str, str] | None = None,
    limit: int = KEY_ROWS,
) -> DataFrame:
    """``df`` plus ``rn`` (row number), previous values and running sums per key.

    ``lag`` and ``running`` map new columns to columns of ``df``; ``order`` must
    be total within a key. Keys of up to ``limit`` rows are a plain window. A
    larger key is ordered in slices, and each slice continues from the
    totals of the slices before it.
    """
    lag, running = dict(lag or {}), dict(running or {})
    rest, hot, total = split_by_size(df, keys, F.lit(1).cast("long"), limit)
    plain = _plain(rest, keys, order, lag, running)
    if hot is None:
        return plain
    slices = slice_count(df, total, limit, SLICE_ROWS)
    sliced = slice_in_order(hot, keys, order, slices)
    copies = sliced.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    local = _plain(copies.drop("_copies"), [*keys, "_slice"], [*order, "_copy"], lag, running)
    # What a slice hands on: its row count, its sums, its last values.
    newest = F.struct(*order)
    totals = sliced.groupBy(*keys, "_slice").agg(
        F.sum("_copies").alias("t_rn"),
        *[F.sum(F.col(c) * F.col("_copies")).alias(f"t_{n}") for n, c in running.items()],
        *[F.max_by(c, newest).alias(f"t_{n}") for n, c in lag.items()],
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"k_{k}") for k in keys],
        F.col("_slice").alias("k_slice"),
        F.coalesce(F.sum("t_rn").over(before), F.lit(0)).alias("c_rn"),
        *[F.sum(f"t_{n}").over(before).alias(f"c_{n}") for n in running],
        *[F.lag(f"t_{n}").over(across).alias(f"c_{n}") for n in lag],
    )
    same = [local[k].eqNullSafe(carried[f"k_{k}"]) for k in keys] + [local["_slice"] == carried["k_slice"]]
    joined = local.join(carried, reduce(lambda a, b: a & b, same), "inner")
    first = F.col("rn") == 1
    joined = joined.withColumns(
        {
            **{n: F.when(first, F.col(f"c_{n}")).otherwise(F.col(n)) for n in lag},
            "rn": F.col("rn") + F.col("c_rn"),
            # NULL only while neither this slice nor one before it has a value.
            **{n: F.coalesce(F.col(n) + F.col(f"c_{n}"), F.col(n), F.col(f"c_{n}")) for n in running},
        }
    )
    return plain.unionByName(joined.select(*plain.columns))
