"""Key bounds, range assignment and range predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A key span below THRESHOLD is read at once, others in ranges
# of WIDTH keys.
THRESHOLD = 10_000
WIDTH = 1_001

# Ranges grow beyond WIDTH rather than exceed this number of read tasks.
MAX_RANGES = 10_000


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """One row ``(lo, hi)``: least and greatest key, NULL for no keys."""
    return df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))


def chunk_of(key: Column | str, lo: int, width: int = WIDTH) -> Column:
    """Number of the range of ``width`` keys, counted from ``lo``, that holds ``key``."""
    column = F.col(key) if isinstance(key, str) else key
    offset = F.floor(column) - F.lit(lo)
    # Integer arithmetic: a double cannot tell large keys apart.
    return F.call_function("div", offset - F.pmod(offset, F.lit(width)), F.lit(width)).cast("long")


def key_ranges(df: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """``(chunk, lo, hi, n)``: rows and actual bounds of every non-empty range.

    Rows with a NULL key form the range NULL. The probe brings two numbers to
    the driver; counting combines map-side.
    """
    lo = key_bounds(df, key).first()["lo"] or 0
    return df.groupBy(chunk_of(key, lo, width).alias("chunk")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")
    )


def range_predicates(
    key: str,
    lo: int | None,
    hi: int | None,
    threshold: int = THRESHOLD,
    width: int = WIDTH,
    max_ranges: int = MAX_RANGES,
) -> list[str]:
    """SQL predicates that together select every row exactly once.

    Inclusive ranges ``between a and b``; the first is open below and takes the
    NULL keys, the last is open above, so rows added after the probe are read
    as well. A span below ``threshold`` gives the single predicate ``1 = 1``.
    """
    if lo is None or hi is None or hi - lo < threshold:
        return ["1 = 1"]
    width = max(width, -(-(hi - lo + 1) // max_ranges))
    starts = list(range(lo, hi + 1, width))
    if len(starts) == 1:
        return ["1 = 1"]
    inner = [f"{key} between {a} and {a + width - 1}" for a in starts[1:-1]]
    return [f"{key} <= {starts[0] + width - 1} or {key} is null", *inner, f"{key} >= {starts[-1]}"]


def balanced_bounds(df: DataFrame, key: str, parts: int) -> list:
    """At most ``parts - 1`` ascending keys that cut ``df`` into ranges of about equal row count.

    They come from a quantile summary that tasks build and Spark merges, whatever
    the keys' distribution; its error is a tenth of a range at most. A key that
    holds more rows than a range has one of its own. NULL keys are not counted.
    """
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, shares, 20 * parts).alias("q")).first()["q"]
    return sorted(set(found or []))


def balanced_predicates(key: str, bounds: list) -> list[str]:
    """SQL predicates that together select every row exactly once: half-open ranges between ``bounds``.

    The first is open below and takes the NULL keys, the last is open above.
    """
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {a} and {key} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} or {key} is null", *inner, f"{key} >= {bounds[-1]}"]


def balanced_range_of(key: Column | str, bounds: list) -> Column:
    """Number of the range of ``balanced_predicates`` that holds ``key``."""
    column = F.col(key) if isinstance(key, str) else key
    cuts = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array()
    return F.coalesce(F.size(F.filter(cuts, lambda b: b <= column)), F.lit(0)) if bounds else F.lit(0)
