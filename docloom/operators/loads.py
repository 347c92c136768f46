"""Load accounting: statuses, rates, the publish gate and dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MIN_SUCCESS = 80


def is_error(status: Column | str = "status") -> Column:
    """True for statuses above 201; a missing answer is an error too."""
    column = F.col(status) if isinstance(status, str) else status
    return F.coalesce(column > 201, F.lit(True))


def load_stats(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by, n_ok, n_err)`` of per-document results."""
    return results.groupBy(*by).agg(
        F.count_if(~is_error()).alias("n_ok"), F.count_if(is_error()).alias("n_err")
    )


def rate(n_ok: Column, n_err: Column) -> Column:
    """Whole percent of successes, rounded down; 0 if nothing was loaded."""
    total = n_ok + n_err
    # Integer arithmetic: exact at any count.
    percent = F.expr("(100 * n_ok) div nullif(n_ok + n_err, 0)")
    return F.when(total == 0, F.lit(0).cast("long")).otherwise(percent)


def success_rate(stats: DataFrame) -> DataFrame:
    """``stats`` plus ``rate``."""
    return stats.withColumn("rate", rate(F.col("n_ok"), F.col("n_err")))


def passes_gate(rates: DataFrame, min_success: int = MIN_SUCCESS) -> DataFrame:
    """``rates`` plus ``publish``: whether the version may become public."""
    return rates.withColumn("publish", F.col("rate") >= min_success)


def dead_letters(results: DataFrame) -> DataFrame:
    """The failed rows of ``results``."""
    return results.filter(is_error())
