"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import Scratch


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for all nodes of ``links(u, v)`` that are not the smallest of their component.

    Every round sends the larger neighbours, then the smaller ones, of each
    node to its smallest neighbour, until nothing changes; the rounds are
    logarithmic in the size of a component. Minima are combined in the map
    tasks, and rounds are cut by written tables.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges, number = scratch.table(edges, "edges0"), 0
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.table(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"least{number}")
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.table(large, f"large{number}")
        least = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")), f"smallest{number}")
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        number += 1
        edges = scratch.table(small, f"edges{number}")
        for name in (f"edges{number - 1}", f"least{number - 1}", f"large{number - 1}", f"smallest{number - 1}"):
            scratch.drop(name)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
