"""Hierarchies: csv membership joins and ancestor closure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docloom.operators.fold import fold_rows
from docloom.session import broadcast_if_small, cut_lineage


def csv_member_join(left: DataFrame, csv_col: str, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` joined with every ``right`` row whose ``key`` is listed
    in the comma-separated ``csv_col``, i.e. FIND_IN_SET(key, csv_col) > 0.

    The list is exploded so that the match is an equi join. A key listed twice
    matches once, and an empty list has no members.
    """
    members = left.filter(F.col(csv_col) != "").withColumn(
        "member", F.explode(F.array_distinct(F.split(csv_col, ",")))
    )
    return members.join(
        right, members["member"] == right[key].cast("string"), "inner"
    ).drop("member")


def _rows(nodes, id_col, parent_col, payload, where) -> tuple[DataFrame, bool]:
    """Distinct ``(id, *payload, parent, taken)`` rows, materialized, and whether
    every id has one row only (the usual tree)."""
    taken = F.lit(True) if where is None else F.coalesce(
        F.expr(where) if isinstance(where, str) else where, F.lit(False)
    )
    rows = nodes.select(
        F.col(id_col).alias("id"), *payload, F.col(parent_col).alias("parent"), taken.alias("taken")
    )
    rows = cut_lineage(rows.distinct())
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows, repeated.isEmpty()


def _climb(rows: DataFrame, payload: Sequence[str], max_depth: int | None, root: object, single: bool):
    """``(edges, climbed)``: the parent edges of the taken rows, and the chain
    ``(head, id, *payload, parent, depth)`` of every id that occurs as a parent,
    which itself has depth 2.

    Only parents are climbed, not all leaves: these are far fewer in a category
    tree, and a popular parent is climbed once instead of once per child. Each
    round doubles the reach: the ends of the longest ways found so far go on by
    every way known, so a chain of n takes log n rounds. An ancestor reached
    again over a cycle keeps its least depth and is not an end any more.
    """
    kept = rows.filter("taken").drop("taken")
    edges = kept.filter(F.col("parent").isNotNull() & (F.col("parent") != F.lit(root))).select(
        "id", "parent"
    )
    edges = edges if single else edges.distinct()
    heads = edges.select(F.col("parent").alias("head")).distinct()
    near = heads.select("head", F.col("head").alias("at"), F.lit(0).alias("steps"))
    ways, reach = near, 1
    if max_depth is None or max_depth > 2:
        up = heads.join(edges, heads["head"] == edges["id"], "inner")
        one = up.select("head", F.col("parent").alias("at"), F.lit(1).alias("steps")).filter("head <> at")
        ways = near.unionByName(one)
    ways = cut_lineage(ways)
    while (max_depth is None or reach < max_depth - 2) and not (far := ways.filter(F.col("steps") == reach)).isEmpty():
        on = ways.filter("steps > 0").select(
            F.col("head").alias("from"), F.col("at").alias("to"), F.col("steps").alias("more")
        )
        longer = far.join(broadcast_if_small(on), far["at"] == on["from"], "inner").select(
            "head", F.col("to").alias("at"), (F.col("steps") + F.col("more")).alias("steps")
        )
        ways = ways.unionByName(longer).groupBy("head", "at").agg(F.min("steps").alias("steps"))
        ways, reach = cut_lineage(ways), 2 * reach
    ways = ways.withColumn("depth", F.col("steps") + 2).drop("steps")
    if max_depth is not None:
        ways = ways.filter(F.col("depth") <= max_depth)
    # The payload is attached to the few inner nodes, not to every leaf row.
    climbed = ways.join(kept, ways["at"] == kept["id"], "inner").select("head", "id", *payload, "parent", "depth")
    return edges, cut_lineage(climbed)


def ancestors(
    nodes: DataFrame,
    id_col: str,
    parent_col: str,
    payload: Sequence[str] = (),
    max_depth: int | None = None,
    where: Column | str | None = None,
    root: object = 0,
) -> DataFrame:
    """Ancestor closure: ``(leaf, id, *payload, parent, depth)``.

    Every node is a leaf; the leaf itself has depth 1, its parents depth 2 and
    so on, up to ``max_depth`` if that is given. Parents that are NULL, ``root`` or not a node
    end the climb, each ancestor appears once at its least depth (cycles
    included), and ``where`` restricts the nodes that take part.
    """
    rows, single = _rows(nodes, id_col, parent_col, payload, where)
    return _closure(rows, single, payload, max_depth, root)


def _closure(rows, single, payload, max_depth, root) -> DataFrame:
    own = rows.filter("taken").select(
        F.col("id").alias("leaf"), "id", *payload, "parent", F.lit(1).alias("depth")
    )
    if max_depth is not None and max_depth < 2:
        return own
    edges, climbed = _climb(rows, payload, max_depth, root, single)
    chains = broadcast_if_small(climbed)
    children = edges.select(F.col("id").alias("leaf"), F.col("parent").alias("child_of"))
    above = children.join(chains, children["child_of"] == chains["head"], "inner").filter(
        F.col("leaf") != F.col("id")
    )
    columns = ["leaf", "id", *payload, "parent"]
    if single:
        return own.unionByName(above.select(*columns, "depth"))
    # Several parents may lead to one ancestor.
    return own.unionByName(above.groupBy(*columns).agg(F.min("depth").alias("depth")))


def ancestor_array(
    nodes: DataFrame,
    id_col: str,
    parent_col: str,
    payload: Mapping[str, str],
    max_depth: int | None = None,
    where: Column | str | None = None,
    root: object = 0,
    out: str = "categories",
    limit: int | None = None,
) -> DataFrame:
    """``(leaf, part, out)``: each node's chain as an array of structs, leaf first.

    ``payload`` maps node columns, the id and parent among them, to struct
    fields. Nodes that ``where`` excludes get an empty array. ``limit`` cuts the
    chains of ids with several parents into parts of so many bytes; else part is 0.
    """
    names = {id_col: "id", parent_col: "parent"}
    extra = [c for c in payload if c not in names]
    entry = F.struct(*[F.col(names.get(c, c)).alias(field) for c, field in payload.items()])
    rows, single = _rows(nodes, id_col, parent_col, extra, where)
    if single and (max_depth is None or max_depth > 1):
        # Chains of parents are short and few: folded once, then one join.
        _, climbed = _climb(rows, extra, max_depth, root, single)
        chains = climbed.groupBy("head").agg(
            F.sort_array(F.collect_list(F.struct("depth", "id", entry.alias("entry")))).alias("up")
        )
        chains = broadcast_if_small(cut_lineage(chains))
        joined = rows.join(chains, rows["parent"] == chains["head"], "left")
        others = F.filter("up", lambda step: step["id"] != F.col("id"))
        above = F.coalesce(F.transform(others, lambda step: step["entry"]), F.array())
        return joined.select(
            F.col("id").alias("leaf"),
            F.lit(0).cast("long").alias("part"),
            F.when(F.col("taken"), F.concat(F.array(entry), above)).otherwise(F.array()).alias(out),
        )
    closure = _closure(rows, single, extra, max_depth, root)
    order = ["depth", "id", *extra, "parent"]
    size = F.lit(32).cast("long")
    for column in extra:
        size = size + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    element = lambda row: F.struct(*[row[names.get(c, c)].alias(f) for c, f in payload.items()])
    folded = fold_rows(closure, ["leaf"], order, element, size, out, limit)
    leaves = rows.select(F.col("id").alias("leaf")).distinct()
    return leaves.join(folded, "leaf", "left").select(
        "leaf",
        F.coalesce("part", F.lit(0).cast("long")).alias("part"),
        F.coalesce(out, F.array()).alias(out),
    )
