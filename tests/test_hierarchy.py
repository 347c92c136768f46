from __future__ import annotations

import random

from docloom.operators.hierarchy import ancestor_array, ancestors, csv_member_join
from tests.conftest import rows

PAYLOAD = {"term_id": "catId", "name": "catName", "parent": "parent"}


def terms(spark, pairs):
    data = [(i, f"n{i}", p, t) for i, p, t in pairs]
    return spark.createDataFrame(data, "term_id long, name string, parent long, taxonomy string")


def brute(pairs, max_depth=10, where=lambda t: True):
    """Least depth of every (leaf, ancestor) by walking level by level."""
    kept = [(i, p) for i, p, t in pairs if where(t)]
    parents = {}
    for i, p in kept:
        parents.setdefault(i, set()).add(p)
    found = set()
    for leaf in parents:
        level, seen, depth = {leaf}, {}, 1
        while level and depth <= max_depth:
            for node in level:
                seen.setdefault(node, depth)
            level = {p for n in level for p in parents[n] if p in parents and p not in (None, 0)}
            depth += 1
        found |= {(leaf, n, f"n{n}", p, d) for n, d in seen.items() for p in parents[n]}
    return sorted(found, key=lambda t: [(v is not None, str(v)) for v in t])


CHAIN = [(i, i - 1, "product_cat") for i in range(1, 13)]
ODD = [
    (100, 0, "product_cat"), (101, 100, "product_cat"), (102, 101, "product_cat"),
    (110, 999, "product_cat"), (120, None, "product_cat"),
    (130, 131, "product_cat"), (131, 132, "product_cat"), (132, 130, "product_cat"), (133, 130, "product_cat"),
    (140, 140, "product_cat"), (150, 100, "category"),
]


def test_tree_with_cycles_dangling_and_deep_chains(spark):
    for depth in (1, 2, 10):
        found = ancestors(terms(spark, CHAIN + ODD), "term_id", "parent", ["name"], depth)
        assert found.columns == ["leaf", "id", "name", "parent", "depth"]
        assert rows(found) == brute(CHAIN + ODD, depth)
    deepest = [r for r in rows(found) if r[0] == 12]
    assert len(deepest) == 10 and max(r[4] for r in deepest) == 10


def test_several_parents(spark):
    rng = random.Random(11)
    pairs = list({(rng.randrange(1, 25), rng.randrange(0, 25), "c") for _ in range(45)})
    found = ancestors(terms(spark, pairs + pairs[:5]), "term_id", "parent", ["name"], 6)
    assert rows(found) == brute(pairs, 6)


def test_same_as_recursive_sql(spark):
    nodes = terms(spark, [(i, rng, "c") for i, rng in enumerate([0, 0, 1, 1, 2, 4, 5, 5, 7, 3])])
    nodes.createOrReplaceTempView("tree_nodes")
    wanted = spark.sql(
        """
        WITH RECURSIVE climb(leaf, id, name, parent, depth) AS (
          SELECT term_id, term_id, name, parent, 1 FROM tree_nodes
          UNION ALL
          SELECT c.leaf, n.term_id, n.name, n.parent, c.depth + 1
          FROM climb c JOIN tree_nodes n ON n.term_id = c.parent WHERE c.parent <> 0 AND c.depth < 10)
        SELECT * FROM climb
        """
    )
    assert rows(ancestors(nodes, "term_id", "parent", ["name"])) == rows(wanted)


def test_arrays_of_a_tree(spark):
    where = "taxonomy = 'product_cat'"
    found = ancestor_array(terms(spark, ODD), "term_id", "parent", PAYLOAD, where=where)
    chains = {r["leaf"]: [(c["catId"], c["catName"], c["parent"]) for c in r["categories"]] for r in found.collect()}
    assert chains[102] == [(102, "n102", 101), (101, "n101", 100), (100, "n100", 0)]
    assert chains[110] == [(110, "n110", 999)]
    assert [c[0] for c in chains[133]] == [133, 130, 131, 132]
    assert [c[0] for c in chains[140]] == [140]
    # Excluded by the filter: an empty array, not a missing row.
    assert chains[150] == []
    assert len(chains) == len(ODD)


def test_arrays_with_several_parents_and_small_parts(spark):
    pairs = [(1, 0, "c"), (2, 0, "c"), (3, 1, "c"), (3, 2, "c"), (4, 3, "c"), (5, 4, "x")]
    found = ancestor_array(terms(spark, pairs), "term_id", "parent", PAYLOAD, where="taxonomy = 'c'")
    chains = {r["leaf"]: [(c["catId"], c["parent"]) for c in r["categories"]] for r in found.collect()}
    assert chains[4] == [(4, 3), (3, 1), (3, 2), (1, 0), (2, 0)]
    assert chains[5] == []


def test_no_nodes(spark):
    assert rows(ancestors(terms(spark, []), "term_id", "parent", ["name"])) == []
    assert rows(ancestor_array(terms(spark, [(1, 0, "c")]), "term_id", "parent", PAYLOAD).select("leaf")) == [(1,)]


def test_csv_members(spark):
    left = spark.createDataFrame([(1, "3,1,3"), (2, ""), (3, None), (4, "13")], "id int, csv string")
    right = spark.createDataFrame([(1, "a"), (3, "c"), (13, "m")], "k int, name string")
    found = csv_member_join(left, "csv", right, "k").select("id", "name")
    assert rows(found) == [(1, "a"), (1, "c"), (4, "m")]


def test_long_chains_and_cycles_are_climbed_whole(spark):
    chain = [(i, i - 1, "t") for i in range(1, 40)] + [(100, 101, "t"), (101, 102, "t"), (102, 101, "t")]
    assert rows(ancestors(terms(spark, chain), "term_id", "parent", ["name"])) == brute(chain, 200)
    assert rows(ancestors(terms(spark, chain), "term_id", "parent", ["name"], max_depth=7)) == brute(chain, 7)
