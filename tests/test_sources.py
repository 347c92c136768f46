from __future__ import annotations

from docloom.sources.named import cuts_query
from docloom.sources.ranges import balanced_bounds, balanced_predicates, balanced_range_of
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.shaping import line_breaks
from docloom.sinks.schema import normalize_schema
from docloom.sources.named import extract, read_synonyms
from docloom.sources.ranges import key_bounds, key_ranges, range_predicates
from docloom.spec import Source, render
from tests.conftest import DATA, rows


def keyed(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, v long")


def times_selected(spark, keys, predicates):
    df = keyed(spark, keys)
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    return {r["n"] for r in df.select(hits.alias("n")).collect()}


def test_ranges_select_every_row_once(spark):
    rng = random.Random(7)
    for _ in range(4):
        keys = [rng.randrange(-20_000, 90_000) for _ in range(300)] + [None, None]
        present = [k for k in keys if k is not None]
        predicates = range_predicates("k", min(present), max(present))
        assert len(predicates) > 1
        assert times_selected(spark, keys, predicates) == {1}


def test_last_key_of_an_exact_multiple_is_read(spark):
    keys = [0, 1001 * 12]
    predicates = range_predicates("k", *keys)
    assert times_selected(spark, keys, predicates) == {1}


def test_rows_outside_the_probed_bounds_are_read(spark):
    assert times_selected(spark, [-5, 99_999], range_predicates("k", 0, 50_000)) == {1}


def test_short_span_and_empty_tables_are_read_at_once():
    assert range_predicates("k", 0, 9_999) == ["1 = 1"]
    assert len(range_predicates("k", 0, 10_000)) == 10
    assert range_predicates("k", None, None) == ["1 = 1"]


def test_ranges_widen_instead_of_exceeding_the_task_limit():
    predicates = range_predicates("k", 0, 10**12, max_ranges=500)
    assert len(predicates) == 500


def test_key_bounds_of_nothing_are_null(spark):
    assert rows(key_bounds(keyed(spark, []), "k")) == [(None, None)]


def test_key_ranges_keep_null_keys(spark):
    found = rows(key_ranges(keyed(spark, [0, 1000, 1001, 5000, None]), "k"))
    assert found == [(None, None, None, 1), (0, 0, 1000, 2), (1, 1001, 1001, 1), (4, 5000, 5000, 1)]


def test_limit_is_the_total(spark):
    source = Source("s", "files", tables={"orders": f"{DATA}/orders.parquet"})
    assert extract(spark, source, "SELECT * FROM orders", key="o_orderkey", limit=7).count() == 7
    assert extract(spark, source, "SELECT * FROM orders").count() == 1500


def test_table_names_of_two_sources_do_not_meet(spark):
    one = Source("one", "files", tables={"t": f"{DATA}/nation.parquet"})
    two = Source("two", "files", tables={"t": f"{DATA}/region.parquet"})
    left = extract(spark, one, "SELECT * FROM t")
    right = extract(spark, two, "SELECT * FROM t")
    assert (left.count(), right.count()) == (25, 5)
    assert not spark.catalog.tableExists("t")


def test_csv_source_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;name\n1;x\n2;y\n")
    source = Source("c", "files", {"format": "csv", "header": "true", "sep": ";"}, {"a": str(tmp_path)})
    assert rows(extract(spark, source, "SELECT name FROM a WHERE id = 2")) == [("y",)]


def test_common_table_expressions_and_windows_pass_through(spark):
    source = Source("s", "files", tables={"orders": f"{DATA}/orders.parquet"})
    found = extract(
        spark,
        source,
        """
        WITH ranked AS (
          SELECT o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r,
                 avg(o_totalprice) OVER (PARTITION BY o_custkey ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS a
          FROM orders)
        SELECT o_custkey, r FROM ranked WHERE r = 1 AND a IS NOT NULL
        """,
    )
    assert found.count() == spark.read.parquet(f"{DATA}/orders.parquet").select("o_custkey").distinct().count()


def test_a_view_of_the_caller_survives(spark):
    spark.range(3).createOrReplaceTempView("orders")
    source = Source("s", "files", tables={"orders": f"{DATA}/orders.parquet"})
    assert extract(spark, source, "SELECT o_orderkey FROM orders").count() > 3
    assert spark.table("orders").count() == 3
    spark.catalog.dropTempView("orders")


@pytest.mark.parametrize("url, in_source", [("jdbc:mysql://h/d", True), ("jdbc:oracle:thin:@h", False)])
def test_limit_reaches_the_database(spark, monkeypatch, url, in_source):
    asked = {}

    class Reader:
        def option(self, name, value):
            asked[name] = value
            return self

        def load(self):
            return spark.range(20)

    monkeypatch.setattr("docloom.sources.named._jdbc_reader", lambda *_: Reader())
    assert extract(spark, Source("db", "jdbc", {"url": url}), "SELECT id FROM a;", "id", limit=7).count() == 7
    assert asked["dbtable"].endswith("LIMIT 7) l") == in_source


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        extract(spark, Source("s", "queue"), "SELECT 1")


def test_render_replaces_known_names_only():
    text = '{"path": "{site}-{lang}.{host}.txt", "other": {}}'
    done = render(text, {"host": "h", "site": "s", "lang": "en"})
    assert done == '{"path": "s-en.h.txt", "other": {}}'


def test_jdbc_options(spark, monkeypatch):
    # No database here: what is asked of the reader is checked, not an answer.
    import docloom.sources.named as named

    asked = {}

    class Reader:
        def options(self, **options):
            asked["options"] = options
            return self

        def format(self, form):
            return self

        def option(self, key, value):
            asked[key] = value
            return self

        def load(self):
            return spark.createDataFrame([(0, 20_000)], "lo long, hi long")

        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)
            return "frame"

    class Session:
        read = Reader()

    source = Source("db", "jdbc", {"url": "jdbc:x", "user": "u", "fetchsize": "1000"})
    query = "SELECT id FROM a GROUP BY id ORDER BY id -- last"
    assert named.range_scan(Session(), source, query, "id") == "frame"
    assert asked["dbtable"].startswith("(SELECT MIN(id) AS lo, MAX(id) AS hi FROM (SELECT id FROM a")
    # The query is closed on a line of its own, so its comment ends.
    assert asked["table"] == f"({query}\n) q"
    assert asked["predicates"] == range_predicates("id", 0, 20_000)
    assert asked["properties"] == {"user": "u", "fetchsize": "1000"}


def test_synonym_file(spark, tmp_path):
    path = tmp_path / "synonym.txt"
    path.write_text("TV,Tele Set , teleset\\na, b,\n\n")
    groups = {}
    for row in read_synonyms(spark, str(path)).collect():
        groups.setdefault(row["group_id"], set()).add(row["term"])
    assert sorted(map(sorted, groups.values())) == [["a", "b"], ["tele set", "teleset", "tv"]]


def test_line_breaks(spark):
    df = spark.createDataFrame([("a\\nb",)], "t string").select(line_breaks("t"))
    assert df.first()[0] == "a\nb"


TYPED = """
    SELECT CAST(1 AS TINYINT) AS tiny, CAST(2 AS SMALLINT) AS small, 3 AS whole, 4L AS big, true AS flag,
           CAST(1.5 AS FLOAT) AS f, CAST(2.25 AS DECIMAL(10,2)) AS d,
           CAST(18446744073709551615 AS DECIMAL(20,0)) AS u, CAST('é' AS BINARY) AS b, 'x' AS s,
           DATE '2024-01-02' AS day, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS ts, array(1) AS a,
           CAST(NULL AS INT) AS none
"""


def test_native_schema(spark):
    df = normalize_schema(spark.sql(TYPED))
    assert dict(df.dtypes) == {
        "tiny": "bigint", "small": "bigint", "whole": "bigint", "big": "bigint", "flag": "bigint",
        "f": "double", "d": "decimal(10,2)", "u": "decimal(20,0)", "b": "string", "s": "string",
        "day": "date", "ts": "timestamp_ntz", "a": "array<int>", "none": "bigint",
    }
    row = df.first()
    assert (row["flag"], row["b"], row["none"]) == (1, "é", None)


def test_compat_schema(spark):
    df = normalize_schema(spark.sql(TYPED), "compat")
    kinds = dict(df.dtypes)
    assert (kinds["d"], kinds["u"], kinds["day"], kinds["ts"], kinds["a"]) == (
        "double", "decimal(20,0)", "string", "string", "string",
    )
    row = df.first()
    assert (row["d"], row["day"], row["ts"], row["a"]) == (2.25, "2024-01-02", "2024-01-02 03:04:05", "[1]")
    with pytest.raises(ValueError):
        normalize_schema(df, "loose")


def test_chunk_of_large_keys_is_exact(spark):
    from docloom.sources.ranges import chunk_of

    keys = [8908900000000000000, 1, 1001, 1002, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["c"] for r in df.select("k", chunk_of("k", 1).alias("c")).collect()}
    assert got == {k: None if k is None else (k - 1) // 1001 for k in keys}


def test_balanced_ranges(spark):
    keys = [i**3 for i in range(1_000)] + [5] * 4_000 + [None] * 7
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    bounds = balanced_bounds(df, "k", 10)
    found = [df.where(p).count() for p in balanced_predicates("k", bounds)]
    assert sum(found) == len(keys)
    # The key with most rows has a range to itself and few others.
    assert sorted(found)[-2] <= 2 * len(keys) / 10 and max(found) < 4_600
    placed = df.groupBy(balanced_range_of("k", bounds).alias("part")).count()
    assert sorted(r["count"] for r in placed.collect()) == sorted(n for n in found if n)
    assert balanced_bounds(df.limit(0), "k", 10) == [] and balanced_predicates("k", []) == ["1 = 1"]
    assert balanced_bounds(df, "k", 1) == []
    assert df.select(balanced_range_of("k", []).alias("p")).distinct().count() == 1


def test_balanced_ranges_of_cubes_beyond_a_bigint(spark, tmp_path):
    from docloom.plans.queries import QUERIES

    keys = [k for i in range(0, 54_000_000, 54_000) for k in (i, i + 1)] + [None, 7]
    spark.createDataFrame([(k,) for k in keys], "l_orderkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = QUERIES["balanced_ranges"](spark, str(tmp_path)).first()
    assert tuple(got) == (len(keys), len(keys), True, True, True)


def test_cuts_query_is_plain_sql():
    import duckdb

    database = duckdb.connect()
    database.execute("CREATE TABLE t AS SELECT i * i * i AS k FROM range(100) r(i) UNION ALL SELECT NULL")
    cuts = database.execute(f"SELECT lo FROM {cuts_query('(SELECT * FROM t) q', 'k', 4)} ORDER BY part").fetchall()
    assert [c[0] for c in cuts] == [0, 25**3, 50**3, 75**3]
