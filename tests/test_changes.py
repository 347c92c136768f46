"""Statements that change staging tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docloom.plans.sync import assemble
from docloom.sinks import changes, tables
from docloom.spec import Assembly, PipelineSpec
from tests.conftest import rows

DB = "changes_db"


@pytest.fixture
def items(spark):
    tables.create_database(spark, DB)
    df = spark.range(0, 40, 1, 4).select("id", (F.col("id") % 3).alias("kind"), F.concat(F.lit("t"), "id").alias("text"))
    tables.stage(df, DB, "items")
    yield f"{DB}.items"
    for table in tables.tables_behind(spark, DB, "items"):
        tables.drop_table(spark, DB, table)
    spark.sql(f"DROP VIEW IF EXISTS {DB}.items")


def plain(n=40):
    return {i: (i, i % 3, f"t{i}") for i in range(n)}


def content(spark, name):
    return rows(spark.table(name))


def expected(found):
    return sorted(found.values(), key=lambda t: [(v is not None, str(v)) for v in t])


def test_delete_rewrites_touched_files_only(spark, items):
    (before,) = changes.segments_of(spark, DB, "items")
    changes.delete(spark, DB, "items", "id IN (3, 4) OR (id > 1000)")
    kept, new = changes.segments_of(spark, DB, "items")
    assert kept.table == before.table and len(kept.excluded) == 1 and not new.excluded
    assert spark.table(f"{DB}.{new.table}").count() == 8
    assert content(spark, items) == expected({i: r for i, r in plain().items() if i not in (3, 4)})
    used = {r[0].rsplit("/", 1)[-1] for r in spark.table(items).select(F.input_file_name()).distinct().collect()}
    assert not used & set(kept.excluded) and len(used) == 4


def test_update_uses_old_values_and_null_conditions_leave_rows(spark, items):
    changes.update(spark, DB, "items", {"kind": "id * 10", "text": "concat(text, '-', kind)"}, "id = 5")
    changes.insert(spark, DB, "items", spark.createDataFrame([(100, None)], "id long, kind long"))
    changes.update(spark, DB, "items", {"text": "'x'"}, "kind > 1000")
    changes.delete(spark, DB, "items", "kind <> kind")
    wanted = plain() | {5: (5, 50, "t5-2"), 100: (100, None, None)}
    assert content(spark, items) == expected(wanted)


def test_condition_with_subquery(spark, items):
    changes.delete(spark, DB, "items", f"id IN (SELECT max(id) FROM {items})")
    assert content(spark, items) == expected({i: r for i, r in plain().items() if i != 39})


def test_merge(spark, items):
    source = spark.createDataFrame([(1, "one"), (2, "gone"), (77, "new"), (None, "none")], "id long, text string")
    changes.merge(spark, DB, "items", source, ["id"], {"text": "concat(t.text, s.text)"}, delete_where="s.text = 'gone'")
    wanted = plain() | {1: (1, 1, "t1one"), 77: (77, None, "new"), None: (None, None, "none")}
    del wanted[2]
    assert content(spark, items) == expected(wanted)
    with pytest.raises(changes.AmbiguousMerge):
        changes.merge(spark, DB, "items", source.unionAll(source), ["id"])
    changes.merge(spark, DB, "items", source.limit(0), ["id"])
    changes.merge(spark, DB, "items", source.where("id = 1"), ["id"], add_missing=False)
    assert content(spark, items) == expected(wanted | {1: (1, 1, "one")})


def test_everything_can_go_and_come_back(spark, items):
    changes.delete(spark, DB, "items")
    assert content(spark, items) == []
    changes.delete(spark, DB, "items")
    changes.insert(spark, DB, "items", spark.createDataFrame([(1, 2, "a")], "id int, kind int, text string"))
    assert content(spark, items) == [(1, 2, "a")]
    with pytest.raises(ValueError, match="no column other"):
        changes.insert(spark, DB, "items", spark.range(1).withColumn("other", F.lit(1)))
    with pytest.raises(ValueError, match="no staging table"):
        changes.segments_of(spark, DB, "absent")


def test_failing_statement_changes_nothing(spark, items):
    before = changes.segments_of(spark, DB, "items")
    with pytest.raises(Exception):
        changes.update(spark, DB, "items", {"kind": "raise_error('stop')"}, "id = 1")
    assert changes.segments_of(spark, DB, "items") == before
    assert content(spark, items) == expected(plain())


def test_concurrent_change_is_refused(spark, items, monkeypatch):
    write = tables.write_table

    def slow(df, database, table):
        write(df, database, table)
        monkeypatch.setattr(tables, "write_table", write)
        changes.insert(spark, DB, "items", spark.createDataFrame([(200, 1, "in between")], "id long, kind long, text string"))

    monkeypatch.setattr(tables, "write_table", slow)
    with pytest.raises(changes.ChangeConflict):
        changes.delete(spark, DB, "items", "id = 1")
    assert content(spark, items) == expected(plain() | {200: (200, 1, "in between")})


def test_many_changes_are_compacted(spark, items, monkeypatch):
    monkeypatch.setattr(changes, "MAX_SEGMENTS", 3)
    for i in range(5):
        changes.insert(spark, DB, "items", spark.createDataFrame([(100 + i, 0, "n")], "id long, kind long, text string"))
    assert len(changes.segments_of(spark, DB, "items")) <= 3
    assert content(spark, items) == expected(plain() | {100 + i: (100 + i, 0, "n") for i in range(5)})
    old = set(tables.tables_behind(spark, DB, "items"))
    tables.stage(spark.table(items).limit(2), DB, "items")
    assert spark.table(items).count() == 2 and not any(spark.catalog.tableExists(f"{DB}.{t}") for t in old)


def test_statements_of_a_site(spark, items):
    spec = PipelineSpec(
        site="s", sources=[], extracts=[], id_key="id", index_name="i", database=DB, lang="3",
        assemblies=[
            Assembly("items", kind="delete", where="id >= {lang}"),
            Assembly("items", "SELECT 9L AS id, 'nine' AS text", kind="insert"),
            Assembly("items", kind="update", values={"kind": "7"}, where="kind IS NULL"),
            Assembly("items", "SELECT 0L AS id, 5L AS kind", kind="merge", on=["id"]),
            Assembly("docs", "SELECT id, kind, text FROM items"),
        ],
    )
    assert rows(assemble(spark, spec).drop("statement")) == [(0, 5, "t0"), (1, 1, "t1"), (2, 2, "t2"), (9, 7, "nine")]
