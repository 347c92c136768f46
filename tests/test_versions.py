from __future__ import annotations

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from docloom.operators.versions import alias_actions, stale_versions, version_column, version_name
from docloom.sinks import publish, tables
from tests.conftest import rows

MOMENT = datetime(2024, 12, 31, 20, 30, 5, tzinfo=timezone.utc)


def test_version_names():
    assert version_name("docs", MOMENT, "UTC") == "docs_20241231203005"
    assert version_name("docs", MOMENT, "Asia/Shanghai") == "docs_20250101043005"
    local = MOMENT.astimezone()
    assert version_name("docs", MOMENT, "No/Where") == f"docs_{local:%Y%m%d%H%M%S}"
    assert re.fullmatch(r"docs_\d{14}", version_name("docs"))


def test_version_column(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-12-31 20:30:05' AS ts")
    assert df.select(version_column(F.lit("d"), "ts", "Asia/Shanghai")).first()[0] == "d_20250101043005"
    # As for version names, an unknown zone is the local one.
    assert df.select(version_column(F.lit("d"), "ts", "No/Zone")).first()[0].startswith("d_2024123")


REGISTRY = [("a_1", "a"), ("a_2", "a"), ("a_3", "b"), (".sys", "a")]


def test_all_old_versions_of_an_alias_go(spark):
    registry = spark.createDataFrame(REGISTRY, "version string, alias string")
    targets = spark.createDataFrame([("a_9", "a"), ("n_1", "new"), ("a_3", "b")], "version string, alias string")
    assert rows(alias_actions(registry, targets)) == [
        ("add", "a_3", "b"), ("add", "a_9", "a"), ("add", "n_1", "new"),
        ("remove", "a_1", "a"), ("remove", "a_2", "a"),
    ]


def test_stale_versions(spark):
    day, other = "20240101000000", "20250101000000"
    names = [f"a_{day}", f"a_{other}", f".a_{day}", f"b_{day}", f"a_fr_{day}", "a_notes__2024", f"a_{day}_raw"]
    versions = spark.createDataFrame([(n,) for n in names], "version string")
    aliases = spark.createDataFrame([(f"a_{other}", "a"), (f"a_{other}", "b")], "version string, alias string")
    left = sorted(n for n in names if n not in (f"a_{other}", f".a_{day}"))
    assert rows(stale_versions(versions, aliases)) == [(n,) for n in left]
    # Neither another site's version nor another table under the prefix.
    assert rows(stale_versions(versions, aliases, "a_")) == [(f"a_{day}",)]


@pytest.fixture
def database(spark):
    name = "versions_test"
    tables.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def documents(spark, *items):
    return spark.createDataFrame(
        [(i, b, s, None, None) for i, b, s in items],
        "doc_id string, body string, status int, error_type string, error_reason string",
    )


def test_publish_swap_and_cleanup(spark, database):
    for version, body in (("docs_20240101000001", "one"), ("docs_20240101000002", "two"), ("other_1", "x")):
        publish.write_documents(documents(spark, ("1", body, 201), ("2", body, 400)), database, version)
    publish.publish(spark, database, "docs", "docs_20240101000001", 80)
    assert rows(spark.table(f"{database}.docs")) == [("1", "one")]
    with pytest.raises(publish.PublishRefused):
        publish.publish(spark, database, "docs", "docs_20240101000002", 79)
    assert rows(tables.registry(spark, database)) == [("docs_20240101000001", "docs")]
    publish.publish(spark, database, "docs", "docs_20240101000002", 100)
    assert rows(spark.table(f"{database}.docs")) == [("1", "two")]
    assert rows(publish.find_stale(spark, database, "docs_")) == [("docs_20240101000001",)]
    assert publish.drop_stale(spark, database, "docs_") == ["docs_20240101000001"]
    assert rows(tables.versions(spark, database)) == [("docs_20240101000002",), ("other_1",)]
    with pytest.raises(ValueError):
        publish.swap_alias(spark, database, "docs", "docs_20240101000001")


def test_stage_replaces_and_keeps_empty_tables(spark, database):
    tables.stage(spark.range(3), database, "t", "1")
    assert spark.table(f"{database}.t").count() == 3
    tables.stage(spark.range(0), database, "t", "2")
    assert spark.table(f"{database}.t").count() == 0
    assert spark.table(f"{database}.t").columns == ["id"]
    assert rows(tables.versions(spark, database)) == [("t__2",)]


def test_failed_staging_leaves_the_former_table(spark, database):
    tables.stage(spark.range(3), database, "t", "1")
    broken = spark.range(2).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        tables.stage(broken, database, "t", "2")
    assert spark.table(f"{database}.t").count() == 3


def test_dead_letters_are_appended(spark, tmp_path):
    results = documents(spark, ("1", "a", 201), ("2", "b", 400))
    for _ in range(2):
        publish.write_dead_letters(results, str(tmp_path), "docs_1")
    assert rows(spark.read.json(str(tmp_path / "error_docs_1")), "doc_id", "body") == [("2", "b")] * 2


def test_bulk_files(spark, tmp_path):
    lines = spark.createDataFrame([("1", "a1\nb1\n"), ("2", "a2\nb2\n")], "doc_id string, value string").coalesce(1)
    publish.write_bulk_files(lines, str(tmp_path / "bulk"), max_docs=1)
    files = sorted((tmp_path / "bulk").glob("part-*"))
    assert [f.read_text() for f in files] == ["a1\nb1\n", "a2\nb2\n"]
