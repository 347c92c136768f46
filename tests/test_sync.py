"""A whole site: WordPress-shaped tables in, published documents out."""

from __future__ import annotations

import json
import time
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from docloom.plans.sync import check_sources, run_export, run_import, sync
from docloom.plans.wordpress import wordpress_spec
from docloom.sinks import publish, tables
from docloom.spec import Assembly, Extract, PipelineSpec, Source
from tests.conftest import rows

MOMENT = datetime(2024, 5, 1, 12, 0, 0, tzinfo=timezone.utc)

POSTS = [
    # ID, type, status, title
    (1, "post", "publish", "Hello"),
    (2, "product", "publish", "Shoe é\"quoted\""),
    (3, "post", "draft", "Hidden"),
    (4, "page", "publish", "No post"),
    (5, "post", "publish", "No category"),
    (6, "post", "publish", "No metadata"),
]
META = [
    (1, "color", "red"), (1, "empty", ""), (1, "none", None),
    (2, "size", "9"), (2, "_product_attributes", 'a:1:{s:5:"width";i:3;}'),
    (2, "_wp_attachment_metadata", "broken"), (3, "x", "y"), (5, "x", "y"),
]
TERMS = [(10, "News"), (20, "Goods"), (21, "Shoes"), (22, "Sneakers")]
TAXONOMY = [  # term_taxonomy_id, term_id, taxonomy, parent
    (110, 10, "category", 0), (120, 20, "product_cat", 0), (121, 21, "product_cat", 20),
    (122, 22, "product_cat", 21), (130, 10, "post_tag", 0),
]
RELATIONS = [(1, 110), (1, 120), (2, 122), (3, 110), (6, 110), (2, 130)]


@pytest.fixture
def site(spark, tmp_path):
    stamp = datetime(2024, 1, 2, 3, 4, 5)
    posts = [(*p, "", "", stamp, stamp, stamp, stamp, "g") for p in POSTS]
    data = {
        "wp_posts": (
            posts,
            "ID long, post_type string, post_status string, post_title string, post_excerpt string, post_name string, "
            "post_date timestamp_ntz, post_date_gmt timestamp_ntz, post_modified timestamp_ntz, "
            "post_modified_gmt timestamp_ntz, guid string",
        ),
        "wp_postmeta": (META, "post_id long, meta_key string, meta_value string"),
        "wp_terms": (TERMS, "term_id long, name string"),
        "wp_term_taxonomy": (TAXONOMY, "term_taxonomy_id long, term_id long, taxonomy string, parent long"),
        "wp_term_relationships": (RELATIONS, "object_id long, term_taxonomy_id long"),
    }
    paths = {}
    for name, (items, schema) in data.items():
        paths[name] = str(tmp_path / name)
        spark.createDataFrame(items, schema).write.parquet(paths[name])
    database = "site_test"
    source = Source("main", "files", tables=paths)
    yield wordpress_spec(source, database, "shop", alias="shop_live", time_zone="UTC")
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def replaced(spec, **changes):
    return replace(spec, **changes)


def test_full_sync(spark, site):
    result = sync(spark, site, moment=MOMENT)
    assert (result.version, result.n_ok, result.n_err, result.rate) == ("shop_20240501120000", 2, 0, 100)
    docs = {r["doc_id"]: json.loads(r["body"]) for r in spark.table("site_test.shop_live").collect()}
    for doc in docs.values():
        assert doc.pop("post_date") == "2024-01-02 03:04:05"
        for other in ("post_date_gmt", "post_modified", "post_modified_gmt", "guid", "post_excerpt", "post_name"):
            doc.pop(other)
    assert docs == {
        # In two categories: one document, the greater category last.
        "1": {
            "ID": 1, "post_type": "post", "post_status": "publish", "post_title": "Hello",
            "cat_id": 20, "cat_name": "Goods",
            "metaArrayJson": [{"color": "red"}, {"empty": ""}],
            "categories": [{"catId": 20, "catName": "Goods", "parent": 0}],
            "wp_attachment_meta_data": None, "product_attributes": None,
        },
        "2": {
            "ID": 2, "post_type": "product", "post_status": "publish", "post_title": "Shoe é\"quoted\"",
            "cat_id": 22, "cat_name": "Sneakers",
            "metaArrayJson": [{"size": "9"}],
            "categories": [
                {"catId": 22, "catName": "Sneakers", "parent": 21},
                {"catId": 21, "catName": "Shoes", "parent": 20},
                {"catId": 20, "catName": "Goods", "parent": 0},
            ],
            "wp_attachment_meta_data": None, "product_attributes": {"width": 3},
        },
        # In a category of the other taxonomy: no chain.
    }
    again = sync(spark, site, do_import=False, moment=MOMENT + timedelta(days=1))
    assert rows(publish.find_stale(spark, "site_test", "shop_")) == [("shop_20240501120000",)]
    assert publish.drop_stale(spark, "site_test", site.prefix) == ["shop_20240501120000"]
    assert tables.target_of(spark, "site_test", "shop_live") == again.version


def test_staged_columns_and_helper_tables(spark, site):
    empty = Extract("nothing", "SELECT * FROM wp_posts WHERE false")
    helper = Assembly("chosen", "SELECT * FROM taxonomy WHERE term_id > 10", kind="table")
    count = Assembly("documents", "SELECT count(*) AS ID, '{lang}' AS lang FROM chosen")
    run_import(spark, replaced(site, extracts=[*site.extracts, empty]))
    assert spark.table("site_test.nothing").count() == 0
    run_export(spark, site, MOMENT + timedelta(days=1))
    assert rows(spark.table("site_test.chains").selectExpr("cat_id", "size(categories)")) == [
        (10, 0), (20, 1), (21, 2), (22, 3),
    ]
    result = run_export(spark, replaced(site, assemblies=[helper, count]), MOMENT)
    # Three of the four staged categories have an id above 10.
    assert [r["doc_id"] for r in spark.table(f"site_test.{result.version}").collect()] == ["3"]


def test_a_transform_reads_the_staged_rows(spark, site):
    seen = []

    def twice(rows):
        seen.append(rows.inputFiles())
        return rows.unionByName(rows)

    terms = replace(next(e for e in site.extracts if e.name == "terms"), transform=twice)
    run_import(spark, replaced(site, extracts=[terms]))
    assert all("terms_raw" in path for path in seen[0]) and seen[0]
    assert spark.table("site_test.terms").count() == 2 * len(TERMS)


def test_large_metadata_stays_one_document(spark, site):
    result = sync(spark, site, moment=MOMENT)
    ids = [r["doc_id"] for r in spark.table(f"site_test.{result.version}").collect()]
    assert sorted(ids) == ["1", "2"]


def test_phases(spark, site):
    assert sync(spark, site, test_only=True) is None
    assert sync(spark, site, do_export=False) is None
    assert spark.table("site_test.posts").count() == 4
    result = sync(spark, site, do_import=False, do_alias=False, moment=MOMENT)
    assert result.rate == 100
    assert not spark.catalog.tableExists("site_test.shop_live")


def test_failing_extract(spark, site):
    bad = replaced(site, extracts=[Extract("bad", "SELECT nope FROM wp_posts"), *site.extracts[:1]])
    with pytest.raises(Exception):
        run_import(spark, bad)
    status = {r["name"]: (r["status"], r["n_rows"]) for r in run_import(spark, bad, on_error="skip").collect()}
    assert status == {"bad": ("failed", None), "posts": ("ok", 4)}


def test_unreachable_source(spark, site):
    gone = replaced(site, sources=[*site.sources, Source("gone", "files", tables={"t": "/no/such/path"})])
    assert {r["name"]: r["status"] for r in check_sources(spark, gone).collect()} == {"main": "ok", "gone": "failed"}
    with pytest.raises(ConnectionError):
        sync(spark, gone, test_only=True)


def test_import_limit(spark, site):
    run_import(spark, replaced(site, import_limit=1))
    assert spark.table("site_test.posts").count() == 1


def test_gate_keeps_the_alias(spark, site):
    sync(spark, site, moment=MOMENT)
    bad = replaced(
        site,
        mapping={"properties": {"cat_name": {"type": "integer"}}},
        assemblies=[*site.assemblies, Assembly("more", "SELECT 99 AS ID, '5' AS cat_name")],
    )
    with pytest.raises(publish.PublishRefused):
        sync(spark, bad, do_import=False, moment=MOMENT + timedelta(days=1))
    assert tables.target_of(spark, "site_test", "shop_live") == "shop_20240501120000"


def test_later_statement_wins_and_brings_columns(spark, site):
    run_import(spark, site)
    more = replaced(site, assemblies=[*site.assemblies, Assembly("more", "SELECT 1L AS ID, 'new' AS extra")])
    result = run_export(spark, more, MOMENT)
    body = spark.table(f"site_test.{result.version}").filter("doc_id = '1'").first()["body"]
    assert json.loads(body)["extra"] == "new" and json.loads(body)["post_title"] is None


def test_json_text_fields_are_decoded(spark, site):
    run_import(spark, site)
    text = replaced(
        site,
        json_fields={"metaArrayJson": "array<map<string,string>>"},
        assemblies=[
            Assembly("a", """SELECT 1 AS ID, '[{"k":"v"},{"_product_attributes":"i:1;"}]' AS metaArrayJson"""),
            Assembly("b", "SELECT 2 AS ID, 'broken' AS metaArrayJson"),
        ],
    )
    result = run_export(spark, text, MOMENT)
    bodies = {r["doc_id"]: json.loads(r["body"]) for r in spark.table(f"site_test.{result.version}").collect()}
    assert bodies["1"] == {"ID": 1, "metaArrayJson": [{"k": "v"}], "product_attributes": 1, "wp_attachment_meta_data": None}
    assert bodies["2"]["metaArrayJson"] == "broken"


def test_delivery_and_dead_letters(spark, site, tmp_path):
    run_import(spark, site)

    def send(payload):
        ids = [json.loads(line)["index"]["_id"] for line in payload.splitlines()[::2]]
        return [(201, None, None) if i == "1" else (400, "parse", "bad") for i in ids]

    more = replaced(site, assemblies=[*site.assemblies, Assembly("no_id", "SELECT CAST(NULL AS LONG) AS ID, 'lost' AS post_title")])
    result = run_export(spark, more, MOMENT, send=send, dead_letter_path=str(tmp_path / "dead"))
    assert (result.n_ok, result.n_err, result.rate) == (1, 2, 33)
    dead = spark.read.json(str(tmp_path / "dead" / f"error_{result.version}"))
    found = {r["doc_id"]: (r["status"], r["body"] is not None) for r in dead.collect()}
    assert found == {"2": (400, True), None: (400, True)}


def test_every_row_without_an_id_is_an_error_of_its_own(spark):
    from docloom.plans.sync import shape
    from docloom.spec import PipelineSpec

    spec = PipelineSpec("s", [], [], [], id_key="id", index_name="x", database="d")
    df = spark.createDataFrame([(k if k < 3 else None, "v") for k in range(8)], "id int, v string")
    df = df.selectExpr("*", "0 AS statement")
    got = shape(df, spec).collect()
    assert sum(r["doc_id"] is None for r in got) == 5 and len(got) == 8


def slow_site(spark, tmp_path, **more):
    spark.range(3).write.parquet(f"{tmp_path}/three")
    source = Source("s", "files", tables={"three": f"{tmp_path}/three"})
    wait = F.udf(lambda i: time.sleep(0.5) or i, "long")
    return PipelineSpec(
        site="s", sources=[source], id_key="id", index_name="i", database="parallel_db", assemblies=[],
        extracts=[
            Extract("first", "SELECT id FROM three", transform=lambda df: df.select(wait("id").alias("id"))),
            Extract("second", "SELECT absent FROM three"),
            Extract("third", "SELECT id FROM three WHERE id < 0"),
        ],
        **more,
    )


def test_extracts_side_by_side(spark, tmp_path):
    site = slow_site(spark, tmp_path)
    found = [tuple(r)[:3] for r in run_import(spark, site, "skip", workers=3).collect()]
    assert found == [("first", "ok", 3), ("second", "failed", None), ("third", "ok", 0)]
    # With one worker the failure stops what has not begun.
    tables.stage(spark.range(9), "parallel_db", "third")
    with pytest.raises(Exception, match="absent"):
        run_import(spark, site, workers=1)
    assert spark.table("parallel_db.third").count() == 9
    started = time.time()
    stuck = F.udf(lambda i: time.sleep(120) or i, "long")
    long = replace(site, extracts=[replace(site.extracts[0], transform=lambda df: df.select(stuck("id").alias("id"))), site.extracts[1]])
    with pytest.raises(Exception, match="absent"):
        run_import(spark, long, workers=2)
    assert time.time() - started < 100


def test_writing_counts(spark, monkeypatch):
    tables.create_database(spark, "parallel_db")
    monkeypatch.setattr(type(spark.range(1)), "count", None)  # nothing is counted by another scan
    assert tables.stage_counted(spark.range(5), "parallel_db", "five") == 5
    assert tables.stage_counted(spark.range(0), "parallel_db", "none") == 0
    assert tables.stage_counted(spark.range(5).where("false"), "parallel_db", "none") == 0


def test_bucketed_staging_joins_without_shuffle(spark):
    tables.create_database(spark, "parallel_db")
    for name, n in (("left_rows", 50), ("right_rows", 70)):
        tables.stage(spark.range(n).withColumn("v", F.col("id") % 3), "parallel_db", name, buckets=4, by=["id"])
    joined = spark.table("parallel_db.left_rows").hint("merge").join(spark.table("parallel_db.right_rows").groupBy("id").agg(F.max("v").alias("w")), "id")
    assert joined.count() == 50
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
