"""A ready site: WordPress posts and products as nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators.fold import fold_pairs
from docloom.operators.hierarchy import ancestor_array
from docloom.spec import Assembly, Extract, PipelineSpec, Source

# Columns, filters, promoted metadata and target mapping of the site.
POST_COLUMNS = (
    "ID, post_type, post_date, post_date_gmt, post_title, post_excerpt, post_name, post_status, "
    "post_modified, post_modified_gmt, guid"
)
POST_TYPES = "('post', 'product')"
TAXONOMIES = "('category', 'product_cat')"
CHAIN_DEPTH = 10
PROMOTED = {
    "_wp_attachment_metadata": "wp_attachment_meta_data",
    "_product_attributes": "product_attributes",
}
_TEXT = {"type": "text"}
_WHOLE = {"type": "integer"}
_SEARCHED = {"type": "text", "analyzer": "default", "search_analyzer": "shingle_analyzer"}
MAPPING = {
    "dynamic": "false",
    "properties": {
        "id": _WHOLE,
        "cat_id": _WHOLE,
        "cat_name": _TEXT,
        "categories": {"type": "nested", "properties": {"catId": _WHOLE, "catName": _SEARCHED}},
        "metaArrayJson": {"type": "nested", "properties": {"meta_key": _SEARCHED, "meta_value": _SEARCHED}},
        "post_title": {"type": "text", "copy_to": ["searchWords"], "analyzer": "shingle_analyzer"},
        "post_date": _TEXT,
        "post_date_gmt": _TEXT,
        "post_modified": _TEXT,
        "post_modified_gmt": _TEXT,
        "searchWords": _SEARCHED,
    },
}


def _folded_metadata(spark: SparkSession) -> DataFrame:
    """``(ID, metaArrayJson)``: the metadata of the staged posts."""
    published = spark.table("posts").select(F.col("ID").alias("post_id"))
    pairs = spark.table("metadata").join(published, "post_id", "left_semi")
    folded = fold_pairs(pairs, "post_id", "meta_key", "meta_value", out="metaArrayJson")
    return folded.select(F.col("post_id").alias("ID"), "metaArrayJson")


def _chains(spark: SparkSession) -> DataFrame:
    """``(cat_id, cat_name, categories)``: every category with the chain of those above it."""
    named = spark.table("taxonomy").join(spark.table("terms"), "term_id")
    chains = ancestor_array(
        named,
        "term_id",
        "parent",
        {"term_id": "catId", "name": "catName", "parent": "parent"},
        max_depth=CHAIN_DEPTH,
        where="taxonomy = 'product_cat'",
    )
    names = named.select(F.col("term_id").alias("leaf"), F.col("name").alias("cat_name")).distinct()
    return chains.join(names, "leaf").select(F.col("leaf").alias("cat_id"), "cat_name", "categories")


def wordpress_spec(
    source: Source, database: str, site: str = "wordpress", prefix: str = "wp_", **changes
) -> PipelineSpec:
    """The spec of a WordPress site read from ``source``; ``changes`` override its fields.

    Each base table is staged once, as it is; all joins are Spark's. Of a post's
    several categories the one with the greatest id is the document's, chosen
    before the wide rows are joined.
    """
    extracts = [
        Extract(
            "posts",
            f"SELECT {POST_COLUMNS} FROM {prefix}posts WHERE post_type IN {POST_TYPES} AND post_status = 'publish'",
            key="ID",
        ),
        Extract(
            "metadata",
            f"SELECT post_id, meta_key, meta_value FROM {prefix}postmeta WHERE meta_value IS NOT NULL",
            key="post_id",
        ),
        Extract("relations", f"SELECT object_id, term_taxonomy_id FROM {prefix}term_relationships", key="object_id"),
        Extract(
            "taxonomy",
            f"SELECT term_taxonomy_id, term_id, taxonomy, parent FROM {prefix}term_taxonomy WHERE taxonomy IN {TAXONOMIES}",
            key="term_taxonomy_id",
        ),
        Extract("terms", f"SELECT term_id, name FROM {prefix}terms", key="term_id"),
    ]
    assemblies = [
        Assembly("folded", _folded_metadata, kind="table"),
        Assembly("chains", _chains, kind="table"),
        Assembly(
            "documents",
            """
            WITH chosen AS (
              SELECT object_id AS ID, max(term_id) AS cat_id
              FROM relations JOIN taxonomy USING (term_taxonomy_id) JOIN terms USING (term_id)
              GROUP BY object_id)
            SELECT posts.*, cat_id, cat_name, metaArrayJson, categories
            FROM chosen JOIN chains USING (cat_id) JOIN posts USING (ID) JOIN folded USING (ID)
            """,
        ),
    ]
    fields = dict(
        site=site,
        sources=[source],
        extracts=extracts,
        assemblies=assemblies,
        id_key="ID",
        index_name=site,
        database=database,
        lang="en",
        meta_field="metaArrayJson",
        promoted=PROMOTED,
        mapping=MAPPING,
    )
    return PipelineSpec(**{**fields, **changes})
