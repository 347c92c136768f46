"""The operators as named queries over the given tables, each with its SQL check.

``QUERIES[name]`` takes ``(spark, directory)`` and returns a DataFrame;
``CHECKS[name]`` is SQL for the same rows on the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docloom.functions.phpvalue import php_to_json
from docloom.functions.shaping import (
    compact_time, decode_json_fields, decode_json_mixed, json_kind, promote_meta, to_document_json,
)
from docloom.operators.documents import append_documents, bulk_batches, keep_last, to_bulk_lines
from docloom.operators.fold import concat_group, fold_pairs
from docloom.operators.hierarchy import ancestor_array, ancestors, csv_member_join
from docloom.operators.loads import dead_letters, load_stats, passes_gate, success_rate
from docloom.operators.text import (
    ENGLISH_STOP_WORDS, analyze, apply_mapping, copy_to, field_tokens, lowercase_normal, mapping_errors,
    remove_spaces, special_chars_to_space, synonym_graph, text_parts, tokenize,
)
from docloom.operators.versions import alias_actions, alias_intervals, stale_versions, version_column
from docloom.operators.windows import running_window
from docloom.plans.sync import sync
from docloom.session import broadcast_if_small, shared_folder, spread
from docloom.sinks import changes, tables
from docloom.sinks.bulk import read_bulk, write_bulk
from docloom.sinks.schema import normalize_schema
from docloom.sources.named import extract, synonym_groups
from docloom.sources.ranges import (
    WIDTH, balanced_bounds, balanced_predicates, balanced_range_of, chunk_of, key_bounds, key_ranges,
)
from docloom.spec import Assembly, Extract, PipelineSpec, Source

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if check:
            CHECKS[name] = check
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def wide(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """A table for CPU-bound work: small files are spread over the cores."""
    return spread(table(spark, sf, name).select(*columns))


def files(sf: str, *names: str, source: str = "files") -> Source:
    return Source(source, "files", tables={n: f"{sf}/{n}.parquet" for n in names})


# --- sources -----------------------------------------------------------------


@query("key_bounds", "SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem")
def _key_bounds(spark, sf):
    return key_bounds(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "range_chunks",
    """
    SELECT CAST(floor((l_orderkey - (SELECT min(l_orderkey) FROM lineitem)) / 1001) AS BIGINT) AS chunk,
           min(l_orderkey) AS lo, max(l_orderkey) AS hi, count(*) AS n
    FROM lineitem GROUP BY 1
    """,
)
def _range_chunks(spark, sf):
    return key_ranges(table(spark, sf, "lineitem"), "l_orderkey")


# A key whose values lie far apart at one end and close at the other. Cubes of
# keys above 2,097,151 exceed a bigint.
SPARSE_KEY = "CAST(l_orderkey AS DECIMAL(38, 0)) * l_orderkey * l_orderkey"


@query(
    "balanced_ranges",
    "SELECT count(*) AS n_rows, count(*) AS n_once, true AS in_order, true AS balanced, true AS many FROM lineitem",
)
def _balanced_ranges(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.expr(SPARSE_KEY).alias("k"))
    bounds = balanced_bounds(rows, "k", 16)
    chosen = [F.when(F.expr(p), 1).otherwise(0) for p in balanced_predicates("k", bounds)]
    placed = rows.select("k", balanced_range_of("k", bounds).alias("part"), sum(chosen[1:], chosen[0]).alias("times"))
    parts = placed.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("times") == 1).alias("once"), F.min("k").alias("lo"), F.max("k").alias("hi")
    )
    before = F.lag("hi").over(Window.orderBy("part"))  # a row for each range
    return parts.withColumn("after", F.coalesce(F.col("lo") > before, F.lit(True))).agg(
        F.sum("n").alias("n_rows"), F.sum("once").alias("n_once"), F.every("after").alias("in_order"),
        (F.max("n") <= 2 * F.avg("n")).alias("balanced"), (F.count(F.lit(1)) > 12).alias("many"),
    )


# The limit counts rows of the extract, whichever they are; those it keeps must be rows of the source.
@query(
    "import_limit",
    "SELECT least(count(*), 100) AS n, least(count(*), 100) AS n_known, least(count(*), 100) AS n_distinct FROM orders",
)
def _import_limit(spark, sf):
    rows = extract(spark, files(sf, "orders"), "SELECT * FROM orders", limit=100)
    known = table(spark, sf, "orders").withColumn("known", F.lit(1))
    found = rows.join(known, rows.columns, "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("n_known"), F.countDistinct("o_orderkey").alias("n_distinct"))


@query(
    "param_query",
    "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'",
)
def _param_query(spark, sf):
    return extract(
        spark,
        files(sf, "documents"),
        "SELECT doc_id, lang, n_chars FROM documents WHERE lang = :lang",
        args={"lang": "en"},
    )


@query(
    "federated_join",
    """
    SELECT c_mktsegment, n_name, count(*) AS n
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
    """,
)
def _federated_join(spark, sf):
    # Two sources that use the same table name for different tables.
    people = Source("people", "files", tables={"rows": f"{sf}/customer.parquet"})
    places = Source("places", "files", tables={"rows": f"{sf}/nation.parquet"})
    left = extract(spark, people, "SELECT c_mktsegment, c_nationkey FROM rows")
    right = extract(spark, places, "SELECT n_nationkey, n_name FROM rows")
    return (
        left.join(right, left["c_nationkey"] == right["n_nationkey"])
        .groupBy("c_mktsegment", "n_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "synonym_groups",
    """
    WITH lines AS (
      SELECT DISTINCT unnest([trim(p_type || ', ' || p_name), trim(p_name || ' ')]) AS line FROM part)
    SELECT DISTINCT md5(line) AS group_id, lower(trim(term)) AS term
    FROM (SELECT line, unnest(string_split(line, ',')) AS term FROM lines) WHERE trim(term) <> ''
    """,
)
def _synonym_groups(spark, sf):
    # One file line per part, holding two groups and an empty one.
    lines = table(spark, sf, "part").select(
        F.concat("p_type", F.lit(", "), "p_name", F.lit("\\n\\n"), "p_name", F.lit(" ")).alias("value")
    )
    return synonym_groups(lines)


# --- projections and filters ---------------------------------------------------


@query(
    "normalize_schema",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem
    """,
)
def _normalize_schema(spark, sf):
    return normalize_schema(table(spark, sf, "lineitem"))


@query(
    "normalize_compat",
    """
    SELECT o_orderkey, o_orderpriority AS priority, CAST(o_orderstatus = 'F' AS BIGINT) AS done_flag,
           CAST(o_totalprice AS DOUBLE) AS price, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at
    FROM orders
    """,
)
def _normalize_compat(spark, sf):
    typed = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").cast("binary").alias("priority"),
        (F.col("o_orderstatus") == "F").alias("done_flag"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").alias("at"),
    )
    return normalize_schema(typed, "compat")


@query(
    "project_filter",
    """
    SELECT o.o_orderkey AS orderkey, o.o_orderpriority AS priority, o.o_orderdate AS ordered_on,
           o.o_orderstatus || '/' || o.o_orderpriority AS label
    FROM orders o WHERE o.o_orderstatus IN ('F', 'O') AND o.o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
    """,
)
def _project_filter(spark, sf):
    return extract(
        spark,
        files(sf, "orders"),
        """
        SELECT o.o_orderkey AS orderkey, o.o_orderpriority AS priority, o.o_orderdate AS ordered_on,
               concat(o.o_orderstatus, '/', o.o_orderpriority) AS label
        FROM orders o
        WHERE o.o_orderstatus IN ('F', 'O') AND o.o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
        """,
    )


@query(
    "null_or_length",
    """
    SELECT event_id, event_type, coalesce(nullif(event_type, 'error'), 'none') AS kind,
           event_type || nullif(props, '') AS joined
    FROM (SELECT event_id, event_type, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '' ELSE props END AS props
          FROM events)
    WHERE (props IS NOT NULL OR strlen(props) > 0) AND event_type IN ('click', 'error', 'view')
    """,
)
def _null_or_length(spark, sf):
    # Empty strings stay, NULLs go: the predicate as the metadata extract has it.
    return extract(
        spark,
        files(sf, "events"),
        """
        SELECT event_id, event_type, ifnull(nullif(event_type, 'error'), 'none') AS kind,
               concat(event_type, nullif(props, '')) AS joined
        FROM (SELECT event_id, event_type,
                     CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '' ELSE props END AS props FROM events)
        WHERE (props IS NOT NULL OR octet_length(props) > 0) AND event_type IN ('click', 'error', 'view')
        """,
    )


@query(
    "find_in_set",
    """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    """,
)
def _find_in_set(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").filter(
        F.find_in_set("o_orderpriority", F.lit("2-HIGH,1-URGENT")) > 0
    )


# --- joins -----------------------------------------------------------------------


@query(
    "csv_member_join",
    """
    SELECT c_custkey, n_name FROM customer
    JOIN nation ON n_nationkey = c_nationkey OR n_nationkey = (c_nationkey + 7) % 25
    """,
)
def _csv_member_join(spark, sf):
    lists = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat_ws(",", "c_nationkey", (F.col("c_nationkey") + 7) % 25, "c_nationkey").alias("nations"),
    )
    joined = csv_member_join(lists, "nations", table(spark, sf, "nation"), "n_nationkey")
    return joined.select("c_custkey", "n_name")


@query(
    "inner_join",
    """
    SELECT c_custkey, c_name, n_name AS cat_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def _inner_join(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "inner").select(
        "c_custkey", "c_name", F.col("n_name").alias("cat_name")
    )


@query(
    "left_chain",
    """
    SELECT o_orderkey AS ID, c_custkey AS cat_id, n_name AS cat_name, r_name AS taxonomy
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN ('ASIA', 'EUROPE') AND o_orderstatus IN ('F', 'O')
    """,
)
def _left_chain(spark, sf):
    return extract(
        spark,
        files(sf, "orders", "customer", "nation", "region"),
        """
        SELECT o_orderkey AS ID, c_custkey AS cat_id, n_name AS cat_name, r_name AS taxonomy
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE r_name IN ('ASIA', 'EUROPE') AND o_orderstatus IN ('F', 'O')
        """,
    )


# Categories made of regions (roots), nations and customers (leaves).
TAXONOMY = """
    SELECT CAST(1 + r_regionkey AS BIGINT) AS term_id, r_name AS name, CAST(0 AS BIGINT) AS parent,
           'product_cat' AS taxonomy FROM region
    UNION ALL
    SELECT CAST(100 + n_nationkey AS BIGINT), n_name, CAST(1 + n_regionkey AS BIGINT), 'product_cat' FROM nation
    UNION ALL
    SELECT 10000 + c_custkey, c_name, CAST(100 + c_nationkey AS BIGINT),
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'category' ELSE 'product_cat' END FROM customer
"""

CLOSURE = f"""
    WITH RECURSIVE nodes AS ({TAXONOMY}),
    climb AS (
      SELECT term_id AS leaf, term_id, name, parent, 1 AS depth FROM nodes WHERE taxonomy = 'product_cat'
      UNION ALL
      SELECT c.leaf, n.term_id, n.name, n.parent, c.depth + 1
      FROM climb c JOIN nodes n ON n.term_id = c.parent AND n.taxonomy = 'product_cat' WHERE c.depth < 10)
"""


def taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark, files(sf, "region", "nation", "customer"), TAXONOMY)


@query("ancestor_closure", CLOSURE + "SELECT leaf, term_id, name, parent, depth FROM climb")
def _ancestor_closure(spark, sf):
    closure = ancestors(
        taxonomy(spark, sf), "term_id", "parent", ["name"], where="taxonomy = 'product_cat'"
    )
    return closure.withColumnRenamed("id", "term_id")


@query(
    "category_arrays",
    CLOSURE
    + """
    SELECT t.term_id AS leaf, count(c.leaf) AS n,
           coalesce(string_agg(c.term_id || ':' || c.name || ':' || c.parent, '>' ORDER BY c.depth), '') AS chain
    FROM nodes t LEFT JOIN climb c ON c.leaf = t.term_id GROUP BY t.term_id
    """,
)
def _category_arrays(spark, sf):
    arrays = ancestor_array(
        taxonomy(spark, sf),
        "term_id",
        "parent",
        {"term_id": "catId", "name": "catName", "parent": "parent"},
        where="taxonomy = 'product_cat'",
    )
    # Parts of one chain, if any, are rows of their own.
    entry = lambda c: F.concat_ws(":", c["catId"], c["catName"], c["parent"])
    return arrays.select(
        "leaf",
        F.size("categories").cast("long").alias("n"),
        F.array_join(F.transform("categories", entry), ">").alias("chain"),
    )


@query(
    "deep_closure",
    """
    WITH RECURSIVE nodes AS (
      SELECT DISTINCT conv_id * 1000 + turn + 1 AS id,
             CASE WHEN turn = 0 THEN 0 ELSE conv_id * 1000 + turn END AS parent FROM conversations),
    climb AS (
      SELECT id AS leaf, id, parent, 1 AS depth FROM nodes
      UNION ALL
      SELECT c.leaf, n.id, n.parent, c.depth + 1 FROM climb c JOIN nodes n ON n.id = c.parent)
    SELECT leaf, id, parent, depth FROM climb
    """,
)
def _deep_closure(spark, sf):
    base = F.col("conv_id") * 1000 + F.col("turn")
    nodes = table(spark, sf, "conversations").select(
        (base + 1).alias("id"), F.when(F.col("turn") == 0, 0).otherwise(base).alias("parent")
    )
    return ancestors(nodes, "id", "parent")


# --- folds -------------------------------------------------------------------------


def event_fold(spark: SparkSession, sf: str) -> DataFrame:
    return fold_pairs(table(spark, sf, "events"), "user_id", "event_type", "event_id", ["event_id"])


@query(
    "meta_fold",
    "SELECT user_id, event_type AS k, CAST(event_id AS VARCHAR) AS v FROM events",
)
def _meta_fold(spark, sf):
    pairs = event_fold(spark, sf).select("user_id", F.explode("pairs").alias("pair"))
    return pairs.select("user_id", F.explode("pair").alias("k", "v"))


@query(
    "concat_group",
    """
    SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_list
    FROM orders GROUP BY o_custkey
    """,
)
def _concat_group(spark, sf):
    return concat_group(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", order=["o_orderkey"], out="order_list"
    ).drop("part")


@query(
    "concat_distinct",
    """
    SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds
    FROM events GROUP BY user_id
    """,
)
def _concat_distinct(spark, sf):
    return concat_group(
        table(spark, sf, "events"), ["user_id"], "event_type", distinct=True, out="kinds"
    ).drop("part")


@query(
    "concat_max_len",
    """
    SELECT o_custkey, substr(string_agg(o_orderpriority, ', ' ORDER BY o_orderkey, o_orderpriority), 1, 40) AS priorities
    FROM orders GROUP BY o_custkey
    """,
)
def _concat_max_len(spark, sf):
    return concat_group(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", ", ", order=["o_orderkey"],
        max_len=40, out="priorities",
    ).drop("part")


# Bytes near the largest groups of the given tables, so that some are cut and most are not.
FOLD_LIMIT, LIST_LIMIT = 1_400, 240


@query(
    "fold_parts",
    f"""
    WITH r AS (SELECT user_id, event_id, CAST(strlen(event_type) + strlen(CAST(event_id AS VARCHAR)) + 8 AS BIGINT) AS w FROM events),
    s AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY user_id ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
          sum(w) OVER (PARTITION BY user_id) AS total FROM r)
    SELECT user_id, CASE WHEN total > {FOLD_LIMIT} THEN CAST(start // {FOLD_LIMIT} AS BIGINT) ELSE 0 END AS part,
           count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
    FROM s GROUP BY ALL
    """,
)
def _fold_parts(spark, sf):
    pairs = fold_pairs(
        table(spark, sf, "events"), "user_id", "event_type", "event_id", ["event_id"], limit=FOLD_LIMIT
    )
    values = F.flatten(F.transform("pairs", F.map_values))
    return pairs.select(
        "user_id", "part", F.size("pairs").cast("long").alias("n"), F.array_join(values, ",").alias("ids")
    )


@query(
    "concat_parts",
    f"""
    WITH r AS (SELECT o_custkey, o_orderkey, CAST(strlen(CAST(o_orderkey AS VARCHAR)) + 8 AS BIGINT) AS w FROM orders),
    s AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
          sum(w) OVER (PARTITION BY o_custkey) AS total FROM r)
    SELECT o_custkey, CASE WHEN total > {LIST_LIMIT} THEN CAST(start // {LIST_LIMIT} AS BIGINT) ELSE 0 END AS part,
           string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_list
    FROM s GROUP BY ALL
    """,
)
def _concat_parts(spark, sf):
    return concat_group(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", order=["o_orderkey"], out="order_list",
        limit=LIST_LIMIT,
    )


def parsed(documents: DataFrame, shape: str) -> DataFrame:
    """Document bodies parsed back into columns; the generator parses each one once."""
    return documents.select("doc_id", "body", F.inline_outer(F.array(F.from_json("body", shape))))


# --- shaping -----------------------------------------------------------------------


@query(
    "json_extract",
    """
    SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
           CASE event_type WHEN 'error' THEN props WHEN 'signup' THEN '[' || props END AS field_raw
    FROM events
    """,
)
def _json_extract(spark, sf):
    # By event type: arrays, an object, broken text, and empty text.
    kind = F.col("event_type")
    text = (
        F.when(kind.isin("view", "click"), F.concat(F.lit("["), "props", F.lit("]")))
        .when(kind == "error", F.col("props"))
        .when(kind == "signup", F.concat(F.lit("["), "props"))
        .otherwise("")
    )
    rows = table(spark, sf, "events").select("event_id", text.alias("field"))
    decoded = decode_json_fields(rows, {"field": "array<struct<k: bigint>>"})
    return decoded.select("event_id", F.get("field", F.lit(0))["k"].alias("k"), "field_raw")


@query(
    "json_mixed",
    """
    WITH e AS (
        SELECT event_id, event_type,
               CASE event_type WHEN 'error' THEN props WHEN 'signup' THEN '[' || props WHEN 'purchase' THEN NULL
               ELSE '[' || props || ', ' || user_id || ', "' || event_type || '", null, [' || event_id || ', "x"], true]' END AS field
        FROM events
    ), d AS (SELECT *, CASE WHEN event_type NOT IN ('error', 'signup') THEN field END AS good FROM e)
    SELECT event_id, json_array_length(good) AS n,
           CASE WHEN good IS NOT NULL THEN 'object,number,text,null,array,boolean' END AS kinds,
           CAST(json_extract(good, '$[0].k') AS BIGINT) AS k, CAST(json_extract(good, '$[1]') AS BIGINT) AS user_id,
           json_extract_string(good, '$[2]') AS word, CAST(json_extract(good, '$[4][0]') AS BIGINT) AS inner_id,
           CASE WHEN good IS NULL THEN field END AS field_raw
    FROM d
    """,
)
def _json_mixed(spark, sf):
    # By event type: arrays of mixed elements, an object, broken text, and none.
    kind = F.col("event_type")
    mixed = F.concat(
        F.lit("["), "props", F.lit(", "), F.col("user_id").cast("string"), F.lit(', "'), "event_type", F.lit('", null, ['),
        F.col("event_id").cast("string"), F.lit(', "x"], true]'),
    )
    text = F.when(kind == "error", F.col("props")).when(kind == "signup", F.concat(F.lit("["), "props")).when(kind != "purchase", mixed)
    decoded = decode_json_mixed(table(spark, sf, "events").select("event_id", text.alias("field")), ["field"])
    at = [F.get("field", F.lit(k)) for k in range(5)]
    return decoded.select(
        "event_id",
        F.when(F.col("field").isNotNull(), F.size("field")).cast("long").alias("n"),
        F.array_join(F.transform("field", json_kind), ",").alias("kinds"),
        F.try_variant_get(at[0], "$.k", "long").alias("k"),
        F.try_variant_get(at[1], "$", "long").alias("user_id"),
        F.try_variant_get(at[2], "$", "string").alias("word"),
        F.try_variant_get(at[4], "$[0]", "long").alias("inner_id"),
        "field_raw",
    )


@query(
    "promote_meta",
    """
    SELECT user_id, CAST(max(event_id) FILTER (event_type = 'signup') AS VARCHAR) AS last_signup,
           CAST(max(event_id) FILTER (event_type = 'error') AS VARCHAR) AS last_error,
           count(*) FILTER (event_type NOT IN ('signup', 'error')) AS n_rest,
           coalesce(string_agg(event_type || '=' || event_id, ',' ORDER BY event_id)
                    FILTER (event_type NOT IN ('signup', 'error')), '') AS rest
    FROM events GROUP BY user_id
    """,
)
def _promote_meta(spark, sf):
    promoted = promote_meta(
        event_fold(spark, sf), "pairs", {"signup": "last_signup", "error": "last_error"}, decoder=None
    )
    pair = lambda m: F.concat_ws("=", F.get(F.map_keys(m), F.lit(0)), F.get(F.map_values(m), F.lit(0)))
    return promoted.select(
        "user_id",
        "last_signup",
        "last_error",
        F.size("pairs").cast("long").alias("n_rest"),
        F.array_join(F.transform("pairs", pair), ",").alias("rest"),
    )


def _serialized() -> F.Column:
    # a:3:{s:4:"type";s:<bytes>:"<event_type>";s:1:"k";i:<k>;s:1:"l";a:2:{i:0;i:<id>;i:1;b:1;}}
    return F.concat(
        F.lit('a:3:{s:4:"type";s:'), F.octet_length("event_type"), F.lit(':"'), "event_type",
        F.lit('";s:1:"k";i:'), F.get_json_object("props", "$.k"), F.lit(';s:1:"l";a:2:{i:0;i:'),
        F.col("event_id"), F.lit(";i:1;b:1;}}"),
    )


@query(
    "php_decode",
    """
    SELECT event_id, event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           '[' || event_id || ',true]' AS l
    FROM events
    """,
)
def _php_decode(spark, sf):
    events = wide(spark, sf, "events", "event_id", "event_type", "props")
    decoded = events.select("event_id", php_to_json(_serialized()).alias("doc"))
    return decoded.select(
        "event_id",
        F.get_json_object("doc", "$.type").alias("kind"),
        F.get_json_object("doc", "$.k").cast("long").alias("k"),
        F.get_json_object("doc", "$.l").alias("l"),
    )


@query(
    "promote_serialized",
    """
    SELECT event_id, event_type = 'signup' AS found, CASE WHEN event_type = 'signup' THEN event_type END AS kind,
           CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END AS first_of_l,
           CASE WHEN event_type <> 'signup' THEN event_type END AS rest_key
    FROM events
    """,
)
def _promote_serialized(spark, sf):
    # A pair per event, decoded only where its key is promoted, then encoded as a document.
    rows = wide(spark, sf, "events", "event_id", "event_type", "props").select(
        "event_id", F.array(F.create_map("event_type", _serialized())).alias("meta")
    )
    shaped = promote_meta(rows, "meta", {"signup": "attributes"})
    body = to_document_json(shaped, "event_id", json_columns=["attributes"], keep=["event_id"])
    rest = F.get(F.json_object_keys(F.get_json_object("body", "$.meta[0]")), F.lit(0))
    return body.select(
        "event_id",
        F.get_json_object("body", "$.attributes").isNotNull().alias("found"),
        F.get_json_object("body", "$.attributes.type").alias("kind"),
        F.get_json_object("body", "$.attributes.l[0]").alias("first_of_l"),
        rest.alias("rest_key"),
    )


@query(
    "doc_json",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_custkey AS custkey, c_name AS name, c_acctbal AS acctbal,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment,
           'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey' AS key_order
    FROM customer
    """,
)
def _doc_json(spark, sf):
    rows = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    )
    bodies = to_document_json(rows, "c_custkey")
    shape = "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string"
    return parsed(bodies, shape).select(
        "doc_id",
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        F.array_join(F.json_object_keys("body"), ",").alias("key_order"),
    )


# --- documents -----------------------------------------------------------------------


@query(
    "assemble_documents",
    CLOSURE
    + """,
    chains AS (SELECT leaf, string_agg(name, '>' ORDER BY depth) AS chain FROM climb GROUP BY leaf),
    metas AS (
      SELECT l_orderkey, count(*) AS n_pairs,
             string_agg('line' || l_linenumber || '=' || l_partkey, ','
                        ORDER BY l_linenumber, 'line' || l_linenumber, CAST(l_partkey AS VARCHAR)) AS pairs
      FROM lineitem GROUP BY l_orderkey)
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderpriority AS title, 10000 + o_custkey AS cat_id,
           c_name AS cat_name, n_pairs, pairs, coalesce(chain, '') AS chain
    FROM orders JOIN metas ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
    LEFT JOIN chains ON leaf = 10000 + o_custkey
    """,
)
def _assemble_documents(spark, sf):
    bodies = assemble_documents(spark, sf)
    shape = (
        "post_title string, cat_id bigint, cat_name string, "
        "metaArrayJson array<map<string,string>>, categories array<struct<catName: string>>"
    )
    pair = lambda m: F.concat_ws("=", F.get(F.map_keys(m), F.lit(0)), F.get(F.map_values(m), F.lit(0)))
    return parsed(bodies, shape).select(
        "doc_id",
        F.col("post_title").alias("title"),
        "cat_id",
        "cat_name",
        F.size("metaArrayJson").cast("long").alias("n_pairs"),
        F.array_join(F.transform("metaArrayJson", pair), ",").alias("pairs"),
        F.array_join("categories.catName", ">").alias("chain"),
    )


def assemble_documents(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, body)``: orders with line metadata and the customer's category chain.

    Metadata and chains are folded before the join, so the join adds no rows
    but the further parts of oversized documents. Owners and their chains are
    joined first: the documents meet them once, without a shuffle if they are few.
    """
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("line"), "l_linenumber").alias("k"), "l_partkey"
    )
    owners = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("owner"),
        (F.col("c_custkey") + 10000).alias("cat_id"),
        F.col("c_name").alias("cat_name"),
    )
    cates = ancestor_array(
        taxonomy(spark, sf),
        "term_id",
        "parent",
        {"term_id": "catId", "name": "catName", "parent": "parent"},
        where="taxonomy = 'product_cat'",
    ).select(F.col("leaf").alias("cat_id"), F.col("part").alias("chain_part"), "categories")
    views = {
        "posts": wide(
            spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus", "o_custkey"
        ).select(
            F.col("o_orderkey").alias("ID"),
            F.col("o_orderpriority").alias("post_title"),
            F.col("o_orderdate").alias("post_date"),
            F.col("o_orderstatus").alias("post_status"),
            F.col("o_custkey").alias("owner"),
        ),
        "post_meta": fold_pairs(
            lines, "l_orderkey", "k", "l_partkey", ["l_linenumber"], out="metaArrayJson"
        ).withColumnRenamed("l_orderkey", "ID"),
        "post_cates": broadcast_if_small(owners.join(cates, "cat_id")),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    documents = spark.sql(
        """
        SELECT wp.ID, wp.post_title, wp.post_date, wp.post_status, pc.cat_id, pc.cat_name,
               pm.metaArrayJson, pc.categories, pm.part, pc.chain_part
        FROM posts wp
        JOIN post_meta pm ON wp.ID = pm.ID
        JOIN post_cates pc ON wp.owner = pc.owner
        """
    )
    for name in views:
        spark.catalog.dropTempView(name)
    return to_document_json(documents, "ID", parts=["part", "chain_part"])


@query(
    "append_union",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance, 0 AS statement
    FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_acctbal, 1 FROM supplier
    """,
)
def _append_union(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return append_documents([customer, supplier])


@query(
    "keep_last",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, l_shipdate
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC,
      l_returnflag DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
      l_linestatus DESC, l_shipdate DESC) = 1
    """,
)
def _keep_last(spark, sf):
    return keep_last(
        table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_returnflag"]
    )


@query(
    "keep_last_statement",
    """
    SELECT doc_id, name, kind FROM (
      SELECT c_nationkey AS doc_id, c_name AS name, 'customer' AS kind, 0 AS statement, c_custkey AS k FROM customer
      UNION ALL SELECT s_nationkey, s_name, 'supplier', 1, s_suppkey FROM supplier)
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY statement DESC, k DESC) = 1
    """,
)
def _keep_last_statement(spark, sf):
    # Ids repeated across statements: the later statement wins.
    customer = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("doc_id"), F.col("c_name").alias("name"),
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("k"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("doc_id"), F.col("s_name").alias("name"),
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("k"),
    )
    last = keep_last(append_documents([customer, supplier]), "doc_id", ["statement", "k"])
    return last.select("doc_id", "name", "kind")


@query(
    "window_passthrough",
    """
    SELECT user_id, event_id, row_number() OVER w AS rn, lag(event_id) OVER w AS previous,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS running
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def _window_passthrough(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.round(F.col("value") * 100).cast("long").alias("cents")
    )
    return running_window(
        events, ["user_id"], ["ts", "event_id"], lag={"previous": "event_id"}, running={"running": "cents"}
    ).select("user_id", "event_id", "rn", "previous", "running")


@query(
    "window_slices",
    """
    SELECT user_id, event_id, row_number() OVER w AS rn, lag(cents) OVER w AS previous,
           CAST(sum(cents) OVER w AS BIGINT) AS running
    FROM (SELECT *, CASE WHEN event_type <> 'view' THEN CAST(round(value * 100) AS BIGINT) END AS cents FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def _window_slices(spark, sf):
    cents = F.when(F.col("event_type") != "view", F.round(F.col("value") * 100).cast("long"))
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", cents.alias("cents"))
    return running_window(
        events, ["user_id"], ["ts", "event_id"], lag={"previous": "cents"}, running={"running": "cents"}, limit=80
    ).select("user_id", "event_id", "rn", "previous", "running")


def _order_documents(spark: SparkSession, sf: str) -> DataFrame:
    rows = wide(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return to_document_json(rows, "o_orderkey", keep=["o_orderkey"])


@query(
    "bulk_lines",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS doc_id, CAST(c_custkey AS VARCHAR) AS action_id, 'doc' AS action_type,
           c_name AS name, CAST(3 AS BIGINT) AS n_lines
    FROM customer
    """,
)
def _bulk_lines(spark, sf):
    lines = to_bulk_lines(to_document_json(table(spark, sf, "customer"), "c_custkey"), "_doc")
    part = F.split("value", "\n")
    return lines.select(
        "doc_id",
        F.get_json_object(F.get(part, F.lit(0)), "$.index._id").alias("action_id"),
        F.get_json_object(F.get(part, F.lit(0)), "$.index._type").alias("action_type"),
        F.get_json_object(F.get(part, F.lit(1)), "$.c_name").alias("name"),
        F.size(part).cast("long").alias("n_lines"),
    )


@query(
    "bulk_batches",
    """
    WITH numbered AS (
      SELECT o_orderkey, CAST(floor((o_orderkey - (SELECT min(o_orderkey) FROM orders)) / 1001) AS BIGINT) AS shard
      FROM orders),
    placed AS (
      SELECT shard, o_orderkey, (row_number() OVER (PARTITION BY shard ORDER BY o_orderkey) - 1) // 200 AS batch
      FROM numbered)
    SELECT shard, CAST(batch AS BIGINT) AS batch, count(*) AS n_docs,
           CAST(min(o_orderkey) AS VARCHAR) AS first_id, CAST(max(o_orderkey) AS VARCHAR) AS last_id
    FROM placed GROUP BY ALL
    """,
)
def _bulk_batches(spark, sf):
    # One document per id, so a range of keys is a shard of bounded size.
    orders = keep_last(_order_documents(spark, sf), "doc_id", ["o_orderkey"])
    lo = key_bounds(table(spark, sf, "orders"), "o_orderkey").first()["lo"]
    lines = orders.select(
        chunk_of("o_orderkey", lo, WIDTH).alias("chunk"),
        "o_orderkey",
        "doc_id",
        F.concat(F.lit('{"index":{}}\n'), "body", F.lit("\n")).alias("value"),
    )
    batches = bulk_batches(lines, shard="chunk", order=["o_orderkey"])
    return batches.select(
        "shard",
        "batch",
        "n_docs",
        F.element_at("doc_ids", 1).alias("first_id"),
        F.element_at("doc_ids", -1).alias("last_id"),
    )


@query(
    "bulk_writer",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS action_id, o_orderkey, o_custkey, o_orderpriority,
           (SELECT count(*) FROM orders) AS n_docs, true AS counted
    FROM orders
    """,
)
def _bulk_writer(spark, sf):
    # Written as request files, then read back; the totals are those of the commit messages.
    folder = shared_folder(spark, "bulk")
    counts = write_bulk(to_bulk_lines(_order_documents(spark, sf)), folder)
    batches = read_bulk(spark, folder)
    seen = batches.agg(
        (F.sum("n_docs") == counts["n_docs"]) & (F.sum("n_bytes") == counts["n_bytes"])
        & (F.count(F.lit(1)) == counts["n_batches"]) & (F.max("n_docs") <= 200)
        & (F.sum(F.octet_length("payload")) == counts["n_bytes"])
    ).first()[0]
    line = F.split(F.rtrim("payload", F.lit("\n")), "\n")
    # An action and a body in turn. The text is split outside the functions of its lines, once for each side.
    pairs = F.arrays_zip(
        F.filter(line, lambda _, k: k % 2 == 0).alias("action"), F.filter(line, lambda _, k: k % 2 == 1).alias("body")
    )
    # The outer form, filtered: for the inner form Spark would split once more to test the size.
    rows = batches.select(F.inline_outer(pairs)).filter("action IS NOT NULL").select(
        F.get_json_object("action", "$.index._id").alias("action_id"),
        F.inline_outer(F.array(F.from_json("body", "o_orderkey bigint, o_custkey bigint, o_orderpriority string"))),
    )
    return rows.select("*", F.lit(counts["n_docs"]).cast("long").alias("n_docs"), F.lit(seen).alias("counted"))


@query(
    "bulk_totals",
    "SELECT count(*) AS n_docs, true AS within_budget, true AS complete FROM orders",
)
def _bulk_totals(spark, sf):
    # Batched as partitioned, with a byte budget that is often reached first.
    lines = to_bulk_lines(_order_documents(spark, sf))
    batches = bulk_batches(lines, max_docs=200, max_bytes=16_000)
    measured = batches.select(
        "n_docs",
        F.octet_length("payload").cast("long").alias("size"),
        "n_bytes",
        F.size(F.split("payload", "\n")).alias("n_lines"),
    )
    fits = (F.col("n_docs") <= 200) & (F.col("size") < 17_000) & (F.col("size") == F.col("n_bytes"))
    return measured.agg(
        F.sum("n_docs").alias("n_docs"),
        F.bool_and(fits).alias("within_budget"),
        F.bool_and(F.col("n_lines") == 2 * F.col("n_docs") + 1).alias("complete"),
    )


# --- accounting and publishing -----------------------------------------------------------

RESULTS = """
    SELECT l_orderkey, l_returnflag, CASE WHEN l_quantity <= 40 THEN 201 WHEN l_quantity <= 45 THEN 429 END AS status
    FROM lineitem
"""


def _results(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("l_quantity") <= 40, 201).when(F.col("l_quantity") <= 45, 429)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", status.alias("status"))


@query(
    "load_stats",
    f"""
    SELECT l_returnflag, count(*) FILTER (status <= 201) AS n_ok,
           count(*) FILTER (status > 201 OR status IS NULL) AS n_err
    FROM ({RESULTS}) GROUP BY l_returnflag
    """,
)
def _load_stats(spark, sf):
    return load_stats(_results(spark, sf), ["l_returnflag"])


@query(
    "success_rate",
    f"""
    SELECT l_returnflag, count(*) FILTER (status <= 201) AS n_ok,
           count(*) FILTER (status > 201 OR status IS NULL) AS n_err,
           CAST(100 * count(*) FILTER (status <= 201) // count(*) AS BIGINT) AS rate
    FROM ({RESULTS}) GROUP BY l_returnflag
    """,
)
def _success_rate(spark, sf):
    return success_rate(load_stats(_results(spark, sf), ["l_returnflag"]))


@query(
    "publish_gate",
    f"""
    SELECT l_returnflag, CAST(100 * count(*) FILTER (status <= 201) // count(*) AS BIGINT) AS rate,
           100 * count(*) FILTER (status <= 201) // count(*) >= 80 AS publish
    FROM ({RESULTS}) GROUP BY l_returnflag
    """,
)
def _publish_gate(spark, sf):
    rates = success_rate(load_stats(_results(spark, sf), ["l_returnflag"]))
    return passes_gate(rates).select("l_returnflag", "rate", "publish")


@query(
    "dead_letters",
    f"SELECT l_orderkey, l_returnflag, status FROM ({RESULTS}) WHERE status > 201 OR status IS NULL",
)
def _dead_letters(spark, sf):
    return dead_letters(_results(spark, sf))


@query(
    "version_name",
    """
    SELECT o_orderkey, 'orders_' || strftime(o_orderdate, '%Y%m%d%H%M%S') AS version,
           strftime(o_orderdate + INTERVAL 8 HOUR, '%Y%m%d%H%M%S') AS stamp
    FROM orders
    """,
)
def _version_name(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        version_column(F.lit("orders"), "o_orderdate").alias("version"),
        compact_time("o_orderdate", "Asia/Shanghai").alias("stamp"),
    )


def _part_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as versions, the brand as alias; promotional ones have dot-names, others a second site's."""
    dot = F.when(F.col("p_type") == "PROMO", F.lit(".")).otherwise(F.lit(""))
    site = F.when(F.col("p_partkey") % 5 == 0, F.lit("v_fr_")).otherwise(F.lit("v_"))
    return table(spark, sf, "part").select(
        F.concat(dot, site, F.lpad(F.col("p_partkey").cast("string"), 14, "0")).alias("version"),
        F.col("p_brand").alias("alias"),
    )


_PART_VERSIONS = """
    SELECT CASE WHEN p_type = 'PROMO' THEN '.' ELSE '' END || CASE WHEN p_partkey % 5 = 0 THEN 'v_fr_' ELSE 'v_' END
               || lpad(CAST(p_partkey AS VARCHAR), 14, '0')
           AS version, p_brand AS alias FROM part
"""


def _newest(registry: DataFrame) -> DataFrame:
    return registry.groupBy("alias").agg(F.max("version").alias("version"))


@query(
    "alias_actions",
    f"""
    WITH r AS ({_PART_VERSIONS}), t AS (SELECT alias, max(version) AS version FROM r GROUP BY alias)
    SELECT 'remove' AS action, r.version, r.alias FROM r JOIN t USING (alias)
    WHERE r.version <> t.version AND r.version NOT LIKE '.%'
    UNION ALL SELECT 'add', version, alias FROM t
    """,
)
def _alias_actions(spark, sf):
    registry = _part_versions(spark, sf)
    return alias_actions(registry, _newest(registry).select("version", "alias"))


@query(
    "alias_log",
    """
    WITH l AS (
        SELECT o_orderkey AS commit, CASE o_orderpriority WHEN '5-LOW' THEN 'remove' ELSE 'add' END AS action,
               'v' || (o_orderkey % 3) AS version, 'c' || o_custkey AS alias FROM orders
    ), c AS (SELECT *, lag(action, 1, 'remove') OVER (PARTITION BY version, alias ORDER BY commit) AS before FROM l),
    u AS (SELECT *, lead(commit) OVER (PARTITION BY version, alias ORDER BY commit) AS until FROM c WHERE action <> before)
    SELECT version, alias, commit AS since, until FROM u WHERE action = 'add'
    """,
)
def _alias_log(spark, sf):
    # Each order is a commit that adds a version to its customer's alias, or with low priority takes it away.
    log = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("commit"),
        F.lit(0).alias("seq"),
        F.when(F.col("o_orderpriority") == "5-LOW", "remove").otherwise("add").alias("action"),
        F.concat(F.lit("v"), (F.col("o_orderkey") % 3).cast("string")).alias("version"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("alias"),
    )
    return alias_intervals(log)


@query(
    "stale_versions",
    f"""
    WITH r AS ({_PART_VERSIONS}), t AS (SELECT alias, max(version) AS version FROM r GROUP BY alias)
    SELECT version FROM r WHERE regexp_full_match(version, 'v_[0-9]{{14}}') AND version NOT IN (SELECT version FROM t)
    """,
)
def _stale_versions(spark, sf):
    registry = _part_versions(spark, sf)
    return stale_versions(registry, _newest(registry), "v_")


# --- text ----------------------------------------------------------------------------------

STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)

# Token rows (doc_id, pos from 0, w) of whole texts; removed words have a NULL w.
TOKEN_ROWS = f"""
    SELECT doc_id, pos, n, CASE WHEN w NOT IN ({STOP}) THEN w END AS w FROM (
      SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM (
        SELECT doc_id, list_transform(regexp_extract_all(text, '\\p{{L}}+'), lambda x: lower(x)) AS ws FROM documents))
"""


@query(
    "tokens",
    f"SELECT doc_id, w AS token, count(*) AS n, CAST(min(pos) AS BIGINT) AS first_pos FROM ({TOKEN_ROWS}) WHERE w IS NOT NULL GROUP BY ALL",
)
def _tokens(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    tokens = analyze(documents, ["doc_id"], "text", "default", parts=text_parts(documents, "text"))
    return tokens.groupBy("doc_id", "token").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").cast("long").alias("first_pos")
    )


@query(
    "shingles",
    f"""
    WITH t AS ({TOKEN_ROWS}),
    p AS (SELECT pos, n, w, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM t)
    SELECT token, count(*) AS n FROM (
      SELECT w AS token FROM p WHERE w IS NOT NULL
      UNION ALL
      SELECT coalesce(w, '_') || ' ' || coalesce(after, '_') FROM p
      WHERE pos < n - 1 AND (w IS NOT NULL OR after IS NOT NULL))
    GROUP BY token
    """,
)
def _shingles(spark, sf):
    grams = analyze(wide(spark, sf, "documents", "doc_id", "text"), ["doc_id"], "text", "shingle_analyzer")
    return grams.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_tokens",
    """
    SELECT p_partkey, 'white' AS kind, w AS token, pos FROM (
      SELECT p_partkey, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM (
        SELECT p_partkey, string_split(lower(p_name || ' ' || p_type), ' ') AS ws FROM part))
    UNION ALL
    SELECT p_partkey, 'comma', w, pos FROM (
      SELECT p_partkey, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM (
        SELECT p_partkey, string_split(lower(p_name || ',' || p_brand), ',') AS ws FROM part))
    UNION ALL SELECT p_partkey, 'keyword', lower(p_brand), 0 FROM part
    UNION ALL SELECT p_partkey, 'normal', lower(p_type), 0 FROM part
    """,
)
def _split_tokens(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.concat_ws(" ", "p_name", "p_type").alias("spaced"),
        F.concat_ws(",", "p_name", "p_brand").alias("listed"),
        "p_brand",
        lowercase_normal("p_type").alias("normal"),
    )
    ids = ["p_partkey"]
    found = {
        "white": analyze(part, ids, "spaced", "whitespace_analyzer"),
        "comma": analyze(part, ids, "listed", "comma_split_pattern_analyzer"),
        "keyword": analyze(part, ids, "p_brand", "keyword_analyzer"),
        "normal": part.select("p_partkey", F.lit(0).alias("pos"), F.col("normal").alias("token")),
    }
    rows = [
        df.select("p_partkey", F.lit(kind).alias("kind"), "token", F.col("pos").cast("long").alias("pos"))
        for kind, df in found.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query(
    "char_filters",
    """
    SELECT page_id, md5(replace(replace(html, '''', ' '), '_', ' ')) AS spaced, md5(replace(html, ' ', '')) AS dense
    FROM pages
    """,
)
def _char_filters(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.md5(special_chars_to_space("html")).alias("spaced"),
        F.md5(remove_spaces("html")).alias("dense"),
    )


# A site's synonym file: two groups of words and one with terms of two words.
SYNONYM_LINES = "de,des,del\\nder,die\\nde la,du,of some"


def _synonym_groups_of_site(spark: SparkSession) -> DataFrame:
    return synonym_groups(spark.createDataFrame([(SYNONYM_LINES,)], "value string"))


# Expansions (doc_id, pos, w) by rule: phrase, word to write, offset.
EXPANDED = f"""
    WITH t AS ({TOKEN_ROWS}),
    p AS (SELECT doc_id, pos, n, w, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM t),
    rules(phrase, word, off) AS (VALUES
      ('de','des',0), ('de','del',0), ('des','de',0), ('des','del',0), ('del','de',0), ('del','des',0),
      ('der','die',0), ('die','der',0),
      ('de la','du',0), ('de la','of',0), ('de la','some',1),
      ('du','de',0), ('du','la',1), ('du','of',0), ('du','some',1),
      ('of some','de',0), ('of some','la',1), ('of some','du',0)),
    m AS (SELECT doc_id, pos, n, w AS phrase, w, after FROM p WHERE w IS NOT NULL
          UNION ALL SELECT doc_id, pos, n, w || ' ' || after, w, after FROM p WHERE w IS NOT NULL AND after IS NOT NULL),
    e AS (SELECT DISTINCT doc_id, pos + off AS pos, n, word FROM m JOIN rules USING (phrase)
          WHERE word IS DISTINCT FROM CASE off WHEN 0 THEN w ELSE after END),
    every_token AS (
      SELECT doc_id, pos, n, w AS token FROM t WHERE w IS NOT NULL UNION ALL SELECT doc_id, pos, n, word FROM e)
"""


@query(
    "synonym_expand",
    EXPANDED + "SELECT doc_id, token, count(*) AS n, CAST(sum(pos) AS BIGINT) AS positions FROM every_token GROUP BY ALL",
)
def _synonym_expand(spark, sf):
    documents = wide(spark, sf, "documents", "doc_id", "text")
    tokens = analyze(
        documents, ["doc_id"], "text", "default", _synonym_groups_of_site(spark), text_parts(documents, "text")
    )
    return tokens.groupBy("doc_id", "token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("positions")
    )


@query(
    "synonym_shingles",
    EXPANDED
    + """,
    items AS (
      SELECT doc_id, pos, coalesce(w, '_') AS item FROM t UNION ALL SELECT doc_id, pos, word FROM e)
    SELECT token, count(*) AS n FROM (
      SELECT token FROM every_token
      UNION ALL SELECT a.item || ' ' || b.item FROM items a JOIN items b ON a.doc_id = b.doc_id AND a.pos = b.pos - 1
      WHERE a.item <> '_' OR b.item <> '_')
    GROUP BY token
    """,
)
def _synonym_shingles(spark, sf):
    grams = analyze(
        wide(spark, sf, "documents", "doc_id", "text"), ["doc_id"], "text", "shingle_analyzer", _synonym_groups_of_site(spark)
    )
    return grams.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


# Arcs (doc_id, pos, a, b, w) of the graph: nodes are positions, or steps inside a reading.
GRAPH = f"""
    WITH t AS ({TOKEN_ROWS}),
    p AS (SELECT doc_id, pos, n, w, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM t),
    terms(g, term) AS (VALUES (1,'de'), (1,'des'), (1,'del'), (2,'der'), (2,'die'), (3,'de la'), (3,'du'), (3,'of some')),
    m AS (SELECT doc_id, pos, 1 AS length, w AS phrase FROM p WHERE w IS NOT NULL
          UNION ALL SELECT doc_id, pos, 2, w || ' ' || after FROM p WHERE w IS NOT NULL AND after IS NOT NULL),
    paths AS (SELECT DISTINCT doc_id, pos, length, y.term AS path FROM m JOIN terms x ON phrase = x.term JOIN terms y ON x.g = y.g AND x.term <> y.term),
    arcs AS (
      SELECT doc_id, pos, pos::VARCHAR AS a, (pos + 1)::VARCHAR AS b, coalesce(w, '_') AS w, 1 AS length, NULL AS path, 0 AS step, 1 AS steps FROM t
      UNION ALL
      SELECT doc_id, pos, CASE step WHEN 0 THEN pos::VARCHAR ELSE concat_ws('/', pos, length, path, step) END,
        CASE step WHEN steps - 1 THEN (pos + length)::VARCHAR ELSE concat_ws('/', pos, length, path, step + 1) END,
        split_part(path, ' ', step + 1), length, path, step, steps
      FROM (SELECT *, len(string_split(path, ' ')) AS steps FROM paths), range(2) r(step) WHERE step < steps)
"""


@query(
    "synonym_graph",
    GRAPH
    + """
    SELECT doc_id, length, path, step, steps, w AS token, count(*) AS n, CAST(sum(pos) AS BIGINT) AS positions
    FROM arcs WHERE path IS NOT NULL OR w <> '_' GROUP BY ALL
    """,
)
def _synonym_graph(spark, sf):
    documents = wide(spark, sf, "documents", "doc_id", "text")
    tokenized = tokenize(documents, ["doc_id"], "text", "default")
    arcs = synonym_graph(tokenized, ["doc_id"], _synonym_groups_of_site(spark), text_parts(documents, "text"))
    return arcs.groupBy("doc_id", "length", "path", "step", "steps", "token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("positions")
    )


@query(
    "graph_shingles",
    GRAPH
    + """
    SELECT doc_id, token, count(*) AS n, CAST(sum(pos) AS BIGINT) AS positions FROM (
      SELECT doc_id, pos, w AS token FROM arcs WHERE path IS NOT NULL OR w <> '_'
      UNION ALL SELECT x.doc_id, x.pos, x.w || ' ' || y.w FROM arcs x JOIN arcs y ON x.doc_id = y.doc_id AND x.b = y.a
      WHERE x.w <> '_' OR y.w <> '_')
    GROUP BY ALL
    """,
)
def _graph_shingles(spark, sf):
    documents = wide(spark, sf, "documents", "doc_id", "text")
    grams = analyze(
        documents, ["doc_id"], "text", "shingle_search", _synonym_groups_of_site(spark), text_parts(documents, "text")
    )
    return grams.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("positions"))


@query(
    "copy_to",
    """
    SELECT p_partkey, concat_ws(' ', p_name, p_type) AS search_words,
           concat_ws(' ', p_brand, p_name, CAST(p_size AS VARCHAR)) AS p_brand
    FROM part
    """,
)
def _copy_to(spark, sf):
    part = copy_to(table(spark, sf, "part"), ["p_name", "p_type"], "search_words")
    return copy_to(part, ["p_name", "p_size"], "p_brand").select("p_partkey", "search_words", "p_brand")


FIELDS = {
    "properties": {
        "title": {"type": "text", "analyzer": "shingle_analyzer", "copy_to": ["words"]},
        "kind": {"type": "text", "copy_to": ["words"]},
        "labels": {"type": "nested", "properties": {"brand": {"type": "text"}, "size": {"type": "integer"}}},
        "words": {"type": "text", "analyzer": "default"},
    }
}


@query(
    "field_tokens",
    """
    WITH texts AS (
      SELECT p_partkey, 'title' AS field, p_name AS t FROM part
      UNION ALL SELECT p_partkey, 'kind', p_type FROM part
      UNION ALL SELECT p_partkey, 'labels.brand', p_brand FROM part
      UNION ALL SELECT p_partkey, 'words', p_name || ' ' || p_type FROM part),
    tokens AS (
      SELECT p_partkey, field, unnest(ws) AS token, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM (
        SELECT p_partkey, field, list_transform(regexp_extract_all(t, '\\p{L}+'), lambda x: lower(x)) AS ws FROM texts))
    SELECT p_partkey, field, CAST(0 AS BIGINT) AS item, CAST(i - 1 AS BIGINT) AS pos, token FROM tokens
    UNION ALL
    SELECT a.p_partkey, a.field, 0, a.i - 1, a.token || ' ' || b.token FROM tokens a
    JOIN tokens b ON a.p_partkey = b.p_partkey AND a.field = b.field AND a.i = b.i - 1 WHERE a.field = 'title'
    """,
)
def _field_tokens(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_name").alias("title"),
        F.col("p_type").alias("kind"),
        F.array(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))).alias("labels"),
    )
    found = field_tokens(apply_mapping(rows, FIELDS, keep=["p_partkey"]), ["p_partkey"], FIELDS)
    return found.select("p_partkey", "field", *[F.col(c).cast("long").alias(c) for c in ("item", "pos")], "token")


MAPPING = {
    "dynamic": "false",
    "properties": {
        "id": {"type": "integer"},
        "part_no": {"type": "integer"},
        "title": {"type": "text", "copy_to": ["all_text"]},
        "lines": {
            "type": "nested",
            "properties": {"number": {"type": "integer"}, "flag": {"type": "text"}},
        },
        "all_text": {"type": "text"},
        "absent": {"type": "text"},
    },
}


def _mapped_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = wide(
        spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax"
    )
    return rows.select(
        F.col("l_orderkey").alias("id"),
        # Numbers, numbers as text, and text that is none.
        F.when(F.col("l_returnflag") == "A", F.col("l_returnflag"))
        .otherwise(F.col("l_partkey").cast("string")).alias("part_no"),
        F.col("l_linestatus").alias("title"),
        F.concat(
            F.lit('[{"number":"'), "l_linenumber", F.lit('","flag":"'), "l_returnflag", F.lit('","other":1}]')
        ).alias("lines"),
        F.col("l_tax").alias("unmapped"),
    )


@query(
    "mapping_projection",
    """
    SELECT CAST(l_orderkey AS INTEGER) AS id, CASE WHEN l_returnflag <> 'A' THEN CAST(l_partkey AS INTEGER) END AS part_no,
           l_linestatus AS title, l_linenumber AS number, l_returnflag AS flag, l_linestatus AS search_words
    FROM lineitem
    """,
)
def _mapping_projection(spark, sf):
    mapped = apply_mapping(_mapped_rows(spark, sf), MAPPING)
    return mapped.select(
        "id", "part_no", "title", F.inline_outer("lines"), F.col("all_text").alias("search_words")
    )


@query(
    "mapping_errors",
    """
    SELECT l_returnflag, count(*) FILTER (l_returnflag = 'A') AS n_err, count(*) AS n FROM lineitem GROUP BY 1
    """,
)
def _mapping_errors(spark, sf):
    rows = _mapped_rows(spark, sf).select("*", F.get_json_object("lines", "$[0].flag").alias("l_returnflag"))
    checked = rows.select("l_returnflag", mapping_errors(rows, MAPPING).alias("wrong"))
    return checked.groupBy("l_returnflag").agg(
        F.count("wrong").alias("n_err"), F.count(F.lit(1)).alias("n")
    )


# --- whole runs --------------------------------------------------------------------


def _own_database(spark: SparkSession, name: str) -> str:
    """A database of one call, in the session's warehouse."""
    database = f"docloom_{name}_{uuid.uuid4().hex}"
    tables.create_database(spark, database)
    return database


@query(
    "staging_statements",
    """
    WITH rest AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
      WHERE NOT coalesce(o_orderstatus = 'F' AND o_orderkey % 4 = 1, false)),
    changed AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_custkey % 10 = 3 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_custkey % 10 = 3 THEN 'x' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority FROM rest),
    grown AS (
      SELECT * FROM changed
      UNION ALL SELECT -c_custkey, c_custkey, 'N', NULL, NULL FROM customer WHERE c_custkey % 3 = 0)
    SELECT o_orderkey, o_custkey, CASE WHEN s_suppkey IS NULL THEN o_orderstatus ELSE 'M' END AS o_orderstatus, o_totalprice, o_orderpriority
    FROM grown LEFT JOIN supplier ON o_orderkey = s_suppkey * 7 WHERE s_suppkey IS NULL OR s_suppkey % 5 <> 0
    UNION ALL
    SELECT s_suppkey * 7, NULL, 'M', NULL, NULL FROM supplier WHERE s_suppkey * 7 NOT IN (SELECT o_orderkey FROM grown)
    """,
)
def _staging_statements(spark, sf):
    database = _own_database(spark, "statements")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    # Files of neighbouring keys, as a read in key ranges leaves them.
    tables.stage(orders.repartitionByRange(8, "o_orderkey"), database, "orders")
    changes.delete(spark, database, "orders", "o_orderstatus = 'F' AND o_orderkey % 4 = 1")
    changes.update(
        spark, database, "orders", {"o_totalprice": "o_totalprice * 2", "o_orderpriority": "concat('x', o_orderpriority)"}, "o_custkey % 10 = 3"
    )
    customers = table(spark, sf, "customer").where("c_custkey % 3 = 0")
    changes.insert(
        spark, database, "orders",
        customers.select((-F.col("c_custkey")).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"), F.lit("N").alias("o_orderstatus")),
    )
    suppliers = table(spark, sf, "supplier").select((F.col("s_suppkey") * 7).alias("o_orderkey"), F.lit("M").alias("o_orderstatus"))
    changes.merge(spark, database, "orders", suppliers, ["o_orderkey"], delete_where="s.o_orderkey % 35 = 0")
    return spark.table(tables.quoted(database, "orders"))


@query(
    "sync_site",
    """
    SELECT 'c' || c_custkey AS doc_id, c_name AS name, n_name AS nation, coalesce(n, 0) AS n_orders, 100 AS rate, 'shop' AS alias
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) ON o_custkey = c_custkey
    """,
)
def _sync_site(spark, sf):
    """Import from two sources side by side, statements, export, gate and alias swap."""
    database = _own_database(spark, "sync")
    site = PipelineSpec(
        site="shop", lang="en", id_key="doc_id", index_name="shop_en", alias="shop", database=database, default_source="shop",
        sources=[files(sf, "customer", "orders", source="shop"), files(sf, "nation", source="world")],
        extracts=[
            Extract("customers", "SELECT c_custkey, c_name, c_nationkey FROM customer", buckets=4, bucket_by=["c_custkey"]),
            Extract("orders", "SELECT o_custkey, o_orderstatus FROM orders", buckets=4, bucket_by=["o_custkey"]),
            Extract("nations", "SELECT n_nationkey, n_name FROM nation", source="world"),
        ],
        assemblies=[
            Assembly("orders", kind="delete", where="o_orderstatus = 'P'"),
            Assembly("counts", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey", kind="table"),
            Assembly(
                "documents",
                "SELECT concat('c', c_custkey) AS doc_id, c_name AS name, n_name AS nation, coalesce(n, 0) AS n_orders "
                "FROM customers JOIN nations ON c_nationkey = n_nationkey LEFT JOIN counts ON o_custkey = c_custkey",
            ),
        ],
    )
    result = sync(spark, site)
    (alias,) = [r["alias"] for r in tables.registry(spark, database).where(F.col("version") == result.version).collect()]
    public = spark.table(tables.quoted(database, alias))
    return public.select(
        "doc_id", F.get_json_object("body", "$.name").alias("name"), F.get_json_object("body", "$.nation").alias("nation"),
        F.get_json_object("body", "$.n_orders").cast("long").alias("n_orders"), F.lit(result.rate).alias("rate"), F.lit(alias).alias("alias"),
    )
