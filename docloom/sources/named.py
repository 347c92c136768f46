"""Named-source query scans."""

from __future__ import annotations

import re
import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.functions.shaping import line_breaks
from docloom.sources.ranges import MAX_RANGES, THRESHOLD, WIDTH, balanced_predicates, range_predicates
from docloom.spec import Source, render


# Rows a database sends at a time, unless the source says otherwise.
FETCH_ROWS = "10000"

_VIEWS = threading.RLock()

# Databases whose SQL has LIMIT.
LIMIT_DIALECTS = r"jdbc:(mysql|mariadb|postgresql|sqlite|h2|duckdb)\b"


def _jdbc_reader(spark: SparkSession, source: Source):
    return spark.read.format("jdbc").options(**{"fetchsize": FETCH_ROWS, **source.options})


def _derived(query: str, limit: int = 0) -> str:
    # The range filter stays outside the query, whatever clauses it has.
    inner = f"({query.strip().rstrip(';')}\n) q"
    return f"(SELECT * FROM {inner} LIMIT {limit}) l" if limit else inner


def scan_tables(spark: SparkSession, source: Source, query: str, params: Mapping | None = None) -> DataFrame:
    """Run ``query`` with the file tables of ``source`` visible by name.

    ``spark.sql`` resolves names at once, so the views can go afterwards and
    two sources may use the same table name. Views of the caller with such a
    name are set aside and come back.
    """
    used = {t: p for t, p in source.tables.items() if re.search(rf"\b{re.escape(t)}\b", query)}
    options = dict(source.options)
    form = options.pop("format", "parquet")
    # Threads share the session's views: one at a time resolves its names.
    with _VIEWS:
        return _with_views(spark, used, form, options, own_views(spark, used), query, params)


def own_views(spark: SparkSession, names) -> dict[str, DataFrame]:
    """The session's temporary views among ``names``."""
    return {t: spark.table(t) for t in names if spark.catalog.tableExists(t) and spark.catalog.getTable(t).isTemporary}


def _with_views(spark, used, form, options, own, query, params) -> DataFrame:
    try:
        for table, path in used.items():
            spark.read.format(form).options(**options).load(path).createOrReplaceTempView(table)
        return spark.sql(query, args=dict(params)) if params else spark.sql(query)
    finally:
        for table in used:
            spark.catalog.dropTempView(table)
        for table, view in own.items():
            view.createOrReplaceTempView(table)


def cuts_query(inner: str, key: str, parts: int) -> str:
    """Derived table ``(part, lo)`` of the least key of each of ``parts`` equal shares of ``inner``."""
    shares = f"(SELECT {key} AS k, NTILE({parts}) OVER (ORDER BY {key}) AS part FROM {inner} WHERE {key} IS NOT NULL) s"
    return f"(SELECT part, MIN(k) AS lo FROM {shares} GROUP BY part) c"


def range_scan(
    spark: SparkSession,
    source: Source,
    query: str,
    key: str,
    threshold: int = THRESHOLD,
    width: int = WIDTH,
    max_ranges: int = MAX_RANGES,
    parts: int = 0,
) -> DataFrame:
    """Read a database query in key ranges, one task each.

    Ranges are of equal width, or with ``parts`` that many of equal row count,
    for skewed or sparse keys; then the database sorts the keys once. File and catalog
    tables are already split by Spark and read as they are.
    """
    if source.kind != "jdbc":
        return extract(spark, source, query)
    inner = _derived(query)
    options = {"fetchsize": FETCH_ROWS, **{k: v for k, v in source.options.items() if k != "url"}}
    if parts:
        cuts = _jdbc_reader(spark, source).option("dbtable", cuts_query(inner, key, parts)).load().collect()
        ranges = balanced_predicates(key, sorted({int(r["lo"]) for r in cuts if r["part"] > 1}))
        return spark.read.jdbc(source.options["url"], inner, predicates=ranges, properties=options)
    probe = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {inner}) b"
    bounds = _jdbc_reader(spark, source).option("dbtable", probe).load().first()
    lo, hi = (None if bounds[i] is None else int(bounds[i]) for i in (0, 1))
    ranges = range_predicates(key, lo, hi, threshold, width, max_ranges)
    return spark.read.jdbc(source.options["url"], inner, predicates=ranges, properties=options)


def extract(
    spark: SparkSession,
    source: Source,
    query: str,
    key: str | None = None,
    limit: int = 0,
    params: Mapping[str, str] | None = None,
    args: Mapping[str, object] | None = None,
    parts: int = 0,
) -> DataFrame:
    """Run ``query`` on ``source``.

    ``params`` fill ``{name}`` placeholders, ``args`` named SQL parameters
    (``:name``) where Spark runs the query. ``limit`` caps the rows of the whole
    extract; 0 is no cap. ``key`` splits a database read into ranges, with ``parts``
    into that many of equal row count.
    """
    query = render(query, params or {})
    if source.kind == "jdbc":
        if args:
            raise ValueError("named arguments need a query that Spark runs")
        if key and not limit:
            df = range_scan(spark, source, query, key, parts=parts)
        else:
            # Where the database knows LIMIT, it returns no more than is asked for.
            asked = limit if re.match(LIMIT_DIALECTS, source.options.get("url", "")) else 0
            df = _jdbc_reader(spark, source).option("dbtable", _derived(query, asked)).load()
    elif source.kind in ("files", "catalog"):
        df = scan_tables(spark, source, query, args)
    else:
        raise ValueError(f"unknown source kind {source.kind!r}")
    return df.limit(limit) if limit else df


def read_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """``(group_id, term)`` of a synonym file, one comma-separated group per line.

    Literal backslash-n sequences are line breaks. Terms are trimmed and
    lower-cased; empty terms are skipped.
    """
    return synonym_groups(spark.read.text(path).select("value"))


def synonym_groups(lines: DataFrame) -> DataFrame:
    """``(group_id, term)`` of text lines in column ``value``.

    A group's id is the hash of its line: equal on every run and partitioning.
    """
    return (
        lines.select(F.explode(F.split(line_breaks("value"), "\n")).alias("line"))
        .select(F.trim("line").alias("line"))
        .select(F.md5("line").alias("group_id"), F.explode(F.split("line", ",")).alias("term"))
        .select("group_id", F.lower(F.trim("term")).alias("term"))
        .filter("term != ''")
        .distinct()
    )
