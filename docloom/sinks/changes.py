"""Statements that change staging tables: insert, update, delete, merge.

A public name is a view over segments: tables, each with the names of those of
its files that no longer count. A change finds the files that hold touched
rows, writes what becomes of their rows as a new segment, and re-points the
view in one catalog operation. All other files stay as they are and are
neither read again nor copied; Spark leaves the excluded ones out when it
lists files. Readers see the state before or after, and a statement that fails
leaves the state before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.sinks import tables
from docloom.sinks.tables import quoted

# A segment with more excluded files than this is rewritten as a whole, and so
# are all segments once there are this many.
MAX_EXCLUDED = 5_000
MAX_SEGMENTS = 32


class ChangeConflict(RuntimeError):
    """Somebody else changed the table in the meantime; nothing was published."""


class AmbiguousMerge(ValueError):
    """Several source rows match one row of the table."""


@dataclass(frozen=True)
class Segment:
    """A table, and the files of it that do not count."""

    table: str
    excluded: tuple[str, ...] = ()


def segments_of(spark: SparkSession, database: str, name: str) -> list[Segment]:
    """The segments behind the public ``name``."""
    properties = tables.properties_of(spark, database, name)
    if tables.SEGMENTS in properties:
        return [Segment(s["table"], tuple(s["excluded"])) for s in json.loads(properties[tables.SEGMENTS])]
    if tables.TARGET in properties:
        return [Segment(properties[tables.TARGET])]
    raise ValueError(f"{name!r} in {database!r} is no staging table")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _point(spark: SparkSession, database: str, name: str, columns: Sequence[str], segments: Sequence[Segment]) -> None:
    picked = ", ".join(f"`{c}`" for c in columns)
    parts = []
    for segment in segments:
        where = f" WHERE _metadata.file_name NOT IN ({', '.join(map(_literal, segment.excluded))})" if segment.excluded else ""
        parts.append(f"SELECT {picked} FROM {quoted(database, segment.table)}{where}")
    told = json.dumps([{"table": s.table, "excluded": s.excluded} for s in segments])
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(database, name)} TBLPROPERTIES ('{tables.SEGMENTS}' = {_literal(told)}) AS "
        + " UNION ALL ".join(parts)
    )


def _located(spark: SparkSession, database: str, segment: Segment) -> DataFrame:
    """Rows of a segment that count, with ``_file`` and ``_row``, their place in it."""
    rows = spark.table(quoted(database, segment.table))
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return rows.where(~F.col("_file").isin(list(segment.excluded))) if segment.excluded else rows


def _published(
    spark: SparkSession, database: str, name: str, columns: Sequence[str], before: list[Segment], after: list[Segment],
    new: DataFrame | None,
) -> None:
    """Write ``new`` as one more segment, re-point the view, drop tables that no segment names any more."""
    table = f"{name}__{uuid.uuid4().hex}"
    if new is not None:
        tables.write_table(new.select(*columns), database, table)
        after = [*after, Segment(table)]
    try:
        if segments_of(spark, database, name) != before:
            raise ChangeConflict(f"{name!r} was changed by another statement")
        _point(spark, database, name, columns, after)
    except Exception:
        if new is not None:
            tables.drop_table(spark, database, table)
        raise
    for segment in {s.table for s in before} - {s.table for s in after}:
        tables.drop_table(spark, database, segment)
    if len(after) > MAX_SEGMENTS:
        compact(spark, database, name)


def _split(
    spark: SparkSession, database: str, segments: list[Segment], touched: Mapping[str, set[str]]
) -> tuple[list[Segment], list[DataFrame]]:
    """Segments without the touched files, and the rows of these files."""
    after, rows = [], []
    for segment in segments:
        files = touched.get(segment.table, set())
        if not files:
            after.append(segment)
            continue
        located = _located(spark, database, segment)
        gone = (*segment.excluded, *sorted(files))
        whole = {f.rsplit("/", 1)[-1] for f in spark.table(quoted(database, segment.table)).inputFiles()}
        if len(gone) < len(whole) and len(gone) <= MAX_EXCLUDED:
            after.append(replace(segment, excluded=gone))
            located = located.where(F.col("_file").isin(sorted(files)))
        rows.append(located.withColumn("_segment", F.lit(segment.table)))
    return after, rows


def _touched(found: DataFrame) -> dict[str, set[str]]:
    """Files by segment of ``found(_segment, _file)``; a row for each file comes to the driver."""
    files: dict[str, set[str]] = {}
    for row in found.select("_segment", "_file").distinct().collect():
        files.setdefault(row["_segment"], set()).add(row["_file"])
    return files


def _all(spark: SparkSession, database: str, segments: Sequence[Segment]) -> DataFrame:
    parts = [_located(spark, database, s).withColumn("_segment", F.lit(s.table)) for s in segments]
    return reduce(DataFrame.unionByName, parts)


def insert(spark: SparkSession, database: str, name: str, rows: DataFrame) -> None:
    """Add ``rows``, columns matched by name and cast to the table's types; columns they lack are NULL.

    No file is read or rewritten. A column the table does not have is an error.
    """
    schema = spark.table(quoted(database, name)).schema
    extra = set(rows.columns) - set(schema.names)
    if extra:
        raise ValueError(f"{name!r} has no column {', '.join(sorted(extra))}")
    made = rows.select(
        *[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )
    before = segments_of(spark, database, name)
    _published(spark, database, name, schema.names, before, list(before), made)


def delete(spark: SparkSession, database: str, name: str, where: str = "true") -> None:
    """Remove the rows for which ``where`` is true; where it is NULL they stay."""
    _rewrite(spark, database, name, where, None)


def update(spark: SparkSession, database: str, name: str, values: Mapping[str, str], where: str = "true") -> None:
    """Set columns to SQL expressions of the row as it was, cast to the columns' types, where ``where`` is true."""
    _rewrite(spark, database, name, where, values)


def _rewrite(spark: SparkSession, database: str, name: str, where: str, values: Mapping[str, str] | None) -> None:
    schema = spark.table(quoted(database, name)).schema
    unknown = set(values or ()) - set(schema.names)
    if unknown:
        raise ValueError(f"{name!r} has no column {', '.join(sorted(unknown))}")
    before = segments_of(spark, database, name)
    # The condition stands in a filter alone, where it may hold subqueries.
    hit = _all(spark, database, before).where(where)
    touched = _touched(hit)
    if not touched:
        return
    after, parts = _split(spark, database, before, touched)
    rows = reduce(DataFrame.unionByName, parts)
    columns = [F.col(f"`{c}`") for c in schema.names]
    kept = rows.join(hit.select("_segment", "_file", "_row"), ["_segment", "_file", "_row"], "left_anti").select(*columns)
    if values is not None:
        changed = hit.select(
            *[(F.expr(values[f.name]) if f.name in values else F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in schema]
        )
        kept = kept.unionByName(changed)
    _published(spark, database, name, schema.names, before, after, kept)


def merge(
    spark: SparkSession, database: str, name: str, source: DataFrame, on: Sequence[str],
    matched: Mapping[str, str] | None = None, delete_where: str | None = None, add_missing: bool = True,
) -> None:
    """Merge ``source`` into the table by the key columns ``on``.

    Of matching rows those for which ``delete_where`` is true go; the others get
    ``matched``, SQL expressions over ``t.`` (the row) and ``s.`` (the source row). Without
    ``matched`` they take the source's columns of the same names. Source rows without a
    match are added with ``add_missing``. NULL keys match nothing. A row that several
    source rows match is an error, and nothing changes.
    """
    schema = spark.table(quoted(database, name)).schema
    before = segments_of(spark, database, name)
    every = _all(spark, database, before)
    keys = [F.col(f"t.`{c}`") == F.col(f"s.`{c}`") for c in on]
    same = reduce(lambda a, b: a & b, keys)
    pairs = every.alias("t").join(source.alias("s"), same)
    place = [F.col(f"t.{c}") for c in ("_segment", "_file", "_row")]
    # One row for each touched file, with its largest number of matches.
    hits = pairs.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).groupBy("_segment", "_file").agg(F.max("n").alias("n")).collect()
    if any(r["n"] > 1 for r in hits):
        raise AmbiguousMerge(f"several source rows match one row of {name!r}")
    touched: dict[str, set[str]] = {}
    for r in hits:
        touched.setdefault(r["_segment"], set()).add(r["_file"])
    after, parts = _split(spark, database, before, touched)
    new = []
    if parts:
        rows = reduce(DataFrame.unionByName, parts)
        joined = rows.alias("t").join(source.withColumn("_found", F.lit(True)).alias("s"), same, "left")
        if delete_where:
            joined = joined.where(~F.coalesce(F.col("s._found") & F.expr(delete_where), F.lit(False)))
        values = matched if matched is not None else {c: f"s.`{c}`" for c in source.columns if c in schema.names and c not in on}
        found = F.col("s._found").isNotNull()
        new.append(joined.select(*[
            (F.when(found, F.expr(values[f.name]).cast(f.dataType)).otherwise(F.col(f"t.`{f.name}`")) if f.name in values else F.col(f"t.`{f.name}`"))
            .alias(f.name) for f in schema
        ]))
    if add_missing:
        missing = source.alias("s").join(every.select(*on).alias("t"), same, "left_anti")
        new.append(missing.select(
            *[(F.col(f"`{f.name}`") if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        ))
    if new:
        _published(spark, database, name, schema.names, before, after, reduce(DataFrame.unionByName, new))


def compact(spark: SparkSession, database: str, name: str) -> None:
    """Rewrite all segments as one."""
    before = segments_of(spark, database, name)
    rows = spark.table(quoted(database, name))
    _published(spark, database, name, rows.columns, before, [], rows)
