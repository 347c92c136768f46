"""Catalog tables with public names: a table per run, a view that points at it.

Writing never touches what readers see: the rows go to a new table, and one
catalog operation re-points the view of the public name. Staging tables and
document versions share this scheme.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# The view property naming the table behind a public name; for a name over
# several tables, see docloom.sinks.changes, the other one lists them.
TARGET = "docloom.target"
SEGMENTS = "docloom.segments"


def quoted(database: str, name: str) -> str:
    return f"`{database}`.`{name}`"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Make sure ``database`` exists, at ``location`` if given."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def point(
    spark: SparkSession, database: str, name: str, table: str, columns: str = "*", where: str = "true"
) -> None:
    """Point the public ``name`` at ``table`` in one catalog operation."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(database, name)} TBLPROPERTIES ('{TARGET}' = '{table}') "
        f"AS SELECT {columns} FROM {quoted(database, table)} WHERE {where}"
    )


def properties_of(spark: SparkSession, database: str, name: str) -> dict[str, str]:
    """The properties of the public ``name``; none if it does not exist."""
    if not spark.catalog.tableExists(quoted(database, name)):
        return {}
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {quoted(database, name)}").collect()}


def target_of(spark: SparkSession, database: str, name: str) -> str | None:
    """The table behind the public ``name``, or None."""
    return properties_of(spark, database, name).get(TARGET)


def tables_behind(spark: SparkSession, database: str, name: str) -> list[str]:
    """All tables behind the public ``name``."""
    properties = properties_of(spark, database, name)
    if SEGMENTS in properties:
        return [s["table"] for s in json.loads(properties[SEGMENTS])]
    return [properties[TARGET]] if TARGET in properties else []


def write_table(
    df: DataFrame, database: str, table: str, measures: Sequence[Column] = (), buckets: int = 0, by: Sequence[str] = ()
) -> dict:
    """Write ``df`` as the new table ``table``; an empty ``df`` makes an empty table.

    The write itself counts: the answer has ``n_rows`` and the named aggregates
    ``measures``, and nothing is read again. With ``buckets`` the rows lie in that
    many parts by the hash of ``by``, sorted, so that joins and groups by these
    columns need no shuffle.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *measures)
    writer = counted.write.mode("errorifexists").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *by).sortBy(*by)
    writer.saveAsTable(quoted(database, table))
    return seen.get


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(database, table)}")


def stage(
    df: DataFrame, database: str, name: str, run: str | None = None, buckets: int = 0, by: Sequence[str] = ()
) -> DataFrame:
    """Full refresh of the staging table ``name``; returns its new content.

    The former content stays readable until the new one is complete and is
    dropped afterwards.
    """
    stage_counted(df, database, name, run, buckets, by)
    return df.sparkSession.table(quoted(database, name))


def stage_counted(
    df: DataFrame, database: str, name: str, run: str | None = None, buckets: int = 0, by: Sequence[str] = ()
) -> int:
    """:func:`stage`, giving the number of rows."""
    spark = df.sparkSession
    run = run or f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"
    table = f"{name}__{run}"
    before = tables_behind(spark, database, name)
    n_rows = write_table(df, database, table, buckets=buckets, by=by)["n_rows"]
    point(spark, database, name, table)
    for old in before:
        if old != table:
            drop_table(spark, database, old)
    return n_rows


def registry(spark: SparkSession, database: str) -> DataFrame:
    """``(version, alias)`` of every public name of ``database``.

    Catalog metadata only: a row per view, never per document.
    """
    rows = []
    for entry in spark.catalog.listTables(database):
        if entry.tableType == "VIEW" and not entry.isTemporary:
            rows += [(table, entry.name) for table in tables_behind(spark, database, entry.name)]
    return spark.createDataFrame(rows, "version string, alias string")


def versions(spark: SparkSession, database: str) -> DataFrame:
    """``(version)``: the tables of ``database``."""
    rows = [
        (entry.name,)
        for entry in spark.catalog.listTables(database)
        if entry.tableType != "VIEW" and not entry.isTemporary
    ]
    return spark.createDataFrame(rows, "version string")
