"""Publishing a version: the gate, the alias swap, cleanup and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.operators.loads import MIN_SUCCESS, dead_letters, is_error
from docloom.operators.versions import stale_versions
from docloom.sinks import tables


# Version tables keep rejected documents too; readers see the loaded ones.
LOADED = "status <= 201"


class PublishRefused(RuntimeError):
    """Too few documents loaded; the alias was left as it is."""


def write_documents(documents: DataFrame, database: str, version: str) -> dict:
    """Write ``(doc_id, body, status, error_type, error_reason)`` rows, one per id,
    as the new ``version``; gives ``n_rows``, ``n_ok`` and ``n_err``, counted while writing.
    """
    measures = [F.count_if(~is_error()).alias("n_ok"), F.count_if(is_error()).alias("n_err")]
    return tables.write_table(documents, database, version, measures)


def write_bulk_files(lines: DataFrame, path: str, max_docs: int = 0) -> None:
    """Write bulk lines as text files ready to send, at most ``max_docs`` documents each."""
    writer = lines.select(F.regexp_replace("value", "\\n$", "")).write.mode("errorifexists")
    if max_docs:
        writer = writer.option("maxRecordsPerFile", max_docs)
    writer.text(path)


def swap_alias(spark: SparkSession, database: str, alias: str, version: str) -> None:
    """Point ``alias`` at ``version``; whatever it named before is no longer public."""
    if not spark.catalog.tableExists(tables.quoted(database, version)):
        raise ValueError(f"no version {version!r} in {database!r}")
    tables.point(spark, database, alias, version, "doc_id, body", LOADED)


def require_success(alias: str, success: int, min_success: int = MIN_SUCCESS) -> None:
    """The publish gate: raise unless ``success`` percent is enough."""
    if success < min_success:
        raise PublishRefused(
            f"success rate {success}% is below {min_success}%, {alias!r} was not changed"
        )


def publish(
    spark: SparkSession,
    database: str,
    alias: str,
    version: str,
    success: int,
    min_success: int = MIN_SUCCESS,
) -> None:
    """Swap ``alias`` to ``version`` if ``success`` percent is enough, else raise."""
    require_success(alias, success, min_success)
    swap_alias(spark, database, alias, version)


def find_stale(spark: SparkSession, database: str, prefix: str) -> DataFrame:
    """``(version)`` that :func:`drop_stale` would drop."""
    return stale_versions(
        tables.versions(spark, database), tables.registry(spark, database), prefix
    )


def drop_stale(spark: SparkSession, database: str, prefix: str) -> list[str]:
    """Drop the versions under ``prefix`` without an alias; returns their names."""
    names = sorted(row["version"] for row in find_stale(spark, database, prefix).collect())
    for name in names:
        tables.drop_table(spark, database, name)
    return names


def write_dead_letters(results: DataFrame, path: str, version: str) -> None:
    """Append the failed rows of ``results`` as JSON to the error folder of ``version``."""
    dead_letters(results).write.mode("append").json(f"{path.rstrip('/')}/error_{version}")
