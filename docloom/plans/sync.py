"""The whole run of a site: import, export, publish."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docloom.functions.shaping import decode_json_fields, promote_meta, to_document_json
from docloom.operators.documents import append_documents, bulk_batches, deliver, keep_last, to_bulk_lines
from docloom.operators.loads import dead_letters, load_stats
from docloom.operators.text import mapping_errors
from docloom.operators.versions import version_name
from docloom.session import cut_lineage
from docloom.sinks import changes, publish, tables
from docloom.sinks.schema import normalize_schema
from docloom.sources.named import extract
from docloom.spec import Assembly, Extract, PipelineSpec, render

# Extracts that run side by side.
WORKERS = 4

STATUS = "name string, status string, n_rows long, error string"


@dataclass(frozen=True)
class ExportResult:
    """Outcome of one export."""

    version: str
    n_ok: int
    n_err: int
    rate: int


def check_sources(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """``(name, status, n_rows, error)``: whether each source answers; moves no data."""
    rows = []
    for source in spec.sources:
        try:
            if source.kind == "files":
                options = dict(source.options)
                form = options.pop("format", "parquet")
                for path in source.tables.values():
                    spark.read.format(form).options(**options).load(path).schema
            else:
                extract(spark, source, "SELECT 1 AS one").first()
            rows.append((source.name, "ok", None, None))
        except Exception as error:
            rows.append((source.name, "failed", None, str(error)))
    return spark.createDataFrame(rows, STATUS)


def _stage_extract(spark: SparkSession, spec: PipelineSpec, item: Extract) -> int:
    df = extract(
        spark, spec.source(item.source), item.query, item.key, spec.import_limit, spec.params, parts=item.parts
    )
    df = normalize_schema(df, spec.schema_mode)
    layout = {"buckets": item.buckets, "by": item.bucket_by}
    if not item.transform:
        return tables.stage_counted(df, spec.database, item.name, **layout)
    # The rows are staged as read: a transform may scan its input several times.
    staged = tables.stage(df, spec.database, f"{item.name}_raw")
    changed = normalize_schema(item.transform(staged), spec.schema_mode)
    return tables.stage_counted(changed, spec.database, item.name, **layout)


def run_import(
    spark: SparkSession, spec: PipelineSpec, on_error: str = "raise", workers: int = WORKERS
) -> DataFrame:
    """Stage every extract; ``(name, status, n_rows, error)`` per extract, in the order given.

    Up to ``workers`` extracts run side by side, each in a scheduler pool and
    under a job tag of its own. ``on_error="skip"`` records a failing extract, keeps its
    former staging table and goes on; else the first failure cancels the
    jobs of the others and is raised.
    """
    tables.create_database(spark, spec.database)
    context, run, stop = spark.sparkContext, uuid.uuid4().hex, threading.Event()
    tags = [f"import-{run}-{i}" for i in range(len(spec.extracts))]

    def one(number: int) -> tuple:
        item = spec.extracts[number]
        if stop.is_set():
            return item.name, "cancelled", None, None
        context.setLocalProperty("spark.scheduler.pool", tags[number])
        context.addJobTag(tags[number])
        try:
            return item.name, "ok", _stage_extract(spark, spec, item), None
        except Exception as error:
            if on_error != "skip":
                raise
            return item.name, "failed", None, str(error)
        finally:
            context.removeJobTag(tags[number])
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, workers)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(one), i) for i in range(len(spec.extracts))]
        done, _ = wait(started, return_when=FIRST_EXCEPTION)
        failed = next((f.exception() for f in started if f in done and f.exception()), None)
        if failed:
            stop.set()
            pending = {f: tag for f, tag in zip(started, tags) if not f.cancel() and not f.done()}
            while pending:
                # Again and again: an extract can be between two jobs.
                for tag in pending.values():
                    context.cancelJobsWithTag(tag)
                done, _ = wait(pending, timeout=0.2)
                pending = {f: tag for f, tag in pending.items() if f not in done}
    if failed:
        raise failed
    return spark.createDataFrame([f.result() for f in started], STATUS)


def run_statement(spark: SparkSession, spec: PipelineSpec, item: Assembly) -> DataFrame | None:
    """Run one assembly statement; the rows of a ``documents`` statement, else None."""

    def filled(text: str | None) -> str | None:
        return text and render(text, spec.params)

    values = item.values and {c: filled(v) for c, v in item.values.items()}
    if item.kind == "delete":
        return changes.delete(spark, spec.database, item.name, filled(item.where))
    if item.kind == "update":
        return changes.update(spark, spec.database, item.name, values or {}, filled(item.where))
    rows = item.query(spark) if callable(item.query) else spark.sql(filled(item.query))
    if item.kind == "insert":
        return changes.insert(spark, spec.database, item.name, rows)
    if item.kind == "merge":
        return changes.merge(spark, spec.database, item.name, rows, item.on, values, filled(item.delete_where))
    if item.kind == "table":
        tables.stage(rows, spec.database, item.name)
        return None
    if item.kind != "documents":
        raise ValueError(f"unknown kind of statement {item.kind!r}")
    return rows


def assemble(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """Run the assemblies in order; all document rows, with the statement's rank."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(spec.database)
    try:
        found = []
        for item in spec.assemblies:
            rows = run_statement(spark, spec, item)
            if rows is not None:
                found.append(rows)
        return append_documents(found)
    finally:
        spark.catalog.setCurrentDatabase(before)


def shape(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Encoded documents ``(doc_id, body, status, error_type, error_reason)``, one per id.

    A document fails if it has no id or a mapped integer field is not a number.
    """
    text = {
        f: t for f, t in spec.json_fields.items()
        if f in df.columns and isinstance(df.schema[f].dataType, T.StringType)
    }
    df = decode_json_fields(df, text)
    raw = {f: f"{f}_raw" for f in text}
    json_columns = []
    if spec.meta_field in df.columns and spec.promoted:
        df = promote_meta(df, spec.meta_field, spec.promoted)
        json_columns = list(spec.promoted.values())
    wrong = mapping_errors(df, spec.mapping) if spec.mapping else F.lit(None).cast("string")
    df = df.withColumn("wrong_field", wrong)
    order = [c for c in spec.order if c in df.columns]
    ranked = df.select("*", *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)])
    extra = ["statement", *[f"order_{i}" for i in range(len(order))], "wrong_field"]
    parts = [c for c in spec.part_columns if c in df.columns]
    encoded = to_document_json(
        ranked, spec.id_key, json_columns, raw, exclude=extra, keep=extra, parts=parts
    )
    # Rows without an id replace nothing: each is an error of its own.
    last = keep_last(encoded.where(F.col("doc_id").isNotNull()), "doc_id", extra[:-1])
    last = last.unionByName(encoded.where(F.col("doc_id").isNull()).select(*last.columns))
    fault = F.when(F.col("doc_id").isNull(), F.lit("document without id")).when(
        F.col("wrong_field").isNotNull(),
        F.concat(F.lit("no whole number in field "), F.col("wrong_field")),
    )
    return last.select(
        "doc_id",
        "body",
        F.when(fault.isNull(), F.lit(201)).otherwise(F.lit(400)).alias("status"),
        F.when(fault.isNotNull(), F.lit("mapping_error")).alias("error_type"),
        fault.alias("error_reason"),
    )


def run_export(
    spark: SparkSession,
    spec: PipelineSpec,
    moment: datetime | None = None,
    send: Callable | None = None,
    dead_letter_path: str | None = None,
) -> ExportResult:
    """Assemble, shape and write a new version, and count what loaded.

    With ``send`` the accepted documents also go out as bulk requests, and its
    answers are what counts.
    """
    tables.create_database(spark, spec.database)
    version = version_name(spec.index_name, moment, spec.time_zone)
    counts = publish.write_documents(shape(assemble(spark, spec), spec), spec.database, version)
    written = spark.table(tables.quoted(spec.database, version))
    failed = dead_letters(written)
    if send:
        accepted = written.filter(publish.LOADED).select("doc_id", "body")
        # Materialized: counting must not send again.
        answers = cut_lineage(deliver(bulk_batches(to_bulk_lines(accepted, spec.doc_type)), send))
        sent = load_stats(answers).first()
        counts = {"n_ok": sent["n_ok"], "n_err": sent["n_err"] + counts["n_err"]}
        failed = failed.unionByName(dead_letters(answers).join(accepted, "doc_id"))
    if dead_letter_path:
        publish.write_dead_letters(failed, dead_letter_path, version)
    n_ok, n_err = counts["n_ok"], counts["n_err"]
    return ExportResult(version, n_ok, n_err, 100 * n_ok // (n_ok + n_err) if n_ok + n_err else 0)


def sync(
    spark: SparkSession,
    spec: PipelineSpec,
    do_import: bool = True,
    do_export: bool = True,
    do_alias: bool = True,
    test_only: bool = False,
    moment: datetime | None = None,
    send: Callable | None = None,
    on_error: str = "raise",
    dead_letter_path: str | None = None,
) -> ExportResult | None:
    """Full refresh of a site with phase switches; None if nothing was exported.

    An export below the success gate raises, whether or not the alias is asked for.
    """
    if test_only:
        failed = [r["name"] for r in check_sources(spark, spec).collect() if r["status"] != "ok"]
        if failed:
            raise ConnectionError(f"sources without answer: {', '.join(failed)}")
        return None
    if do_import:
        run_import(spark, spec, on_error)
    if not do_export:
        return None
    result = run_export(spark, spec, moment, send, dead_letter_path)
    publish.require_success(spec.alias_name, result.rate, spec.min_success)
    if do_alias:
        publish.swap_alias(spark, spec.database, spec.alias_name, result.version)
    return result
