from __future__ import annotations

import json

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docloom.operators.documents import bulk_batches
from docloom.sinks.bulk import cut, read_bulk, read_manifest, write_bulk
from tests.conftest import rows

LINES = "doc_id string, value string"


def by_row(sizes, max_docs, max_bytes):
    """Batches by the rule, a line at a time."""
    out, now = [], []
    for size in sizes:
        now.append(size)
        if len(now) == max_docs or sum(now) >= max_bytes:
            out.append(now)
            now = []
    return out + [now] * bool(now)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=30), st.integers(1, 6), st.integers(1, 20), st.integers(1, 7))
def test_cut_by_brute_force(sizes, max_docs, max_bytes, step):
    got, now, docs, size = [], [], 0, 0
    for low in range(0, len(sizes), step):  # Arrow batches of some lines
        some = sizes[low : low + step]
        for a, b, held, closed in cut(pa.array([b"x" * n for n in some], pa.large_binary()), docs, size, max_docs, max_bytes):
            assert held == sum(some[a:b])
            now, docs, size = now + some[a:b], docs + b - a, size + held
            if closed:
                got.append(now)
                now, docs, size = [], 0, 0
    assert got + [now] * bool(now) == by_row(sizes, max_docs, max_bytes)


def test_batches_round_trip(spark, tmp_path):
    lines = spark.range(0, 1000, 1, 3).select(
        F.col("id").cast("string").alias("doc_id"),
        F.when(F.col("id") % 100 != 0, F.concat(F.lit("é"), F.col("id").cast("string"), F.lit("\n"))).alias("value"),
    )
    counts = write_bulk(lines, str(tmp_path / "load"), max_docs=50)
    got = read_bulk(spark, str(tmp_path / "load"))
    assert counts["n_docs"] == 990
    wanted = bulk_batches(lines.where("value IS NOT NULL"), max_docs=50)
    assert rows(got, "n_docs", "n_bytes", "payload") == rows(wanted, "n_docs", "n_bytes", "payload")
    sums = got.agg(F.sum("n_docs"), F.sum("n_bytes"), F.count(F.lit(1))).first()
    assert tuple(sums) == (counts["n_docs"], counts["n_bytes"], counts["n_batches"])
    with pytest.raises(FileExistsError):
        write_bulk(lines, str(tmp_path / "load"))


def test_empty_load(spark, tmp_path):
    empty = spark.createDataFrame([], LINES)
    assert write_bulk(empty, str(tmp_path / "load")) == {"n_docs": 0, "n_bytes": 0, "n_batches": 0}
    assert rows(read_bulk(spark, str(tmp_path / "load"))) == []


def test_a_failed_load_leaves_no_part_and_no_manifest(spark, tmp_path):
    bad = F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.lit("x\n"))
    lines = spark.range(0, 8, 1, 2).select(F.col("id").cast("string").alias("doc_id"), bad.alias("value"))
    with pytest.raises(Exception):
        write_bulk(lines, str(tmp_path / "load"))
    assert list(tmp_path.glob("load/**/part-*")) == []
    assert not (tmp_path / "load" / "manifest.json").exists()


def test_what_other_attempts_left_does_not_count(tmp_path):
    from docloom.sinks.bulk import BulkWriter, PartWritten

    writer = BulkWriter(str(tmp_path), 10, 100)
    folder = tmp_path / writer.folder.rsplit("/", 1)[1]
    folder.mkdir()
    for name in ("part-00000-first", "part-00000-again"):
        (folder / f"{name}.bulk").write_text("x\n")
        (folder / f"{name}.json").write_text(json.dumps({"part": name, "batch": 0, "start": 0, "n_docs": 1, "n_bytes": 2}))
    writer.commit([PartWritten("part-00000-again", 1, 2, 1)])
    assert sorted(p.name for p in folder.iterdir()) == ["part-00000-again.bulk", "part-00000-again.json"]
    assert read_manifest(str(tmp_path))["n_docs"] == 1


def test_index_is_dealt_over_tasks(spark, tmp_path):
    # One part with every batch.
    lines = spark.range(0, 3_000, 1, 1).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.col("id").cast("string"), F.lit("\n")).alias("value"))
    counts = write_bulk(lines, str(tmp_path / "load"), max_docs=10)
    got = read_bulk(spark, str(tmp_path / "load"))
    held = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(held) == counts["n_batches"] == 300
    assert len(held) == spark.sparkContext.defaultParallelism and max(held) <= 2 * 300 / len(held)


def test_bulk_writer_splits_a_payload_outside_of_loops(spark, tmp_path):
    from docloom.plans.queries import QUERIES

    data = [(i, None if i % 7 == 0 else i % 5, "O", None if i % 11 == 0 else f"{i} \n é") for i in range(1_000)]
    spark.createDataFrame(data, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    got = QUERIES["bulk_writer"](spark, str(tmp_path))
    assert rows(got, "action_id", "o_orderkey", "o_custkey", "o_orderpriority") == sorted(
        ((str(i), i, c, p) for i, c, _, p in data), key=lambda t: [(v is not None, str(v)) for v in t]
    )
    assert {(r["n_docs"], r["counted"]) for r in got.collect()} == {(1_000, True)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2 and "transform(" not in plan
