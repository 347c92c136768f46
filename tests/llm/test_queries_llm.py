"""Registered queries on the given tables: against their SQL, or against brute force."""

from __future__ import annotations

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm.queries import CHECKS, QUERIES
from tests.conftest import DATA
from tests.llm import test_operators as brute


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(database):
    return database.sql("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


def ordered(rows):
    return sorted(map(tuple, rows), key=brute.key)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, DATA)
    cursor = database.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got, want = ordered(df.select(*names).collect()), ordered(cursor.fetchall())
    assert got == want and got


def test_suffix_dedup(spark, documents):
    import hashlib

    got = ordered(QUERIES["op2_suffix_dedup"](spark, DATA).collect())
    want = [(d[0], *w[:3], hashlib.sha256(w[3]).hexdigest()) for d, w in zip(documents, brute.covered([d[1] for d in documents]))]
    assert got == ordered(want)


def test_near_dedup(spark, documents):
    got = QUERIES["op3_minhash_near_dedup"](spark, DATA).collect()
    assert ordered(r[:3] for r in got) == ordered(brute.brute_components(documents, 4))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_held_out_languages(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op4_language_id"](spark, DATA).collect()}
    held = [d for d in documents if zlib.crc32(str(d[0]).encode()) % 4 == 2]
    assert {d[0] for d in held} == {k for k, r in got.items() if r["held_out"]}
    known = [d for d in held if got[d[0]]["lang_pred"] != "und"]
    assert sum(got[d[0]]["lang_pred"] == d[2] for d in known) >= 0.95 * len(known)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_token_ids(spark, documents):
    got = sorted(QUERIES["op6_token_ids"](spark, DATA).collect())
    at = 0
    for row, ids in zip(got, brute.expected_ids(documents, 0), strict=True):
        assert tuple(row)[1:] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_mix(spark, documents):
    got = QUERIES["op8_mix_sources"](spark, DATA).collect()
    assert len(got) == len(documents)
    sizes, by = {}, {}
    for d in documents:
        sizes[d[3]] = sizes.get(d[3], 0) + len(brute.words(d[1]))
    order = sorted(sizes, key=lambda s: s.encode())
    wanted = brute.brute_targets(sizes, {s: [5, 2, 1][k % 3] for k, s in enumerate(order)})
    source = {d[0]: d[3] for d in documents}
    for r in got:
        assert r["target"] == pytest.approx(wanted[source[r["doc_id"]]])
        by[source[r["doc_id"]]] = by.get(source[r["doc_id"]], 0) + r["taken"]
    assert all(abs(by[s] - wanted[s]) <= 0.1 * wanted[s] for s in wanted)


def test_quality(spark, documents):
    got = QUERIES["op9_quality_rules"](spark, DATA).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert ordered([tuple(r[n] for n in names) for r in got]) == ordered(map(brute.brute_quality, documents))
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_packing(spark, documents):
    brute.check_packing(documents, QUERIES["op10_packing"](spark, DATA).collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.Scratch(spark, "test").table(stage(spark, docs, DATA), name)
        assert docs.columns == before.columns
        assert docs.join(before, docs.columns, "left_anti").count() == 0
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    brute.check_packing(rows, corpus_pipeline.run(spark, DATA).collect())
    kept = corpus_pipeline.near_dedup(spark, corpus_pipeline.exact_dedup(spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA), DATA)
    left = [(r["doc_id"], r["text"]) for r in kept.where(F.length("text") > 0).collect()]
    assert all(a == c for a, _, c in brute.brute_components(left, 5))
