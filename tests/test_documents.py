from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from docloom.operators.documents import append_documents, bulk_batches, deliver, keep_last, to_bulk_lines
from docloom.operators.loads import dead_letters, load_stats, passes_gate, success_rate
from tests.conftest import rows


def test_append_keeps_every_column(spark):
    a = spark.createDataFrame([(1, "x")], "ID int, a string")
    b = spark.createDataFrame([(2, "y")], "ID int, b string")
    assert rows(append_documents([a, b]), "ID", "a", "b", "statement") == [(1, "x", None, 0), (2, None, "y", 1)]


def test_keep_last_is_the_same_on_any_partitioning(spark):
    rng = random.Random(3)
    data = [(rng.choice([0, 0, 0, None, 1, 2]), rng.randrange(4), rng.choice("abc")) for _ in range(200)]
    want = {}
    for k, o, v in data:
        want[k] = max(want.get(k, (-1, "")), (o, v))
    for n in (1, 7):
        df = spark.createDataFrame(data, "id int, o int, v string").repartition(n)
        found = keep_last(df, "id", ["o"])
        assert found.columns == ["id", "o", "v"]
        assert {r["id"]: (r["o"], r["v"]) for r in found.collect()} == want


def test_bulk_lines(spark):
    df = spark.createDataFrame([('a"b', '{"x":1}')], "doc_id string, body string")
    action, body, end = to_bulk_lines(df, "_doc").first()["value"].split("\n")
    assert json.loads(action) == {"index": {"_id": 'a"b', "_type": "doc"}}
    assert (body, end) == ('{"x":1}', "")
    double = to_bulk_lines(df, "__doc").first()["value"]
    assert json.loads(double.split("\n")[0])["index"]["_type"] == "_doc"


def brute_batches(lines, max_docs, max_bytes):
    found, docs, size = [], 0, 0
    for line in lines:
        docs, size = docs + 1, size + len(line.encode())
        if docs == max_docs or size >= max_bytes:
            found.append((docs, size))
            docs, size = 0, 0
    return found + [(docs, size)] * (docs > 0)


def test_batches_end_at_either_budget(spark):
    rng = random.Random(9)
    data = [(i % 3, i, str(i), "é" * rng.randrange(1, 60)) for i in range(240)]
    df = spark.createDataFrame(data, "s int, i int, doc_id string, value string")
    found = bulk_batches(df, 10, 400, shard="s", order=["i"]).collect()
    for shard in range(3):
        mine = sorted((r for r in found if r["shard"] == shard), key=lambda r: r["batch"])
        assert [r["batch"] for r in mine] == list(range(len(mine)))
        assert [(r["n_docs"], r["n_bytes"]) for r in mine] == brute_batches(
            [d[3] for d in data if d[0] == shard], 10, 400
        )
        assert "".join(r["payload"] for r in mine) == "".join(d[3] for d in data if d[0] == shard)
        assert sum((r["doc_ids"] for r in mine), []) == [d[2] for d in data if d[0] == shard]


def test_batches_without_a_shuffle(spark):
    df = spark.range(1000, numPartitions=4).select(
        F.col("id").cast("string").alias("doc_id"), F.lit("x\n").alias("value")
    )
    found = bulk_batches(df)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["n_docs"] for r in found.collect()) == [50] * 4 + [200] * 4


def test_delivery_counts_a_failed_request_as_failed_documents(spark):
    df = spark.createDataFrame([(str(i), f"line{i}\n") for i in range(20)], "doc_id string, value string").coalesce(1)

    def send(payload):
        if "line5\n" in payload:
            raise ConnectionError("no answer")
        return [(429, "busy", "later") if line == "line11" else (201, None, None) for line in payload.split()]

    results = deliver(bulk_batches(df, max_docs=5), send)
    assert rows(load_stats(results)) == [(14, 6)]
    failed = {r["doc_id"]: r["error_type"] for r in dead_letters(results).collect()}
    assert failed == {**{str(i): "ConnectionError" for i in range(5, 10)}, "11": "busy"}


def test_delivery_with_too_few_answers_fails_the_batch(spark):
    df = spark.createDataFrame([("1", "a\n"), ("2", "b\n")], "doc_id string, value string").coalesce(1)
    results = deliver(bulk_batches(df), lambda payload: [(201, None, None)])
    assert rows(load_stats(results)) == [(0, 2)]


def test_rates_at_the_gate(spark):
    cases = [(79, 21), (80, 20), (100, 0), (0, 0), (799_999_999_999, 200_000_000_001), (1999, 501)]
    df = spark.createDataFrame(cases, "n_ok long, n_err long")
    found = {(r["n_ok"], r["n_err"]): (r["rate"], r["publish"]) for r in passes_gate(success_rate(df)).collect()}
    assert found == {
        (79, 21): (79, False), (80, 20): (80, True), (100, 0): (100, True), (0, 0): (0, False),
        (799_999_999_999, 200_000_000_001): (79, False), (1999, 501): (79, False),
    }


def test_missing_status_is_an_error(spark):
    df = spark.createDataFrame([(200,), (201,), (202,), (None,)], "status int")
    assert rows(load_stats(df)) == [(2, 2)]
    assert rows(load_stats(df.limit(0))) == [(0, 0)]


def test_lines_without_a_shard_share_batches(spark):
    lines = spark.createDataFrame(
        [(None, str(i), "x") for i in range(40)] + [(7, "s", "x")], "shard long, doc_id string, value string"
    )
    found = bulk_batches(lines, shard="shard", order=["doc_id"], partitions=2).collect()
    free = [r for r in found if r["shard"] is None]
    assert len(free) <= 2 and sorted(i for r in free for i in r["doc_ids"]) == sorted(map(str, range(40)))
    assert [r["doc_ids"] for r in found if r["shard"] == 7] == [["s"]]
