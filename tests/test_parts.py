"""Oversized groups: split, ordered, whole."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from docloom.operators import parts, windows
from docloom.operators.fold import concat_group, fold_pairs
from docloom.operators.parts import ordered_parts
from docloom.operators.windows import running_window
from tests.conftest import rows


def skewed(seed, n=400):
    """A third of the rows in one key, with many copies; NULL keys as well."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.choice([None, 1, 2, 3, 4, 5])
        data.append((key, rng.choice(["a", "b", "c"]), rng.choice(["x", "yy", "z" * 9]), rng.randrange(12)))
    return data


SCHEMA = "k int, p string, v string, o int"


def test_parts_are_bounded_ordered_and_whole(spark):
    for seed in (1, 2):
        data = skewed(seed)
        df = spark.createDataFrame(data, SCHEMA)
        weight = (F.octet_length("v") + 1).cast("long")
        limit = 120
        found = ordered_parts(df, ["k"], ["o"], weight, limit).collect()
        assert sorted(map(str, ((r.k, r.p, r.v, r.o) for r in found))) == sorted(map(str, data))
        by_key = {}
        for r in found:
            by_key.setdefault(r.k, {}).setdefault(r.part, []).append(r)
        totals = {k: sum(len(r.v) + 1 for p in parts.values() for r in p) for k, parts in by_key.items()}
        assert totals[0] > limit
        for key, parts in by_key.items():
            assert sorted(parts) == list(range(len(parts)))
            assert (len(parts) == 1) == (totals[key] <= limit)
            for part in parts.values():
                assert sum(len(r.v) + 1 for r in part) <= limit + 10
            ends = [(min(r.o for r in parts[i]), max(r.o for r in parts[i])) for i in sorted(parts)]
            assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_one_row_copied_many_times_is_cut_too(spark):
    df = spark.createDataFrame([(1, "p", "v", 0)] * 500 + [(2, "p", "v", 0)], SCHEMA)
    found = ordered_parts(df, ["k"], ["o"], F.lit(7).cast("long"), 70)
    sizes = rows(found.groupBy("k", "part").count())
    assert sum(n for k, _, n in sizes if k == 1) == 500
    assert max(n for _, _, n in sizes) <= 11
    assert len(sizes) == 51


def test_fold_explodes_back(spark):
    data = skewed(3)
    df = spark.createDataFrame(data, SCHEMA)
    for limit in (150, 10_000_000):
        folded = fold_pairs(df, "k", "p", "v", ["o"], limit=limit)
        pairs = folded.select("k", F.explode("pairs").alias("m")).select("k", F.explode("m").alias("p", "v"))
        assert rows(pairs) == sorted(
            [d[:3] for d in data], key=lambda t: [(v is not None, str(v)) for v in t]
        )
    assert fold_pairs(df, "k", "p", "v", ["o"], limit=150).filter("part > 0").count() > 0


def test_fold_keeps_null_and_empty_values(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", "")], "k int, p string, v string")
    assert fold_pairs(df, "k", "p", "v").first()["pairs"] == [{"a": None}, {"b": ""}]


def test_concat_parts_joined_are_the_whole_text(spark):
    data = skewed(4)
    df = spark.createDataFrame(data, SCHEMA)
    found = concat_group(df, ["k"], "v", order=["o"], limit=200).collect()
    texts = {}
    for r in sorted(found, key=lambda r: r.part):
        texts.setdefault(r.k, []).append(r.text)
    assert len(texts[0]) > 1
    for key, parts in texts.items():
        mine = sorted(((d[3], d[2]) for d in data if d[0] == key))
        assert ",".join(parts) == ",".join(v for _, v in mine)


def test_concat_distinct_nulls_and_max_len(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (2, None)], "k int, v string"
    )
    assert rows(concat_group(df, ["k"], "v", distinct=True)) == [(1, 0, "a,b"), (2, 0, None)]
    assert rows(concat_group(df, ["k"], "v", sep=" - ")) == [(1, 0, "a - b - b"), (2, 0, None)]
    assert rows(concat_group(df, ["k"], "v", max_len=4)) == [(1, 0, "a,b,"), (2, 0, None)]
    many = spark.range(3000).select(F.lit(1).alias("k"), F.lit("word").alias("v"))
    cut = concat_group(many, ["k"], "v", max_len=33, limit=100)
    assert rows(cut) == [(1, 0, "word,word,word,word,word,word,wor")]


def test_running_window_over_an_oversized_key(spark):
    rng = random.Random(5)
    data = [(0 if i % 3 else rng.choice([None, 1, 2]), i * 5 % 301, rng.randrange(50)) for i in range(301)]
    df = spark.createDataFrame(data, "k int, t int, x long")
    plain = running_window(df, ["k"], ["t"], {"before": "x"}, {"total": "x"})
    cut = running_window(df, ["k"], ["t"], {"before": "x"}, {"total": "x"}, limit=20)
    assert rows(cut) == rows(plain)
    mine = sorted(d for d in data if d[0] == 0)
    last = [r for r in rows(cut) if r[0] == 0 and r[3] == len(mine)][0]
    assert last[4:] == (mine[-2][2], sum(d[2] for d in mine))


def test_concat_of_an_oversized_key_with_many_nulls(spark):
    data = [(1, None, i) for i in range(200)] + [(1, f"w{i:02}", i) for i in range(30)] + [(2, None, i) for i in range(90)]
    df = spark.createDataFrame(data, "k int, v string, o int")
    found = concat_group(df, ["k"], "v", order=["o"], limit=100).orderBy("k", "part").collect()
    assert ",".join(r["text"] for r in found if r["k"] == 1) == ",".join(f"w{i:02}" for i in range(30))
    assert [(r["part"], r["text"]) for r in found if r["k"] == 2] == [(0, None)]
    cut = concat_group(df, ["k"], "v", order=["o"], limit=100, max_len=10)
    assert rows(cut) == [(1, 0, "w00,w01,w0"), (2, 0, None)]


def test_running_sums_over_nulls_do_not_depend_on_the_limit(spark):
    from docloom.operators.windows import running_window

    rows = [("k", i, None if i < 9 or i % 3 else i) for i in range(40)]
    df = spark.createDataFrame(rows, "key string, at int, v int")
    whole = running_window(df, ["key"], ["at"], running={"total": "v"}).collect()
    sliced = running_window(df, ["key"], ["at"], running={"total": "v"}, limit=5).collect()
    assert {(r["at"], r["total"]) for r in whole} == {(r["at"], r["total"]) for r in sliced}


def test_slices_follow_the_rows_and_not_the_limit(spark, monkeypatch):
    made = []
    whole = parts.slice_in_order

    def counted(df, keys, order, slices):
        made.append(slices)
        return whole(df, keys, order, slices)

    monkeypatch.setattr(parts, "slice_in_order", counted)
    monkeypatch.setattr(windows, "slice_in_order", counted)
    df = spark.range(4_000).select((F.col("id") % 100).alias("g"), "id")
    cut = parts.ordered_parts(df, ["g"], ["id"], F.lit(1).cast("long"), 10)
    sizes = cut.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"))
    assert rows(sizes) == sorted(((g, p, 10, g + 1000 * p) for g in range(100) for p in range(4)), key=lambda t: [(True, str(v)) for v in t])
    numbered = running_window(df, ["g"], ["id"], limit=10)
    assert numbered.where("rn <> 1 + (id - g) / 100").count() == 0 and numbered.count() == 4_000
    # Two slices for each limit would be 802.
    assert made == [spark.sparkContext.defaultParallelism] * 2
