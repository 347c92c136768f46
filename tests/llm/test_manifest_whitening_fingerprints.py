"""Merkle manifest, whitening and fingerprints against plain Python on small tables."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docloom.llm import merkle, syncmers, whitening

# --- Merkle manifest ---------------------------------------------------------------


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves: list[str], arity: int) -> tuple[str, list[list[list[str]]]]:
    """The root, and for each leaf its siblings level by level."""
    level, ways, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for way, i in zip(ways, range(len(leaves))):
            run = level[at[i] // arity * arity :][:arity]
            way.append(run[: at[i] % arity] + run[at[i] % arity + 1 :])
        at = [a // arity for a in at]
        level = [sha("".join(level[i : i + arity])) for i in range(0, len(level), arity)]
    return level[0], ways


def manifest_by_hand(rows, arity):
    groups: dict = {}
    for g, o, text in rows:
        groups.setdefault(g, []).append((o, sha("-" if text is None else f"{len(text.encode())}:{text}")))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found = {g: tree([d for _, d in sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))], arity) for g in names}
    root, upper = tree([found[g][0] for g in names], arity)
    out = []
    for g, up in zip(names, upper):
        ordered = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        for (o, leaf), way in zip(ordered, found[g][1]):
            out.append((g, o, leaf, found[g][0], root, sha("".join(x for step in way + up for x in step))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_matches_plain_trees(spark, monkeypatch, arity):
    monkeypatch.setattr(merkle, "SPAN", 9)  # several bands
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", None, ""]) if i % 3 else "a", i if i % 11 else None, draw.choice(["x", "yé", None, "", "z" * 50])) for i in range(120)]
    rows += [("a", 7, "twice"), ("a", 7, "twice"), ("lone", 1, "one")]
    docs = spark.createDataFrame(rows, "lang string, doc_id long, text string").withColumn("rank", F.lit(9)).withColumn("tree", F.lit("mine"))
    made = merkle.manifest(docs.repartition(7), "lang", "doc_id", merkle.leaf_digest(F.col("text")), [F.col("rank"), F.col("tree")], arity)
    got = made.rows.select(
        "row.group", "row.order", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("p"), merkle.fold(F.col("leaf"), F.col("path")).alias("f"),
        merkle.fold(F.sha2(F.lit("other"), 256), F.col("path")).alias("w"), "row.rank", "row.tree",
    ).collect()
    assert sorted([tuple(r)[:6] for r in got], key=repr) == manifest_by_hand(rows, arity)
    assert all(r["f"] == r["root"] and r["w"] != r["root"] and r["rank"] == 9 and r["tree"] == "mine" for r in got)

    nodes = {(r["tree"], r["level"], r["lo"], r["hi"]): r for r in made.nodes.collect()}
    assert len(nodes) == made.nodes.count()
    children: dict = {}
    for (t, level, lo, hi), node in nodes.items():
        if node["parent_lo"] is not None:
            children.setdefault((t, level + 1, node["parent_lo"], node["parent_hi"]), []).append((lo, hi, node["digest"]))
    for key, node in nodes.items():
        if key[1]:
            parts = sorted(children[key])
            # Children tile their parent's interval.
            assert parts[0][0] == key[2] and parts[-1][1] == key[3] and all(a[1] + 1 == b[0] for a, b in zip(parts, parts[1:]))
            assert node["digest"] == sha("".join(p[2] for p in parts))
    assert {r["group"] for r in made.groups.collect()} == {"a", "b", None, "", "lone"}


def test_manifest_of_nothing_and_of_one(spark):
    empty = spark.createDataFrame([], "lang string, doc_id long, text string")
    made = merkle.manifest(empty, "lang", "doc_id", merkle.leaf_digest(F.col("text")))
    assert made.rows.count() == 0 and made.nodes.count() == 0
    one = spark.createDataFrame([(None, None, None)], "lang string, doc_id long, text string")
    (row,) = merkle.manifest(one, "lang", "doc_id", merkle.leaf_digest(F.col("text"))).rows.collect()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("-") and row["path"] == []
    with pytest.raises(ValueError):
        merkle.manifest(one, "lang", "doc_id", merkle.leaf_digest(F.col("text")), arity=1)


# --- whitening ---------------------------------------------------------------------


def test_whitening_matches_numpy(spark):
    draw = np.random.default_rng(3)
    data = draw.normal(size=(300, 5)) @ draw.normal(size=(5, 5))
    bad = [None, [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], []]
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(1_000 + i, v) for i, v in enumerate(bad)] + [(None, data[0].tolist()), (1, data[1].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("component", F.lit("x")).withColumn("n", F.lit("y"))
    got = whitening.whiten(table.repartition(4)).collect()
    used = [(i, v) for i, v in rows if v and len(v) == 5 and None not in v and np.isfinite(v).all()]
    x = np.floor(1024 * np.array([v for _, v in used])) + 100_000
    assert len(got) == 5 * len(used) and {r["n"] for r in got} == {len(used)}
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    by = {(r["vec_id"], r["component"]): r for r in got}
    for k in range(5):
        mine = np.array([by[i, k + 1]["whitened"] for i, _ in used])
        wanted = (x - x.mean(axis=0)) @ axes[:, k] / np.sqrt(values[k])
        assert np.abs(mine - wanted * np.sign(mine @ wanted)).max() < 1e-9
        assert by[used[0][0], k + 1]["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-12)
    sums = [int(s) for s in x.sum(axis=0)]
    for i, row in zip((i for i, _ in used), x):
        assert int(by[i, 1]["deviation"]) == sum((len(used) * int(a) - s) ** 2 for a, s in zip(row, sums))
    assert got[0]["identity_error"] < 1e-9


def test_whitening_with_equal_variances_and_none(spark):
    axes = [[s * (k == i) * 1.0 for k in range(4)] for i in range(3) for s in (1, -1)]
    table = spark.createDataFrame(list(enumerate(axes)), "vec_id long, embedding array<double>")
    got = whitening.whiten(table).collect()
    assert [round(r["explained"], 9) for r in got[:4]] == [0.333333333] * 3 + [0.0]
    assert all((r["whitened"] is None) == (r["component"] == 4) for r in got)
    assert got[0]["identity_error"] < 1e-9
    same = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r["component"], int(r["deviation"]), r["whitened"], r["explained"]) for r in whitening.whiten(same).orderBy("vec_id", "component").collect()] == [
        (1, 0, None, 0.0), (2, 0, None, 0.0)] * 2
    assert whitening.whiten(same.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")
    white = sorted((r["whitened"] for r in whitening.whiten(huge).collect()))
    assert white == pytest.approx([-(1.5**0.5), 0.0, 1.5**0.5])


def test_polynomial_and_roots_are_exact(spark):
    # (x - 1) ** 2 (x - 3) (x - 10), as the matrix of a change of basis over the integers would have it.
    q = np.array([[1, 1, 0, 0], [1, -1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]])
    matrix = (q @ np.diag([1, 1, 3, 10]) @ q.T).tolist()
    coefficients = whitening.characteristic_polynomial(spark, matrix)
    assert coefficients[-1] == 1 and coefficients[0] == round(np.linalg.det(np.array(matrix)))
    eigen = sorted(np.linalg.eigvalsh(np.array(matrix)), reverse=True)
    roots = whitening.largest_roots(coefficients, 4, sum(matrix[i][i] for i in range(4)))
    assert [(low + 1) / (1 << bits) for low, bits in roots] == pytest.approx(eigen)


# --- fingerprints ------------------------------------------------------------------


def xx(text: str) -> int:
    value = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return value - (1 << 64) if value >> 63 else value


def xx_longs(values: list[int]) -> int:
    """Several longs: each hash is the seed of the next."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.to_bytes(8, "little", signed=True), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def anchors_by_hand(text: str) -> list[tuple[int, int]]:
    words = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text):
        words += [word] if len(word) <= syncmers.LONGEST else [word[i : i + syncmers.PIECE] for i in range(0, len(word), syncmers.PIECE)]
    hashed = [xx(w) for w in words]
    inner = [xx_longs(hashed[i : i + syncmers.S]) for i in range(len(words) - syncmers.S + 1)]
    found = []
    for i in range(len(words) - syncmers.K + 1):
        window = inner[i : i + syncmers.W]
        if min(window) in (window[0], window[-1]):
            found.append((i, xx_longs(hashed[i : i + syncmers.K]) & syncmers.LOW))
    return found


def fingerprints_by_hand(rows):
    key = lambda r: (r[0] is None, -(r[0] or 0), xx(r[1] or ""))
    texts = [(i, t or "") for i, t in sorted(rows, key=key)]
    whole = lambda t: (anchors_by_hand(t) or ([(0, xx(t) & syncmers.LOW)] if t else []))

    def like(a, b):
        return 1.0 if not a and not b else 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b)))

    def text_of(found):
        return ".".join(f"{(i - p) << 32 | h:x}" for (i, h), p in zip(found, [0, *(i for i, _ in found)]))

    out = []
    for k, (i, t) in enumerate(texts):
        after, half = texts[(k + 1) % len(texts)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, e, n = whole(t), whole(edited), whole(after)
        h = lambda found: [x for _, x in found]
        out.append((i, len(t), sha(edited), text_of(a), text_of(e), like(h(a), h(e)), like(h(a), h(n)), like(a, e), like(a, n)))
    return sorted(out, key=repr)


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefghé", k=draw.randint(1, 7))) for _ in range(n))


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_fingerprints_match_plain_python(spark, partitions):
    draw = random.Random(8)
    rows = [(i, words(draw, draw.choice([0, 1, 3, 8, 30, 120]))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\U0001f600" * 60 + words(draw, 20)), (103, "a" * 90), (107, "aa " * 90), (104, words(draw, 1_500)), (105, "\n" * 50 + words(draw, 20))]
    rows += [(None, words(draw, 30)), (None, words(draw, 20)), (7, words(draw, 30)), (8, rows[8][1]), (8, rows[8][1]), (None, None), (None, None), (106, rows[20][1])]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own", F.lit(1)).withColumn("bucket", F.lit(1))
        got = syncmers.fingerprints(table.repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in got), key=repr) == fingerprints_by_hand(rows)


def test_fingerprints_of_few_rows(spark):
    assert syncmers.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    (row,) = syncmers.fingerprints(spark.createDataFrame([(1, "abc")], "doc_id long, text string")).collect()
    assert row["edited_sha256"] == sha("aba") and row["near_next"] == 1.0
    (row,) = syncmers.fingerprints(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()
    assert (row["n_chars"], row["fingerprint"], row["near_edited"]) == (0, "", 1.0)


def test_every_stretch_of_windows_has_an_anchor(spark):
    text = words(random.Random(2), 3_000)
    (found,) = spark.createDataFrame([(text,)], "t string").select(syncmers.anchors(F.col("t"))).first()
    places = [a >> 32 for a in found]
    assert places == [i for i, _ in anchors_by_hand(text)]
    assert max(b - a for a, b in zip(places, places[1:])) <= syncmers.W


def test_buckets_split_the_keys(spark):
    bounds = [1.0, 2.5, 4.0, 4.5, 9.0]
    for n in range(len(bounds) + 1):
        found = spark.range(12).select("id", syncmers._bucket_of(F.col("id").cast("double"), bounds[:n]).alias("b")).collect()
        assert all(r["b"] == sum(x < r["id"] for x in bounds[:n]) for r in found)


def test_crowded_cells_give_a_link_for_each_join(spark):
    """A hot group of near copies, in several blocks, gives under one link a row, and they connect what pairs connect."""
    from docloom.llm import minhash
    from docloom.llm.shingles import shingle_sets

    draw = random.Random(9)
    base = words(draw, 200).split()
    texts = []
    for i in range(60):
        some = list(base)
        for at in draw.sample(range(200), draw.choice([1, 2, 3, 9])):
            some[at] = f"own{i}"
        texts.append(" ".join(some))
    rows = minhash.sketches(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t", 5)
    rows = rows.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("root"), "bands", "sketch")
    items = [(i, bytearray(s.tobytes())) for i, s in enumerate(shingle_sets(texts, 5))]
    rows = rows.join(spark.createDataFrame(items, "id long, items binary"), "id")
    buckets = rows.select(F.explode("bands").alias("bucket")).groupBy("bucket").count().where("count > 1")
    cells = minhash._blocked(rows, buckets.select("bucket", F.lit(3).alias("blocks")), "items")
    found = {(r["u"], r["v"]) for r in minhash._linking(cells, 80).collect()}
    sets = [set(s.tolist()) for s in shingle_sets(texts, 5)]
    wanted = {(a, b) for a in range(60) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert found <= wanted and len(wanted) > 1_000

    def groups(links):
        root = list(range(60))
        for a, b in links:
            old, new = root[a], root[b]
            root = [new if r == old else r for r in root]
        return [min(k for k in range(60) if root[k] == root[i]) for i in range(60)]

    assert groups(found) == groups(wanted)
    crowded = cells.groupBy("bucket", "left", "right").agg(F.countDistinct("root").alias("n")).collect()
    assert len(found) < max(60, sum(r["n"] - 1 for r in crowded))
