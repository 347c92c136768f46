"""Operators against brute force on small rows: nulls, ties, repeats, long texts, extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import bwt, repeats
from docloom.llm.anchors import PLACE, segments
from docloom.llm.exact import drop_exact, exact_groups
from docloom.llm.idfiles import read_document, round_trip
from docloom.llm.langid import best_languages, identify, train
from docloom.llm.minhash import BAND, BINS, _agreeing, drop_near, near_groups
from docloom.llm.mixing import mix, mixed_rows, shard_quotas
from docloom.llm.packing import Packer, pack
from docloom.llm.quality import keep_good, quality
from docloom.llm.repeats import remove_repeats
from docloom.llm.shingles import shared, shingle_sets, sketch
from docloom.llm.tokens import Encoder, default_tokenizer
from docloom.llm.urls import Trie, filter_urls
from docloom.llm.warc import dedup_archives, parse_records, with_payloads

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, `row` string, _text string"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("red fox over lazy dog blue sky old tree tall hill long road cold lake".split()) + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="module")
def messy_rows():
    base, long = prose(1, 120), prose(2, 12_000)
    edited = base.split()
    edited[60] = "changed"
    texts = [
        None, "", " \n\t", base, base.replace(" ", "\n"), base, " ".join(edited), base.upper(), long, long + " end", "a b c", "A b  c",
        "one", "ähnlich größe straße", prose(3, 40) + "\n" + base, "x" * 5000, "日本語 テキスト", "\x0b\x0c\r",
        "spam line here\n" * 40, prose(4, 60) + " " + prose(4, 60),
    ]
    rows = [(k, t, "en" if k % 3 else None, ["s1", None, "s2"][k % 3], 0, 1, "r", "t") for k, t in enumerate(texts)]
    return [*rows, rows[3], (None, base, None, None, None, None, None, None), (None, None, None, "s1", None, None, None, None)]


@pytest.fixture(scope="module")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((v is None, v) for v in row)


# 1 exact dedup


def test_exact_groups_by_brute_force(messy, messy_rows):
    groups = defaultdict(list)
    for row in messy_rows:
        groups[SPACES.sub("", row[1] or "")].append(row)
    want = []
    for text, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        marked = False
        for row in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
            kept = row[0] == best and not marked
            marked = marked or kept
            want.append((row[0], best, len(rows), kept, hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in exact_groups(messy).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_drop_exact_keeps_one_whole_row(messy, messy_rows, none):
    kept = drop_exact(messy)
    assert kept.columns == messy.columns
    assert kept.count() == len({SPACES.sub("", r[1] or "") for r in messy_rows})
    assert drop_exact(none).count() == 0 and exact_groups(none).count() == 0


# 2 repeats


def covered(texts, depth=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + depth] for d in data for i in range(len(d) - depth + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - depth + 1):
            if seen[d[i : i + depth]] > 1:
                gone[i : i + depth] = True
        out.append((len(d), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])))
    return out


@pytest.mark.parametrize("limit", [4096, 1])
def test_repeats_by_brute_force(messy, messy_rows, limit):
    got = [tuple(r) for r in remove_repeats(messy, anchor_segments=limit).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()]
    got = [(a, b, c, d, bytes(e)) for a, b, c, d, e in got]
    want = [(r[0], *w) for r, w in zip(messy_rows, covered([r[1] for r in messy_rows]))]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_repeats_of_empty_table(none):
    assert remove_repeats(none).count() == 0


def test_repeats_hash_every_text_once(spark, monkeypatch):
    rows = spark.createDataFrame([(k, prose(k % 7, 150)) for k in range(20)], "doc_id long, text string")
    hashed, whole = spark.sparkContext.accumulator(0), repeats.segment_rows

    def counted(texts):
        def run(batches):
            for batch in batches:
                hashed.add(batch.num_rows)
                yield batch

        return whole(texts.mapInArrow(run, texts.schema))

    monkeypatch.setattr(repeats, "segment_rows", counted)
    assert remove_repeats(rows).where("n_removed = n_bytes").count() == 20
    assert hashed.value == 20


def test_joined_spans_cover_the_same_bytes():
    rng = random.Random(3)
    lists = [[(a, a + rng.randint(1, 9)) for a in rng.sample(range(60), rng.randint(0, 9))] for _ in range(200)] + [[], None]
    column = pa.array([x and [{"from": a, "to": b} for a, b in x] for x in lists], pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))
    for at in (0, 3):  # a slice of a column starts elsewhere
        row, low, high = repeats._joined(*repeats._flat(column.slice(at)))
        want = []
        for k, spans in enumerate(lists[at:]):
            gone = np.zeros(72, int)
            for a, b in spans or []:
                gone[a + 1 : b + 1] = 1
            edge = np.diff(gone)
            want += [(k, int(a), int(z)) for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
        assert list(zip(row.tolist(), low.tolist(), high.tolist())) == want


def test_packed_sorting_is_stable_order():
    rng = np.random.default_rng(4)
    for top in (0, 1, 50, 1 << 40, (1 << 63) - 1):  # the last does not fit and is sorted plainly
        for n in (0, 1, 2, 7, 1000):
            values = rng.integers(0, top, n, endpoint=True)
            assert bwt._sorting(values, top).tolist() == np.argsort(values, kind="stable").tolist()


def test_merged_transforms_give_repeated_places():
    rng = random.Random(7)
    for _ in range(150):
        depth = rng.choice([8, 9, 16, 23, 50])
        base = bytes(rng.choice(b"ab\0") for _ in range(80))
        strings = [base[a : a + rng.randint(0, 70)] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for a in [rng.randint(0, 60) for _ in range(rng.randint(1, 9))]]
        seen = Counter(s[i : i + depth] for s in strings for i in range(len(s) - depth + 1))
        want = [[i for i in range(len(s) - depth + 1) if seen[s[i : i + depth]] > 1] for s in strings]
        got = bwt.repeated_places(strings, depth, shard_bytes=rng.choice([1, 60, 1000]))
        assert [g.tolist() for g in got] == want
    assert bwt.repeated_places([], 50) == []


def shared_prefix(x, y):
    return next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))


@pytest.mark.parametrize("depth", [7, 10, 40])
def test_merging_transforms_gives_order_interleave_and_common_prefixes(depth):
    rng = random.Random(depth)
    parts = [[], [b""], [b"banana_bandana_banana_band", b"", b"a"], [b"bandana_banana_ban", b"a", b"\0\xff\0"]]
    parts += [[bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(4)] for _ in range(4)]
    for left in parts:
        for right in parts:
            merged = bwt.merge(bwt.shard(left, depth), bwt.shard(right, depth), depth)
            symbols = [[*(c + 1 for c in s), 0] for s in left + right]
            suffixes = [s[k : k + depth] for s in symbols for k in range(len(s))]
            before = [c for s in symbols for c in [0, *s[:-1]]]
            got = [suffixes[p] for p in merged.shard.order]
            assert sorted(merged.shard.order) == list(range(len(suffixes))) and got == sorted(suffixes)
            assert merged.shard.transform.tolist() == [before[p] for p in merged.shard.order]
            assert merged.interleave.tolist() == [p >= sum(len(s) + 1 for s in left) for p in merged.shard.order.tolist()]
            for k in range(1, len(got)):
                assert merged.common[k] == (-1 if got[k] == got[k - 1] else shared_prefix(got[k], got[k - 1]))


def test_segments_hold_every_window_once_and_equal_windows_share_an_anchor():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 10, 199, 200, 201, 900, 2000)] + [b"ab" * 400]
    texts.append(texts[5][:400] + b"-" + texts[6][100:700])
    seen, n = {}, 0
    for number, anchor, _, place in zip(*segments(texts)):
        start, windows = divmod(int(place), PLACE)
        for at in range(start, start + windows):
            assert seen.setdefault(texts[number][at : at + 200], anchor) == anchor
            n += 1
    assert n == sum(max(0, len(t) - 199) for t in texts)


# 3 near duplicates


def shingle_words(text, size):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_components(rows, size, percent=80):
    sets = [shingle_words(r[1], size) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(i)] = min(smallest.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), smallest.get(find(i))) for i, r in enumerate(rows)]


def test_near_groups_by_brute_force(messy, messy_rows, none):
    got = [tuple(r)[:3] for r in near_groups(messy).collect()]
    assert sorted(got, key=key) == sorted(brute_components(messy_rows, 4), key=key)
    assert near_groups(none).count() == 0


def test_near_chain_is_one_component(spark):
    """Neighbours are linked, the ends are not; an unlinked pair of a bucket must not hide a link."""
    base = prose(11, 100).split()
    rows = []
    for k in range(12):
        w = list(base)
        for j in range(k):
            w[3 + 8 * j] = f"new{j}"
        rows.append((100 - k, " ".join(w), None, None, 0, 0, "", ""))
    got = [tuple(r)[:3] for r in near_groups(spark.createDataFrame(rows, SCHEMA), size=5).collect()]
    assert sorted(got) == sorted(brute_components(rows, 5))
    assert drop_near(spark.createDataFrame(rows, SCHEMA), size=5).count() == len({g[2] for g in got})


def test_near_rows_without_or_with_one_doc_id(spark):
    def near(k):
        w = prose(k, 100).split()
        w[50] = "changed"
        return " ".join(w)

    rows = [(1, prose(61, 100)), (None, prose(61, 100)), (None, near(61)), (None, prose(62, 100)), (None, prose(63, 100)), (None, near(63)),
            (5, near(61)), (5, prose(64, 100)), (6, prose(65, 100)), (6, prose(65, 100)), (6, near(65)), (None, None), (None, ""), (7, ""), (7, "")]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, `row` string")
    got = near_groups(docs).collect()
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted(brute_components(rows, 4), key=key)
    left = Counter((r[0], r[1]) for r in drop_near(docs).collect())
    fixed = Counter([(1, prose(61, 100)), (None, prose(62, 100)), (5, prose(64, 100)), (None, None), (None, ""), (7, ""), (7, "")])
    rest = sorted(left - fixed, key=key)
    assert not fixed - left and [sum(left.values()), len(rest)] == [9, 2]
    assert rest[0] in {(6, prose(65, 100)), (6, near(65))} and rest[1] in {(None, prose(63, 100)), (None, near(63))}


def test_pair_is_given_in_the_first_bucket_it_shares(spark):
    """Band 0 agrees in the 16-bit values alone; bands 1 and 2 are shared."""
    sketch_bytes, n = np.arange(BINS, dtype=np.uint16).tobytes(), BINS // BAND
    bands = {1: list(range(100, 100 + n)), 2: [7, 101, 102, *range(900, 900 + n - 3)]}
    rows = [(bands[1][b], b, 0, 0, 0, k, k, bands[k], sketch_bytes) for b in (1, 2) for k in (1, 2)]
    cells = spark.createDataFrame(rows, "bucket long, band int, left int, right int, side int, id long, root long, bands array<long>, sketch binary")
    assert [tuple(r) for r in _agreeing(cells).collect()] == [(2, 1)]


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 3, 40, 3000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: -(-size * 9 // 10)], rng.integers(0, 1 << 63, size // 10).astype(np.uint64)]))
        x, y = sketch(a, 128), sketch(b, 128)
        assert (x != 0).all()
        true = shared(a, b) / (len(a) + len(b) - shared(a, b))
        assert abs((x == y).mean() - true) < 0.2
    assert [len(s) for s in shingle_sets([None, "", "a", "a b c d", "A B c d a b c d"])] == [0, 0, 1, 1, 4]


# 4 languages


def test_language_spans_of_mixed_text(spark):
    english = "the house of the king and the river that was with them for this"
    german = "das haus von dem könig und der fluss der mit ihnen war nicht für diese"
    russian = "дом короля и река которая была с ними не для этого"
    docs = spark.createDataFrame(
        [(k, t * 20 + " ", lang) for k, (t, lang) in enumerate([(english, "en"), (german, "de"), (russian, "ru")] * 4)]
        + [(90, "und", None)],
        "doc_id long, text string, lang string",
    )
    model = train(docs)
    assert model.languages == ["de", "en", "ru"]
    mixed_text = " ".join([english] * 3 + [german] * 5 + [russian])
    asked = spark.createDataFrame(
        [(1, mixed_text), (2, None), (3, "123 ... 45"), (4, ""), (5, russian + " the"), (None, english), (6, english * 4000)],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r for r in identify(asked, model, spans=True).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "de", "ru"]
    assert got[1]["spans"][0]["words"] == 3 * len(english.split())
    assert got[1]["lang_pred"] == "de" and 0 < got[1]["score"] < 1
    assert [got[k]["lang_pred"] for k in (2, 3, 4, 5, None, 6)] == ["und", "und", "und", "ru", "en", "en"]
    assert got[2]["score"] == 0.0 and got[6]["score"] == 1.0
    assert identify(asked.limit(0), model).count() == 0
    unlearned = train(docs.limit(0))
    assert {r["lang_pred"] for r in identify(asked, unlearned).collect()} == {"und"}


def test_best_path_by_brute_force():
    from itertools import product

    rng = np.random.default_rng(2)
    text = np.repeat(np.arange(6), [5, 1, 4, 6, 3, 2])
    scores = rng.normal(0, 4, (len(text), 3)).astype(np.float32)
    got = best_languages(scores, text, 3.0)
    for k in range(6):
        part = scores[text == k]
        value = lambda path: sum(part[i, s] for i, s in enumerate(path)) - 3.0 * sum(a != b for a, b in zip(path, path[1:]))
        assert value(got[text == k]) == pytest.approx(max(map(value, product(range(3), repeat=len(part)))), abs=1e-4)


# 5 archives


def test_archives_round_trip(spark):
    page = "<p>" + "payload é\r\n\r\nWARC/1.1 " * 20
    rows = [(3, "http://a/", page), (1, "http://b/\r\nX: y", page), (2, None, page), (4, "u", None), (5, "u", "short"), (6, "u", "short"),
            (7, "u", ""), (None, "n", page), (1, "twin", page), (8, "u", "z" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_digest", F.lit(1))
    from docloom.llm.common import Scratch

    records = dedup_archives(pages.drop("_digest"), Scratch(spark, "warc").path).cache()
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in records.collect()), key=key)
    n = len(page.encode())
    assert got == sorted([
        ("3", "revisit", "1", n), ("1", "response", None, n), ("2", "revisit", "1", n), ("4", "response", None, 0), ("5", "response", None, 5),
        ("6", "response", None, 5), ("7", "response", None, 0), (None, "revisit", "1", n), ("1", "response", None, n), ("8", "response", None, 200_000),
    ], key=key)
    whole = with_payloads(records.where("NOT (page_id <=> '1' AND url = 'twin')"))
    assert {bytes(r["payload"]) for r in whole.where("record_type = 'revisit'").collect()} == {page.encode()}
    assert {r["payload_digest"] for r in records.where("page_id = '3'").collect()} == {hashlib.sha256(page.encode()).hexdigest()}
    assert dedup_archives(pages.drop("_digest").limit(0), Scratch(spark, "warc").path).count() == 0
    clashing = pages.withColumns({c: F.lit("mine") for c in ("_digest", "_first", "_bytes", "_payload", "_n", "value")})
    again = dedup_archives(clashing, Scratch(spark, "warc").path)
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in again.collect()), key=key) == got


def test_parse_rejects_a_cut_archive():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"
    with pytest.raises(ValueError):
        list(parse_records(record))


# 6 id files


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    plain, mine = Tokenizer.from_file(default_tokenizer()), Encoder(default_tokenizer())
    rng = random.Random(4)
    parts = ["a", "Bc", "é", " ", "  ", "\n", "\r\n", "'s", "'", "12", "_", "<|endoftext|>", "$$", ",", "\x1c", "\xa0", "\u3000", "日本", "🙂", "\u200b", "\x85", "\u0301"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    want = [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(mine.encode_batch(texts)) == want
    assert list(mine.encode_batch(texts)) == want


def expected_ids(rows, end):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_tokenizer())
    return [np.asarray([*plain.encode(r[1] or "", add_special_tokens=False).ids, end], "<u4") for r in rows]


def test_id_files_round_trip(spark, messy, messy_rows, none):
    got = [tuple(r) for r in round_trip(messy, ids=True).collect()]
    ids = expected_ids(messy_rows, 0)
    want = sorted(((r[0] is not None, r[0] or 0), i.tobytes()) for r, i in zip(messy_rows, ids))
    got.sort(key=lambda r: r[1])
    at = 0
    for row in got:
        assert (row[1], row[2] * 4, row[3]) == (at, len(row[4]), zlib.crc32(row[4]))
        at += row[2]
    assert sorted(((r[0] is not None, r[0] or 0), bytes(r[4])) for r in got) == want
    assert [r[0] for r in got] == sorted((r[0] for r in messy_rows), key=lambda k: (k is not None, k or 0))
    assert round_trip(none).count() == 0


def test_single_document_access(spark, tmp_path):
    from docloom.llm.idfiles import write_ids

    docs = spark.createDataFrame([(k, prose(k, 30)) for k in range(50)], "doc_id long, text string")
    write_ids(docs, str(tmp_path / "ids"))
    dictionary = bytes(spark.read.parquet(str(tmp_path / "ids/dictionary")).first()[0])
    found = [read_document(p.read_bytes(), dictionary, 17) for p in sorted((tmp_path / "ids/blocks").glob("part-*"))]
    found = [f for f in found if f is not None]
    assert len(found) == 1 and found[0].tobytes() == expected_ids([(17, prose(17, 30))], 0)[0].tobytes()
    with pytest.raises(ValueError):
        read_document(sorted((tmp_path / "ids/blocks").glob("part-*"))[0].read_bytes(), b"other" * 20, 17)


def test_copies_do_not_fill_the_dictionary_sample(spark):
    from docloom.llm.idfiles import SAMPLE_DOCS, train_dictionary

    docs = spark.createDataFrame([(prose(k, 60),) for k in range(80)] + [(None,), ("",)], "text string")
    first = docs.where("text <> ''").orderBy(F.xxhash64("text")).limit(1)
    copies = docs.union(first.crossJoin(spark.range(SAMPLE_DOCS)).select("text"))
    assert train_dictionary(copies, "text", default_tokenizer()) == train_dictionary(docs, "text", default_tokenizer())


# 7 urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es", "block"),
         ("net", "/es", "allow"), ("", "/ads/", "block"), ("a.net", "", "allow")]


def brute_rule(host, path):
    fits = [(h.count(".") + 1 if h else 0, len(p), v == "block", h + p, v) for h, p, v in RULES
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


def test_url_rules_by_brute_force(spark):
    rng = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "x.www.example.com", "com", "acom", "net", "a.net", "b.a.net", "a..net", "", "org", "net:80"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es", "/esp/a", "/ads/", "/ads", "//", "/en/?q=/es", "#/en/"]
    urls = [f"{rng.choice(['http', ''])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "http://", "a://b://c/en/"]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in filter_urls(pages, RULES).collect()}
    for k, url in enumerate(urls):
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].lower(), found[2]) if found else ("", "")
        assert (got[k]["host"], got[k]["path"], (got[k]["rule"], got[k]["verdict"])) == (host, path, brute_rule(host, path)), url
    joined = filter_urls(pages, RULES, broadcast_rules=0)
    assert sorted(map(tuple, joined.collect()), key=key) == sorted(map(tuple, got.values()), key=key)
    assert Trie(RULES).find("nowhere.org", "/x") is None
    assert filter_urls(pages.limit(0), RULES).count() == 0
    assert filter_urls(pages, []).where("rule IS NOT NULL").count() == 0


def test_url_filter_keeps_clashing_columns(spark):
    columns = ["_host", "_path", "_found", "_row", "_rh", "a.b"]
    pages = spark.createDataFrame([(1, "http://example.com/en/", *columns)], ["page_id", "url", *columns])
    for limit in (0, 100):
        got = filter_urls(pages, RULES, broadcast_rules=limit)
        assert got.columns == ["page_id", "url", *columns, "host", "path", "rule", "verdict"]
        assert tuple(got.first())[2:] == (*columns, "example.com", "/en/", "example.com/en/", "block")


# 8 mixing


def brute_targets(sizes, weights, cap=3):
    total, active, targets = sum(sizes.values()), set(sizes), {}
    while active:
        level = total / sum(weights[s] for s in active)
        over = {s for s in active if level * weights[s] > cap * sizes[s]}
        if not over:
            return targets | {s: level * weights[s] for s in active}
        for s in over:
            targets[s] = cap * sizes[s]
            total -= targets[s]
        active -= over
    return targets


def test_mix_meets_targets(spark):
    rng = random.Random(9)
    rows = []
    for source, n in (("a", 3000), ("b", 40), (None, 30), ("Z", 400), ("e", 2)):
        rows += [(len(rows) + k, prose(k, rng.choice([1, 5, 30])), source) for k in range(n)]
    rows += [(None, None, "a"), (7, "same id", "b"), (7, "same id", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [r.asDict() for r in mix(docs).collect()]
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    wanted = brute_targets(sizes, {s: [5, 2, 1][k % 3] for k, s in enumerate(order)})
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        assert r["taken"] == r["size"] * len(r["shards"]) and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= max(5, 0.002 * target), source
    again = mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mix(docs).collect())
    whole = mixed_rows(docs)
    assert whole.count() == sum(len(r["shards"]) for r in got)
    assert whole.columns == ["doc_id", "text", "source", "mix_shard"]
    assert mix(docs.limit(0)).count() == 0


def test_mix_handles_messy_rows(messy, messy_rows):
    got = mix(messy).collect()
    assert len(got) == len(messy_rows)
    assert {(r["size"] == 0, r["taken"] == 0) for r in got if not r["size"]} == {(True, True)}
    given = messy.sparkSession.createDataFrame([("s1", 3.0), (None, 1.0)], "source string, weight double")
    assert {r["source"] for r in mix(messy, given).collect()} == {"s1", None}


def test_splitting_tree_is_exact_and_fair(spark):
    quotas = spark.createDataFrame([(1, 500), (2, 40), (3, 0), (4, 1)], "source_no int, n long")
    rows = shard_quotas(quotas, 8, 3).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        by_source[r["source_no"]] += r["n"]
        by_shard[r["shard"]] += r["n"]
    assert by_source == {1: 500, 2: 40, 3: 0, 4: 1}
    assert max(by_shard.values()) - min(by_shard.values()) <= 3
    assert all(30 < r["n"] < 90 for r in rows if r["source_no"] == 1)


def test_mixed_rows_form_the_output_shards(spark):
    rows = [(k, prose(k, 5), "ab"[k >= 600]) for k in range(900)]  # clustered by source
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(3)
    want = Counter((r["source"], s) for r in mix(docs, shards=4).collect() for s in r["shards"])
    for part_words, parts in ((10**6, 1), (600, 2)):
        placed = mixed_rows(docs, shards=4, part_words=part_words).withColumn("at", F.spark_partition_id()).collect()
        assert Counter((r["source"], r["mix_shard"]) for r in placed) == want
        assert {s for _, s in want} == set(range(4)) and {r["at"] for r in placed} == set(range(4 * parts))
        assert all(r["at"] // parts == r["mix_shard"] for r in placed)
        assert any(len({r["source"] for r in placed if r["at"] == p}) == 2 for p in range(4 * parts))
    clashing = docs.withColumns({c: F.lit("mine") for c in ("mix_shard", "row", "shards")})
    again = mixed_rows(clashing, shards=4)
    assert again.columns == ["doc_id", "text", "source", "row", "shards", "mix_shard"]
    assert Counter((r["source"], r["mix_shard"]) for r in again.where("row = 'mine' AND shards = 'mine'").collect()) == want


# 9 quality


def brute_quality(row):
    text = row[1] or ""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen, hit = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            hit |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (row[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def test_quality_counts_by_brute_force(messy, messy_rows, none):
    got = [tuple(r) for r in quality(messy).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    assert sorted(got, key=key) == sorted(map(brute_quality, messy_rows), key=key)
    assert quality(none).count() == 0 and keep_good(none).count() == 0


def test_frequent_lines_deplete(spark):
    common = "Read our  terms of use before you go on from this page today"
    rows = [(k, f"{common}\n{prose(k, 30)}", "h") for k in range(12)]
    rows += [(50, "\n".join([common.lower()] * 3 + ["one own word"]), "h"), (51, f"{common}\n{common}", "other"), (52, prose(52, 30), None)]
    rows += [(60 + k, prose(99, 40), "copies") for k in range(20)]
    rows.append(rows[12])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality(docs, limit=10).collect()}
    n = len(common.split())
    assert all(got[k]["kept"] and got[k]["n_line_words"] == n for k in range(12))
    assert got[50]["n_line_words"] == 3 * n and not got[50]["kept"]
    assert got[51]["n_line_words"] == 0
    assert got[52]["kept"] and all(got[60 + k]["kept"] for k in range(20))


def test_keep_good_keeps_columns(messy):
    kept = keep_good(messy)
    assert kept.columns == messy.columns
    good = quality(messy).where("kept")
    assert kept.count() == good.count()


def test_keep_good_removes_frequent_lines(spark):
    common = "Read our terms of use before you go on from this page today"
    tail = f"  {prose(40, 5)}\n\n" + prose(41, 30)
    rows = [(k, f"{common}\n{prose(k, 30)}\n{common.upper()}", "h", k) for k in range(12)]
    rows += [(20, f"{tail}\n{common}\n", "h", 20), (21, f"{common}\nfew", "h", 21), (22, tail, "h", 22), (22, f"{common}\n{tail}", None, 23)]
    rows += [(None, f"{tail}\r\n  {common.replace(' ', '  ')}", "h", 24)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _at long")
    got = sorted(map(tuple, keep_good(docs, limit=10).collect()), key=lambda r: r[3])
    want = [(k, prose(k, 30), "h", k) for k in range(12)]
    want += [(20, f"{tail}\n", "h", 20), (22, tail, "h", 22), (22, f"{common}\n{tail}", None, 23), (None, f"{tail}\r", "h", 24), (None, f"{tail}\r", "h", 24)]
    assert got == want


def test_line_rule_is_alike_at_every_host_size(spark):
    common, short = "Read our terms of use before you go on from this page today", "les."
    verdicts = {}
    for n in (400, 4000):
        rows = [(k, f"own{k}\n" + "\n".join([common] * 5) if k % 5 == 0 else "\n".join([short] * 25) + f"\nown{k} " + " ".join(f"w{k}x{j}" for j in range(10)) if k % 30 == 1 else f"own{k} word", "h") for k in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        counted = quality(docs).select("doc_id", "n_line_words", (F.col("n_line_words") >= 60).alias("hit"), (F.col("n_line_words") > 0).alias("any"))
        verdicts[n] = {(r["doc_id"] % 5 == 0, r["hit"], r["any"]) for r in counted.collect()}
    assert verdicts[400] == verdicts[4000] == {(True, True, True), (False, False, False)}


# 10 packing


def check_packing(rows, got):
    ids = defaultdict(list)
    for r, i in zip(rows, expected_ids(rows, 1)):
        ids[r[0], len(i)].append(i)
    pieces, sequences = defaultdict(Counter), defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]][r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["window"]))
    assert set(pieces) == set(ids)
    for k, found in pieces.items():
        assert sum(n * c for (_, n, _), c in found.items()) == k[1] * len(ids[k])
        for start, length, crc in found:
            assert crc in {zlib.crc32(i[start : start + length].tobytes()) for i in ids[k]}
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length, window in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and (at == window or window == 2048) and at <= 2048
        padding += window - at
        total += at
    return padding, total


def test_packing_by_brute_force(spark, messy, messy_rows, none):
    padding, total = check_packing(messy_rows, pack(messy).collect())
    tasks = max(messy.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    assert padding <= 2048 * tasks and total > 40_000
    assert pack(none).count() == 0


def test_packer_fills_windows():
    rng, packer, made = random.Random(1), Packer(), []
    for k in range(3000):
        made += packer.add(k, rng.choice([1, 30, 300, 900, 2047, 2048, 5000]))
        made += packer.windows()
    assert all(sum(p[0] for p in pieces) == size for size, pieces in made)
    made += packer.windows(finish=True)
    assert sum(sum(p[0] for p in pieces) != size for size, pieces in made) <= 1
