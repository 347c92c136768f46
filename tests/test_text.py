from __future__ import annotations

import random

import pytest

from docloom.operators import text as text_operators
from docloom.operators.phrases import Automaton
from docloom.operators.text import (
    ANALYZERS, Analyzer, analyze, apply_mapping, copy_to, expand_synonyms, explode_tokens, lowercase_normal,
    mapping_errors, remove_spaces, shingle, shingle_graph, shingle_synonyms, special_chars_to_space, synonym_graph, tokenize,
)
from docloom.sources.named import synonym_groups
from tests.conftest import rows


def texts(spark, *items):
    return spark.createDataFrame(list(enumerate(items)), "id int, t string")


def tokens(spark, text, analyzer, groups=None):
    found = analyze(texts(spark, text), ["id"], "t", analyzer, groups).orderBy("pos", "token").collect()
    return [(r["pos"], r["token"]) for r in found]


def groups_of(spark, *lines):
    return synonym_groups(spark.createDataFrame([(line,) for line in lines], "value string"))


def test_analyzers(spark):
    text = "The Quick_fox's ÉTÉ, 4x4"
    assert tokens(spark, text, "default") == [(1, "quick"), (2, "fox"), (3, "s"), (4, "été"), (5, "x")]
    assert tokens(spark, text, "default_search") == tokens(spark, text, "default")
    assert tokens(spark, text, "synonym") == [(0, "The"), (1, "Quick_fox's"), (2, "ÉTÉ,"), (3, "4x4")]
    assert tokens(spark, text, "whitespace_analyzer")[0] == (0, "the")
    assert tokens(spark, text, "keyword_analyzer") == [(0, text.lower())]
    assert tokens(spark, "A,b c,,D", "comma_split_pattern_analyzer") == [(0, "a"), (1, "b c"), (2, "d")]
    assert len(ANALYZERS) == 8


def test_no_text(spark):
    df = texts(spark, None, "", "12 34")
    for name in ANALYZERS:
        if name in ("default", "shingle_analyzer"):
            assert rows(analyze(df, ["id"], "t", name)) == []


def test_shingles_show_removed_words(spark):
    found = tokens(spark, "the quick and the brown fox is", "shingle_analyzer")
    assert found == [
        (0, "_ quick"), (1, "quick"), (1, "quick _"), (3, "_ brown"), (4, "brown"), (4, "brown fox"),
        (5, "fox"), (5, "fox _"),
    ]
    only = tokenize(texts(spark, "one two"), ["id"], "t", Analyzer("letter"))
    assert rows(shingle(only, ["id"], unigrams=False)) == [(0, 0, "one two")]


def test_synonyms_of_one_and_several_teles(spark):
    groups = groups_of(spark, "tv,tele set,teleset", "a1")
    assert tokens(spark, "my tv site", "default", groups) == [
        (0, "my"), (1, "tele"), (1, "teleset"), (1, "tv"), (2, "set"), (2, "site"),
    ]
    assert tokens(spark, "tele set", "default", groups) == [
        (0, "tele"), (0, "teleset"), (0, "tv"), (1, "set"),
    ]
    assert tokens(spark, "tele other", "default", groups) == [(0, "tele"), (1, "other")]
    # A removed tele breaks a run.
    assert tokens(spark, "tele the set", "default", groups) == [(0, "tele"), (2, "set")]


def test_synonyms_write_a_token_once_per_position(spark):
    groups = groups_of(spark, "a b,a c", "b,c", "x,y", "y,x,z")
    plain = tokenize(texts(spark, "a b x"), ["id"], "t", Analyzer("letter", lowercase=True))
    assert rows(expand_synonyms(plain, ["id"], groups)) == sorted(
        [(0, 0, "a"), (0, 1, "b"), (0, 1, "c"), (0, 2, "x"), (0, 2, "y"), (0, 2, "z")], key=str
    )


def test_shingles_after_synonyms(spark):
    groups = groups_of(spark, "tv,tele set")
    found = tokens(spark, "the tv of", "shingle_analyzer", groups)
    assert found == [
        (0, "_ tele"), (0, "_ tv"), (1, "tele"), (1, "tele _"), (1, "tele set"), (1, "tv"), (1, "tv _"),
        (1, "tv set"), (2, "set"),
    ]
    # Words added beyond the end, and next to each other.
    found = tokens(spark, "a tv", "shingle_analyzer", groups_of(spark, "tv,x y z", "tv,q"))
    assert [t for _, t in found] == [
        "_ q", "_ tv", "_ x", "q", "q y", "tv", "tv y", "x", "x y", "y", "y z", "z",
    ]


def test_no_groups(spark):
    empty = groups_of(spark, ",")
    assert tokens(spark, "word press", "default", empty) == [(0, "word"), (1, "press")]


def test_long_text_is_analyzed_whole(spark):
    text = " ".join(f"w{'x' * (i % 7)}" for i in range(30_000))
    plain = tokenize(texts(spark, text), ["id"], "t", Analyzer("letter"))
    assert explode_tokens(plain, ["id"]).count() == 30_000
    assert shingle(plain, ["id"]).count() == 59_999


def test_char_filters_and_normalizer(spark):
    df = texts(spark, "A'b_c d")
    found = df.select(special_chars_to_space("t"), remove_spaces("t"), lowercase_normal("t")).first()
    assert tuple(found) == ("A b c d", "A'b_cd", "a'b_c d")


def test_copy_to_skips_nulls_and_extends(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert copy_to(df, ["x", "y"], "all").first()["all"] == "a"
    assert copy_to(df, ["z"], "x").first()["x"] == "a 3"


MAPPING = {
    "properties": {
        "id": {"type": "integer"},
        "shelf_id": {"type": "integer"},
        "title": {"type": "text", "copy_to": ["all_text"]},
        "categories": {
            "type": "nested",
            "properties": {"shelfNo": {"type": "integer"}, "shelfName": {"type": "text"}},
        },
        "meta": {"type": "nested", "properties": {"label": {"type": "text"}}},
        "all_text": {"type": "text"},
    }
}


def test_mapping(spark):
    df = spark.sql(
        """
        SELECT 1 AS ID, '7' AS shelf_id, 'T' AS title, 5 AS unmapped,
               array(named_struct('shelfNo', 3L, 'shelfName', 'n', 'parent', 0)) AS categories,
               '[{"label":"k","content":"v"}]' AS meta
        """
    )
    for mapping in (MAPPING, {"doc": MAPPING}):
        found = apply_mapping(df, mapping, keep=["ID"])
        assert found.columns == ["ID", "shelf_id", "title", "categories", "meta", "all_text"]
        row = found.first()
        assert (row["shelf_id"], row["all_text"], row["meta"][0]["label"]) == (7, "T", "k")
        assert row["categories"][0].asDict() == {"shelfNo": 3, "shelfName": "n"}


def test_mapped_maps(spark):
    df = spark.sql("SELECT array(map('label', 'a'), map('other', 'b')) AS meta")
    assert [e["label"] for e in apply_mapping(df, MAPPING).first()["meta"]] == ["a", None]


def test_mapping_errors(spark):
    values = ["1", "x", None, "3000000000", "2.0", ""]
    df = spark.createDataFrame([(v, 1) for v in values], "shelf_id string, id int")
    found = [r[0] for r in df.select(mapping_errors(df, MAPPING)).collect()]
    assert found == [None, "shelf_id", None, "shelf_id", None, "shelf_id"]


def test_graph_shingles_follow_one_reading(spark):
    groups = groups_of(spark, "de la,du", "la mer,sea side shore")
    text = texts(spark, "vue de la mer du nord", None, "", "du")
    plain = tokenize(text, ["id"], "t", Analyzer("letter", lowercase=True))
    arcs = [tuple(r) for r in synonym_graph(plain, ["id"], groups).where("path IS NOT NULL AND id = 0").orderBy("pos", "path", "step").collect()]
    assert arcs == [
        (0, 1, 2, "du", 0, 1, "du"), (0, 2, 2, "sea side shore", 0, 3, "sea"), (0, 2, 2, "sea side shore", 1, 3, "side"),
        (0, 2, 2, "sea side shore", 2, 3, "shore"), (0, 4, 1, "de la", 0, 2, "de"), (0, 4, 1, "de la", 1, 2, "la"),
    ]
    found = {r["token"] for r in shingle_graph(plain, ["id"], groups).where("id = 0").collect()}
    assert {t for t in found if " " in t} == {
        "vue de", "de la", "la mer", "mer du", "du nord", "vue du", "du mer", "de sea", "sea side", "side shore", "shore du",
        "mer de", "shore de", "la nord",
    }
    assert rows(shingle_graph(plain.where("id = 3"), ["id"], groups), "pos", "token") == [
        (0, "de"), (0, "de la"), (0, "du"), (0, "la"),
    ]


def test_automaton_finds_every_match(spark):
    draw = random.Random(4)
    words = ["a", "b", "c"]
    terms = list({tuple(draw.choices(words, k=draw.randint(1, 4))) for _ in range(12)})
    automaton = Automaton([(str(i % 5), t) for i, t in enumerate(terms)])
    for _ in range(50):
        text = draw.choices(words, k=draw.randint(0, 30))
        wanted = {(i, k) for k, t in enumerate(terms) for i in range(len(text)) if tuple(text[i : i + len(t)]) == t}
        found = list(automaton.walk([automaton.words.get(w, -1) for w in text]))
        assert set(found) == wanted and len(found) == len(wanted)


def test_large_groups_are_joined_with_the_same_result(spark, monkeypatch):
    draw = random.Random(6)
    groups = groups_of(spark, "a b,a c", "b,c", "x,y", "y,x,z", "b x y,c", "a,a b c")
    lines = [" ".join(draw.choices("a b c x y z the of q".split(), k=draw.randint(0, 25))) for _ in range(60)] + [None]
    plain = tokenize(texts(spark, *lines), ["id"], "t", "default")
    ways = [(f, rows(f(plain, ["id"], groups))) for f in (expand_synonyms, shingle_synonyms)]
    monkeypatch.setattr(text_operators, "BROADCAST_BYTES", 10)
    for function, wanted in ways:
        assert rows(function(plain, ["id"], groups)) == wanted
    with pytest.raises(ValueError, match="graph form"):
        shingle_graph(plain, ["id"], groups)


def test_expansion_neither_joins_nor_shuffles(spark):
    plain = tokenize(texts(spark, "a b"), ["id"], "t", "default")
    plan = expand_synonyms(plain, ["id"], groups_of(spark, "a,b"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["tokens", "synonym_expand", "synonym_graph", "graph_shingles"])
def test_tokens_are_counted_where_their_texts_were_dealt(spark, tmp_path, name):
    from docloom.plans.queries import QUERIES

    # Ids that repeat or are null, no text, and stop words next to phrases.
    texts = [(1, "de la mer und der Tag"), (1, "de la mer und der Tag"), (None, "du pain"), (None, "the du"), (2, None), (3, ""), (4, "the a the")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES[name](spark, str(tmp_path))
    assert "ENSURE_REQUIREMENTS" not in found._jdf.queryExecution().executedPlan().toString()
    n = {(r["doc_id"], r["token"]): 0 for r in found.collect()}
    for r in found.collect():
        n[r["doc_id"], r["token"]] += r["n"]
    assert n[1, "mer"] == 2 and n[1, "de"] == 2 and n[None, "du"] == 2 and n[None, "pain"] == 1
    assert not {2, 3, 4} & {doc_id for doc_id, _ in n}
    if name == "graph_shingles":
        assert n[None, "_ du"] == 1 and n[1, "de la"] == 2 and n[1, "du mer"] == 2
