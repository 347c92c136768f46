from __future__ import annotations

import json
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docloom.functions.phpvalue import decode, php_to_json
from docloom.functions.shaping import decode_json_fields, decode_json_mixed, json_kind, promote_meta, to_document_json
from tests.conftest import rows

META = "array<map<string,string>>"


def serialize(value):
    """PHP serialize() of a JSON-like value."""
    if value is None:
        return "N;"
    if isinstance(value, bool):
        return f"b:{int(value)};"
    if isinstance(value, int):
        return f"i:{value};"
    if isinstance(value, float):
        return f"d:{value!r};"
    if isinstance(value, str):
        return f's:{len(value.encode())}:"{value}";'
    items = enumerate(value) if isinstance(value, list) else value.items()
    return f"a:{len(value)}:{{{''.join(serialize(k) + serialize(v) for k, v in items)}}}"


scalars = st.none() | st.booleans() | st.integers(-(2**62), 2**62) | st.text(
    st.characters(exclude_categories=["Cs"]), max_size=12
) | st.floats(allow_nan=False, allow_infinity=False)
values = st.recursive(
    scalars,
    lambda inner: st.lists(inner, max_size=4)
    | st.dictionaries(st.text(st.characters(categories=["L"]), min_size=1, max_size=5), inner, min_size=1, max_size=4),
    max_leaves=12,
)


@given(values)
@settings(max_examples=300, deadline=None)
def test_serialized_values_round_trip(value):
    assert json.loads(decode(serialize(value))) == value


@given(values, st.integers(1, 6))
@settings(max_examples=100, deadline=None)
def test_cut_off_values_are_null(value, cut):
    assert decode(serialize(value)[:-cut]) is None


def test_serialized_cases():
    assert decode('a:2:{i:0;s:2:"é";i:1;b:0;}') == '["é", false]'
    assert decode('a:1:{i:3;s:1:"x";}') == '{"3": "x"}'
    assert decode('O:3:"Foo":2:{s:1:"a";i:1;s:4:"\0*\0b";N;}') == '{"a": 1, "b": null}'
    assert decode("d:INF;") == "null"
    assert decode("d:0.5;") == "0.5"
    for broken in ("", "x", "i:5", "i:x;", 's:3:"ab";', 's:1:"é";', "a:1:{}", "b:2;", "i:1;i:2;", "r:1;", "a:-1:{}"):
        assert decode(broken) is None
    assert decode(None) is None
    assert decode("a:1:{i:0;" * 5000) is None


def test_php_column(spark):
    df = spark.createDataFrame([("i:5;",), (None,), ("bad",)], "t string")
    assert rows(df.select(php_to_json("t"))) == [(None,), (None,), ("5",)]


JSON_CASES = {
    '[{"a":"b"},{"c":"d"}]': ([{"a": "b"}, {"c": "d"}], None),
    "[]": ([], None),
    '[{"a":"qu\\"ote é"}]': ([{"a": 'qu"ote é'}], None),
    '[{"a":null}]': ([{"a": None}], None),
    '{"a":1}': (None, '{"a":1}'),
    "bad": (None, "bad"),
    "": (None, None),
    "null": (None, None),
    "[1]": (None, "[1]"),
    '[{"a":"b"},3]': (None, '[{"a":"b"},3]'),
    "[null]": (None, "[null]"),
    '[{"a":"b"}] tail': (None, '[{"a":"b"}] tail'),
    '[{"a":"b"}': (None, '[{"a":"b"}'),
}


def test_json_fields(spark):
    df = spark.createDataFrame([(t, t) for t in JSON_CASES] + [("none", None)], "key string, f string")
    found = decode_json_fields(df, {"f": META, "absent": META})
    assert found.columns == ["key", "f", "f_raw"]
    got = {r["key"]: (r["f"], r["f_raw"]) for r in found.collect()}
    assert got == {**JSON_CASES, "none": (None, None)}


def test_json_struct_fields(spark):
    df = spark.createDataFrame([('[{"catId":5,"catName":"x"}]',)], "f string")
    kind = "array<struct<catId:bigint,catName:string,parent:bigint>>"
    assert decode_json_fields(df, {"f": kind}, keep_raw=False).first()["f"][0].asDict() == {
        "catId": 5, "catName": "x", "parent": None,
    }


def meta(spark, *arrays):
    return spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], f"id int, m {META}")


def test_promotion_takes_the_last_and_keeps_the_rest_once(spark):
    df = meta(
        spark,
        [{"k": "1"}, {"a": "x"}, {"k": "2"}, {"b": "y"}, {"p": "3"}],
        [{"k": "9"}, {"p": "8"}],
        [{"a": "x"}, {"a": "x"}],
        [],
        None,
    )
    found = promote_meta(df, "m", {"k": "kk", "p": "pp"}, decoder=None).orderBy("id").collect()
    assert [(r["m"], r["kk"], r["pp"]) for r in found] == [
        ([{"a": "x"}, {"b": "y"}], "2", "3"),
        ([], "9", "8"),
        ([{"a": "x"}, {"a": "x"}], None, None),
        ([], None, None),
        (None, None, None),
    ]


def test_promotion_decodes_serialized_values(spark):
    df = meta(spark, [{"_size": 'a:1:{s:1:"w";i:3;}'}], [{"_size": "broken"}], [{"x": "y"}])
    found = promote_meta(df, "m", {"_size": "size"}).orderBy("id").collect()
    assert [r["size"] for r in found] == ['{"w": 3}', None, None]


def test_document_json(spark):
    df = spark.sql(
        """
        SELECT 7 AS ID, 'é"' AS b, CAST(NULL AS STRING) AS a, array(named_struct('z', 1, 'a', 2)) AS c,
               '{"k": [1, true, null]}' AS j, CAST(NULL AS ARRAY<MAP<STRING,STRING>>) AS m, 'broken [' AS m_raw
        """
    )
    row = to_document_json(df, "ID", json_columns=["j"], raw_of={"m": "m_raw"}).first()
    assert row["doc_id"] == "7"
    assert json.loads(row["body"]) == {
        "ID": 7, "a": None, "b": 'é"', "c": [{"a": 2, "z": 1}], "j": {"k": [1, True, None]}, "m": "broken [",
    }
    assert list(json.loads(row["body"])) == ["ID", "a", "b", "c", "j", "m"]
    assert '"c":[{"a":2,"z":1}]' in row["body"]


def test_document_json_of_decoded_field(spark):
    df = spark.sql("SELECT 1 AS ID, array(map('k', 'v')) AS m, CAST(NULL AS STRING) AS m_raw")
    body = to_document_json(df, "ID", raw_of={"m": "m_raw"}).first()["body"]
    assert json.loads(body) == {"ID": 1, "m": [{"k": "v"}]}


def test_json_embedding_of_null_and_bad_text(spark):
    df = spark.createDataFrame([(1, None), (2, "{bad")], "ID int, j string")
    bodies = [json.loads(r["body"]) for r in to_document_json(df, "ID", json_columns=["j"]).collect()]
    assert [b["j"] for b in bodies] == [None, None]
    assert not math.isnan(bodies[0]["ID"])


def test_times_and_binary_values_in_maps_are_text(spark):
    df = spark.sql(
        """
        SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-02 03:04:05.678' AS at,
               map('a', TIMESTAMP_NTZ '2024-01-02 03:04:05.5', 'b', NULL) AS times,
               array(map('x', struct(CAST('q' AS BINARY) AS raw))) AS nested
        """
    )
    body = json.loads(to_document_json(df, "id").first()["body"])
    stamp = "2024-01-02 03:04:05"
    assert body == {"id": 1, "at": stamp, "times": {"a": stamp, "b": None}, "nested": [{"x": {"raw": "q"}}]}


def test_mixed_json_keeps_each_element(spark):
    texts = ['[1, 2.5, "a", null, true, [1, "x"], {"k": [null]}]', "[]", "[null]", '{"k": 1}', "[1", "", "null", None, "7", '[1] [2]', '["é\\"x"]', '[1]], [[2]', '[1],"end":1} x', "[1], [2]"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, field string")
    decoded = decode_json_mixed(df, ["field", "absent"])
    got = {r.id: (r.kinds, r.field_raw) for r in decoded.select("id", F.transform("field", json_kind).alias("kinds"), "field_raw").collect()}
    kinds = ["number", "number", "text", "null", "boolean", "array", "object"]
    assert got == {
        0: (kinds, None), 1: ([], None), 2: (["null"], None), 3: (None, '{"k": 1}'), 4: (None, "[1"), 5: (None, None),
        6: (None, None), 7: (None, None), 8: (None, "7"), 9: (None, "[1] [2]"), 10: (["text"], None),
        11: (None, "[1]], [[2]"), 12: (None, '[1],"end":1} x'), 13: (None, "[1], [2]"),
    }
    assert "absent" not in decoded.columns
    assert rows(decode_json_mixed(df.limit(0), ["field"])) == []
    bodies = {r.doc_id: json.loads(r.body)["field"] for r in to_document_json(decoded, "id", raw_of={"field": "field_raw"}).collect()}
    assert bodies["0"] == [1, 2.5, "a", None, True, [1, "x"], {"k": [None]}]
    assert (bodies["1"], bodies["4"], bodies["7"], bodies["10"]) == ([], "[1", None, ['é"x'])
