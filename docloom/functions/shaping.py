"""Document shaping: JSON fields, promoted metadata, document encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docloom.functions.phpvalue import php_to_json


def decode_json_fields(
    df: DataFrame, fields: Mapping[str, str], keep_raw: bool = True
) -> DataFrame:
    """Decode text columns holding JSON arrays; ``fields`` maps column to array type.

    Missing, empty and ``null`` text gives NULL. Text that is no JSON array, or
    whose elements do not fit the type, gives NULL too and stays readable in
    ``<field>_raw``. Columns the frame does not have are not added.
    """
    columns = {}
    for field, kind in fields.items():
        if field not in df.columns:
            continue
        text = F.col(field)
        # Wrapped in one more array, so that trailing text is an error.
        wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{kind}>")
        value = F.when(F.size(wrapped) == 1, F.element_at(wrapped, 1))
        fits = value.isNotNull() & ~F.exists(value, lambda e: e.isNull())
        columns[field] = F.when(fits, value)
        if keep_raw:
            said = (F.length(text) > 0) & (F.trim(text) != "null")
            columns[f"{field}_raw"] = F.when(said & ~F.coalesce(fits, F.lit(False)), text)
    return df.withColumns(columns)


def decode_json_mixed(df: DataFrame, fields: Sequence[str], keep_raw: bool = True) -> DataFrame:
    """Decode text columns holding JSON arrays of any elements, as ``array<variant>``.

    No type is given beforehand: each element keeps its own, a null too, and
    documents show it as it was. All else is as for :func:`decode_json_fields`.
    """
    columns = {}
    for field in fields:
        if field not in df.columns:
            continue
        text = F.col(field)
        # Wrapped in an array and in an object: text after the value breaks one of them.
        alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
        wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit(',"end":1}')))
        value = F.when(alone, F.try_variant_get(wrapped, "$.v", "array<variant>"))
        columns[field] = value
        if keep_raw:
            said = (F.length(text) > 0) & (F.trim(text) != "null")
            columns[f"{field}_raw"] = F.when(said & value.isNull(), text)
    return df.withColumns(columns)


#: Leading word of a variant's schema, and the kind it stands for; numbers have several.
_KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null"}


def json_kind(value: Column) -> Column:
    """``object``, ``array``, ``text``, ``number``, ``boolean`` or ``null`` of a variant that was read from JSON."""
    word = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(kinds, word), F.lit("number")))


def _holds(key: str):
    return lambda pair: F.map_contains_key(pair, key)


def promote_meta(
    df: DataFrame,
    array_col: str,
    keys: Mapping[str, str],
    decoder=php_to_json,
) -> DataFrame:
    """Move the pairs of listed keys out of ``array_col`` into top-level columns.

    ``keys`` maps metadata key to new column. The last pair of a key wins; its
    value goes through ``decoder`` (serialized text to JSON text; ``None``
    keeps it). All other pairs stay, once and in order. The Python decoder
    gets only the values found, all else is NULL and skips it.
    """
    promoted = F.array(*[F.lit(k) for k in keys])
    columns: dict[str, Column] = {}
    for key, name in keys.items():
        # try_element_at: NULL where the key does not occur.
        hits = F.filter(F.col(array_col), _holds(key))
        value = F.try_element_at(F.try_element_at(hits, F.lit(-1)), F.lit(key))
        columns[name] = decoder(value) if decoder else value
    rest = F.filter(
        F.transform(
            F.col(array_col),
            lambda m: F.map_filter(m, lambda k, _: ~F.array_contains(promoted, k)),
        ),
        lambda m: F.size(m) > 0,
    )
    return df.withColumns({**columns, array_col: rest})


_AS_TEXT = (T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _changes(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _changes(kind.elementType)
    if isinstance(kind, T.MapType):
        return _changes(kind.valueType)
    return isinstance(kind, (T.StructType, *_AS_TEXT))


def _document_value(col: Column, kind: T.DataType) -> Column:
    """``col`` as documents have it: struct fields in name order at every level,
    dates, times (``yyyy-MM-dd HH:mm:ss``) and binary values as text."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, _AS_TEXT):
        return col.cast("string")
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        made = F.struct(*[_document_value(col[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(col.isNotNull(), made)
    if isinstance(kind, T.ArrayType) and _changes(kind):
        return F.transform(col, lambda e: _document_value(e, kind.elementType))
    if isinstance(kind, T.MapType) and _changes(kind):
        return F.transform_values(col, lambda _, v: _document_value(v, kind.valueType))
    return col


def to_document_json(
    df: DataFrame,
    id_key: str,
    json_columns: Sequence[str] = (),
    raw_of: Mapping[str, str] | None = None,
    exclude: Sequence[str] = (),
    keep: Sequence[str] = (),
    parts: Sequence[str] = (),
) -> DataFrame:
    """``(doc_id, *keep, body)``: every row as one JSON object.

    Keys are sorted, NULLs are written. ``parts`` are the part numbers of
    folded columns: a row with a part above 0 continues an oversized document
    and gets the id ``<id>#<part>``. ``json_columns`` hold JSON text that is
    embedded as a value. ``raw_of`` maps a decoded column to the column with
    its undecoded text, which is written as text where decoding failed.
    """
    raw_of = raw_of or {}
    hidden = {*raw_of.values(), *exclude, *parts}
    cells = []
    for field in sorted((f for f in df.schema.fields if f.name not in hidden), key=lambda f: f.name):
        name = field.name
        cell = _document_value(F.col(f"`{name}`"), field.dataType)
        if name in json_columns:
            cell = F.try_parse_json(cell)
        elif name in raw_of:
            cell = F.coalesce(F.to_variant_object(cell), F.col(raw_of[name]).cast("variant"))
        cells.append(cell.alias(name))
    body = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
    doc_id = F.col(id_key).cast("string")
    if parts:
        further = F.greatest(F.lit(0).cast("long"), *[F.col(p) for p in parts]) > 0
        suffix = F.concat(F.lit("#"), F.concat_ws(".", *[F.col(p).cast("string") for p in parts]))
        doc_id = F.when(further, F.concat(doc_id, suffix)).otherwise(doc_id)
    return df.select(doc_id.alias("doc_id"), *keep, body.alias("body"))


def doc_type_name(col: Column | str) -> Column:
    """Document type without its leading underscore."""
    return F.regexp_replace(col, "^_", "")


def line_breaks(col: Column | str) -> Column:
    """Literal backslash-n sequences as line breaks."""
    return F.replace(col, F.lit("\\n"), F.lit("\n"))


def compact_time(ts: Column | str, time_zone: str | None = None) -> Column:
    """``yyyyMMddHHmmss`` of a UTC wall-clock timestamp in ``time_zone`` (as it is without)."""
    moment = F.col(ts) if isinstance(ts, str) else ts
    if time_zone:
        moment = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), moment)
    return F.date_format(moment, "yyyyMMddHHmmss")
