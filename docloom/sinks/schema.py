"""Schema normalization of extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _staged(col: Column, kind: T.DataType, compat: bool) -> Column:
    if isinstance(kind, _WHOLE):
        return col.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return col.cast("double")
    if isinstance(kind, T.DecimalType):
        # Whole decimals are unsigned 64-bit integers, which a double would round.
        return col if kind.scale == 0 or not compat else col.cast("double")
    if isinstance(kind, (T.BinaryType, T.StringType)):
        return col.cast("string")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("string") if compat else col
    if isinstance(kind, _NESTED):
        return F.to_json(col, {"ignoreNullFields": "false"}) if compat else col
    return col.cast("string")


def normalize_schema(df: DataFrame, mode: str = "native") -> DataFrame:
    """Columns with their staging types.

    Whole numbers and booleans become long, floats double, binary and all
    unlisted types string. ``native`` keeps decimals, dates, timestamps and
    nested values; ``compat`` stages decimals as double and the others as text.
    NULLs stay NULL.
    """
    if mode not in ("native", "compat"):
        raise ValueError(f"unknown mode {mode!r}")
    compat = mode == "compat"
    return df.select(
        *[_staged(F.col(f"`{f.name}`"), f.dataType, compat).alias(f.name) for f in df.schema.fields]
    )
