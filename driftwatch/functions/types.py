"""Column classes (P1, P3) and the value expressions profiled per class."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..config import WORK_DECIMAL

_NUMERIC = (T.NumericType, T.BooleanType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def column_class(dtype: T.DataType) -> str:
    """``numeric`` (int family, decimal, float, double, boolean) or ``text``.

    Strings, char/varchar, dates, timestamps (with or without time zone),
    binary, nested and every other type are ``text``: they get counts and a
    distinct count only, never a decimal cast.
    """
    return "numeric" if isinstance(dtype, _NUMERIC) else "text"


def data_type_label(field: T.StructField) -> str:
    """The type string ``DESCRIBE`` shows (``varchar(10)`` stays ``varchar(10)``)."""
    raw = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING") if field.metadata else None
    return raw or field.dataType.simpleString()


def base_type(label: str) -> str:
    """``varchar(10)`` -> ``varchar`` (the v1 label normalisation)."""
    return label.split("(")[0]


def numeric_value(c: Column) -> Column:
    """The working decimal; NULL (not an error) for NaN, inf or overflow."""
    return c.try_cast(WORK_DECIMAL)


def median_value(c: Column) -> Column:
    """A8 input: the value truncated toward zero to bigint, NULL when it does not fit."""
    return c.try_cast("bigint")


def _canonical(c: Column, dtype: T.DataType) -> Column:
    """Equal values (by Spark's own equality) get equal JSON, different ones different JSON."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c + F.lit(0.0).cast(dtype)  # -0.0 equals 0.0
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _canonical(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        inner = F.struct(*[_canonical(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(dtype.fields)])
        return F.when(c.isNotNull(), inner)
    if isinstance(dtype, T.MapType):
        pair = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        return F.array_sort(_canonical(F.map_entries(c), T.ArrayType(pair)))
    if isinstance(dtype, T.BinaryType):
        return F.hex(c)
    return c.cast("string")  # exact text: JSON would cut timestamps to milliseconds


def text_value(c: Column, dtype: T.DataType) -> Column:
    """String form used to count distinct values of a non-numeric column."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BinaryType):
        return F.base64(c)
    if isinstance(dtype, _NESTED):
        return F.to_json(_canonical(c, dtype), {"ignoreNullFields": "false"})
    return c.cast("string")


def text_key(text: Column) -> Column:
    """The text's bytes, or the SHA-256 of a long one; with the length beside it, the key of the text."""
    return F.when(F.octet_length(text) <= 32, F.encode(text, "UTF-8")).otherwise(F.unhex(F.sha2(text, 256)))
