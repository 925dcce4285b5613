"""Tolerant casts, null handling and truthiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(c: Column | str) -> Column:
    """Empty text to null; other text unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def whole_units(c: Column | str) -> Column:
    """A number as numeric(18,0) with the fraction cut off, not rounded.

    What is no number, NaN and numbers beyond the type become null.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("decimal(38,18)").try_cast("bigint").try_cast("decimal(18,0)")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with exactly the columns and types of `schema`, matched by name.

    Names match without regard to case and missing columns become null.  Text
    that is no number becomes null instead of failing the job; NaN becomes null.
    """
    have = {c.lower(): c for c in df.columns}
    kinds = dict(df.dtypes)

    def pick(field: T.StructField) -> Column:
        source = have.get(field.name.lower())
        if source is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(f"`{source}`")
        if kinds[source] in ("float", "double"):
            value = F.when(~F.isnan(value), value)
        return value.try_cast(field.dataType).alias(field.name)

    return df.select(*[pick(field) for field in schema.fields])


def is_truthy(name: str, kind: T.DataType) -> Column:
    """Whether a value counts as true: not null, 0, '', false or empty."""
    value = F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        test = value
    elif isinstance(kind, T.NumericType):
        test = value != F.lit(0)
    elif isinstance(kind, T.StringType):
        test = value != F.lit("")
    elif isinstance(kind, T.BinaryType):
        test = F.octet_length(value) > 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(value) > 0
    else:
        test = value.isNotNull()
    return F.coalesce(test, F.lit(False))
