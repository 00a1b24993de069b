"""Schema-driven casts with a strict and a tolerant mode.

Strict mode fails the job on the first value that does not fit (the load is
then recorded as failed); tolerant mode turns such values into NULL and lets
``bad_value_counts`` report how many there were.  The strict check is written
with ``try_cast`` + ``raise_error`` so it behaves the same whatever the
session's ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _type(t) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return T.DataType.fromDDL(t)


def strict_cast(c: Column | str, to, what: str = "value") -> Column:
    c = _c(c)
    t = _type(to)
    casted = c.try_cast(t)
    msg = F.concat(F.lit(f"cannot cast {what} to {t.simpleString()}: '"), c.cast("string"), F.lit("'"))
    return F.when(c.isNotNull() & casted.isNull(), F.raise_error(msg).cast(t)).otherwise(casted)


def cast_value(c: Column | str, to, mode: str = "strict", what: str = "value") -> Column:
    if mode == "strict":
        return strict_cast(c, to, what)
    if mode == "tolerant":
        return _c(c).try_cast(_type(to))
    raise ValueError(f"unknown cast mode {mode!r}")


def cast_columns(df: DataFrame, schema: T.StructType | dict, mode: str = "strict") -> DataFrame:
    """Cast each named column to the schema's type; other columns unchanged.

    String targets are never parsed, so codes keep their leading zeros.
    """
    if isinstance(schema, dict):
        fields = [(k, _type(v)) for k, v in schema.items()]
    else:
        fields = [(f.name, f.dataType) for f in schema.fields]
    types = dict(fields)
    out = []
    for name in df.columns:
        if name in types and not isinstance(types[name], T.StringType):
            out.append(cast_value(name, types[name], mode, what=name).alias(name))
        elif name in types:
            out.append(F.col(name).cast("string").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def bad_value_counts(df: DataFrame, schema: dict) -> DataFrame:
    """One row: for each column, how many non-NULL values fail the cast."""
    aggs = [F.count_if(F.col(k).isNotNull() & F.col(k).try_cast(_type(v)).isNull())
            .cast("bigint").alias(f"bad_{k}") for k, v in schema.items()]
    return df.agg(*aggs)


def date_guard(c: Column | str, fmt: str | None = None) -> Column:
    """Keep a date text only when it contains '-', otherwise NULL (a date
    parse, no time zone involved)."""
    c = _c(c)
    parsed = F.try_to_date(c, F.lit(fmt)) if fmt else F.try_to_date(c)
    return F.when(c.contains("-"), parsed)
