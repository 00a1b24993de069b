"""Counts and year arithmetic of the load (all partial/final hash aggregates)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_counts(tables: Mapping[str, DataFrame], name_col: str = "tbl",
                 count_col: str = "n") -> DataFrame:
    """``COUNT(*)`` per table, one row per table (UNION ALL).  On Parquet the
    count is answered from row-group metadata without reading columns."""
    return _union([df.agg(F.count(F.lit(1)).alias(count_col))
                   .select(F.lit(name).alias(name_col), count_col)
                   for name, df in tables.items()])


def dimension_sizes(dims: Mapping[str, DataFrame], code_col: str = "code",
                    name_col: str = "dim", count_col: str = "n") -> DataFrame:
    """Distinct codes per code list, one row per list."""
    return _union([df.agg(F.countDistinct(code_col).alias(count_col))
                   .select(F.lit(name).alias(name_col), count_col)
                   for name, df in dims.items()])


def year_of(df: DataFrame, col: str) -> Column:
    """The year of ``col``: itself when it is a year number, else ``year()``."""
    t = df.schema[col].dataType
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.year(col)
    return F.col(col)


def min_max_year(df: DataFrame, year_col: str = "year") -> DataFrame:
    y = year_of(df, year_col)
    return df.agg(F.min(y).cast("int").alias("min_year"), F.max(y).cast("int").alias("max_year"))


def year_range(df: DataFrame, lo: int, hi: int, year_col: str = "year") -> DataFrame:
    """Rows whose year is in ``[lo, hi]`` (NULL years drop).

    On a date/timestamp column the bounds are rewritten as a range on the raw
    column, so the predicate reaches the Parquet scan (and partition pruning
    when the table is laid out by ``year``)."""
    t = df.schema[year_col].dataType
    c = F.col(year_col)
    if isinstance(t, T.DateType):
        return df.filter((c >= F.make_date(F.lit(lo), F.lit(1), F.lit(1)))
                         & (c < F.make_date(F.lit(hi + 1), F.lit(1), F.lit(1))))
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        cast = "timestamp_ntz" if isinstance(t, T.TimestampNTZType) else "timestamp"
        return df.filter((c >= F.lit(f"{lo:04d}-01-01 00:00:00").cast(cast))
                         & (c < F.lit(f"{hi + 1:04d}-01-01 00:00:00").cast(cast)))
    return df.filter(c.between(lo, hi))


def year_chunks(df: DataFrame, width: int, year_col: str = "year") -> DataFrame:
    """Rows per block of ``width`` years from the first year, with a running total:
    ``chunk_start, chunk_end, chunk_rows, total_rows``.

    One pass over the data reduces it to one count per year (partial
    aggregation); the first and last year, the chunks and the running total
    are then computed over those few rows (at most one per year, so the
    unpartitioned windows below never see the data itself).
    """
    per_year = (df.select(year_of(df, year_col).cast("int").alias("_yr"))
                .filter(F.col("_yr").isNotNull())
                .groupBy("_yr").agg(F.count(F.lit(1)).alias("_n")))
    everything = Window.partitionBy()
    bounded = per_year.select("_yr", "_n", F.min("_yr").over(everything).alias("_lo"),
                              F.max("_yr").over(everything).alias("_hi"))
    start = (F.col("_lo") + F.floor((F.col("_yr") - F.col("_lo")) / F.lit(width)) * width).cast("int")
    c = bounded.groupBy(start.alias("chunk_start")).agg(F.sum("_n").alias("chunk_rows"),
                                                        F.max("_hi").alias("_hi"))
    w = Window.orderBy("chunk_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return c.select(
        "chunk_start",
        F.least(F.col("chunk_start") + (width - 1), F.col("_hi")).cast("int").alias("chunk_end"),
        F.col("chunk_rows").cast("bigint").alias("chunk_rows"),
        F.sum("chunk_rows").over(w).cast("bigint").alias("total_rows"))
