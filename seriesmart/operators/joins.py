"""Joins of the load: code lookups, map joins, sized by bytes.

A side is hinted as a broadcast only when its caller already knows a row count
within ``seriesmart.broadcast.maxRows``.  Otherwise nothing is counted
beforehand: Spark broadcasts a side whose size in bytes (file statistics at
planning, measured shuffle bytes at run time) is within its broadcast
thresholds, and shuffles beyond them.  A key holding a third of the fact rows
makes one partition large on the fact side only; AQE's skew handling splits it
(the other side - a series file or code list, unique on its key - has one row
for that key, which is copied to each split).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 100_000
CONF_BROADCAST_ROWS = "seriesmart.broadcast.maxRows"
# rows of a hash-join build side per shuffle partition (its hash table cannot
# spill); above budget x partitions the join sorts and merges instead
DEFAULT_HASH_ROWS_PER_PARTITION = 2_000_000
CONF_HASH_ROWS = "seriesmart.shuffleHash.maxRowsPerPartition"


def broadcast_limit(df: DataFrame, max_rows: int | None = None) -> int:
    if max_rows is not None:
        return max_rows
    v = df.sparkSession.conf.get(CONF_BROADCAST_ROWS, None)
    return int(v) if v else DEFAULT_BROADCAST_ROWS


def hash_join_limit(df: DataFrame) -> int:
    spark = df.sparkSession
    per = int(spark.conf.get(CONF_HASH_ROWS, None) or DEFAULT_HASH_ROWS_PER_PARTITION)
    return per * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """``df`` - the side of a join that is unique on its key - by its known
    ``rows``: a broadcast within the limit (``max_rows`` or the conf), the build
    side of a shuffled hash join (the fact side is only streamed) within
    ``seriesmart.shuffleHash.maxRowsPerPartition`` x shuffle partitions, else a
    side of a sort-merge join, which spills.  Without a count Spark's byte sizes
    decide.  Starts no job."""
    if rows is None:
        return df
    if rows <= broadcast_limit(df, max_rows):
        return F.broadcast(df)
    return df.hint("shuffle_hash" if rows <= hash_join_limit(df) else "merge")


def lookup_join(df: DataFrame, dim: DataFrame, key: Column | str, name_out: str,
                dim_key: str = "code", dim_name: str = "name",
                max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """Left outer code lookup: adds ``name_out``; NULL when the code is unknown
    or NULL.  ``dim`` must be unique on ``dim_key`` (code lists are).
    ``rows``: the list's row count where the caller knows it."""
    k = F.col(key) if isinstance(key, str) else key
    d = dim.select(F.col(dim_key).alias("_lk_code"), F.col(dim_name).alias(name_out))
    d = bounded_broadcast(d, max_rows, rows)
    return df.join(d, k == F.col("_lk_code"), "left").drop("_lk_code")


def map_join(facts: DataFrame, mapping: DataFrame, fact_key: str, map_key: str,
             max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """Rows of ``facts`` whose key is in ``mapping`` (inner join), with the
    mapping's columns.  Rows without a match are dropped - see ``skip_counts``."""
    m = bounded_broadcast(mapping, max_rows, rows)
    if fact_key == map_key:
        return facts.join(m, fact_key, "inner")
    return facts.join(m, facts[fact_key] == m[map_key], "inner")


def skip_counts(facts: DataFrame, mapping: DataFrame, fact_key: str, map_key: str,
                max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """One row ``loaded, skipped``: fact rows with / without a mapping entry.

    The mapping is reduced to its distinct keys first, so the left join can
    not multiply fact rows; the counts are partial-aggregated per task.
    """
    keys = mapping.select(F.col(map_key).alias("_mk")).distinct().withColumn("_hit", F.lit(True))
    keys = bounded_broadcast(keys, max_rows, rows)
    j = facts.select(fact_key).join(keys, F.col(fact_key) == F.col("_mk"), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.agg(F.count_if(hit).cast("bigint").alias("loaded"),
                 F.count_if(~hit).cast("bigint").alias("skipped"))


def orphans(facts: DataFrame, mapping: DataFrame, fact_key: str, map_key: str,
            max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """Fact rows whose key has no mapping entry (left anti join)."""
    m = bounded_broadcast(mapping.select(F.col(map_key).alias("_mk")), max_rows, rows)
    return facts.join(m, F.col(fact_key) == F.col("_mk"), "left_anti")


def orphan_counts(facts: DataFrame, mapping: DataFrame, fact_key: str, map_key: str,
                  max_rows: int | None = None, rows: int | None = None) -> DataFrame:
    """Per unmatched key, how many fact rows it has (``key, n``)."""
    return (orphans(facts, mapping, fact_key, map_key, max_rows, rows)
            .groupBy(fact_key).agg(F.count(F.lit(1)).alias("n")))
