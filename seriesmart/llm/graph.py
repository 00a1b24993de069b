"""Connected components of an undirected graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path


def stored(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again: later steps
    neither recompute them nor depend on an executor that holds them."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def components(links: DataFrame, spark: SparkSession) -> DataFrame:
    """``(v, c)`` for every vertex of the links ``(a, b)``, c the least vertex reachable.

    Every round, a vertex takes the least label among its own and its
    neighbours', then its label's label.  Ends when nothing changes.  No links:
    no rows.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), spark, "links")
    label = both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("c"))
    while True:
        label = stored(label, spark, "labels")
        seen = both.join(label.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m"))
        low = label.join(seen, "v").select("v", "c", F.least("c", "m").alias("m"))
        jump = low.join(label.select(F.col("v").alias("m"), F.col("c").alias("j")), "m").select("v", "c", F.least("m", "j").alias("n"))
        label = stored(jump, spark, "labels")
        if label.filter("c != n").limit(1).count() == 0:
            return label.select("v", "c")
        label = label.select("v", F.col("n").alias("c"))
