"""Surrogate ids (SERIAL) in a global order, without a single-task sort.

1. the rows are written to the shared scratch folder once; what is observed on
   them (counts of the load) is therefore counted once;
2. the stored rows are range-partitioned and sorted on the order columns plus
   tie-breakers (a row hash and the stored position), so even a key holding a
   third of all rows is spread over several tasks, and written with their
   partition number and their position in it;
3. the rows of each partition are counted; the running total over these (one
   row a partition) gives each partition's offset, joined as a broadcast;
4. id = offset of the partition + position inside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def with_surrogate_id(df: DataFrame, order: Sequence[str], id_col: str = "id",
                      start: int = 1, partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    cols = list(df.columns)

    def stored(rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, "ids")
        rows.write.parquet(path)
        return spark.read.parquet(path)

    rows = stored(df).withColumn("_h", F.xxhash64(*cols)).withColumn("_m", F.monotonically_increasing_id())
    keys = [F.col(c) for c in (*order, "_h", "_m")]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    position = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    placed = stored(ranged.sortWithinPartitions(*keys).select(
        F.spark_partition_id().alias("_p"), position.alias("_i"), *cols))
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_o"))
    return (placed.join(F.broadcast(offsets), "_p")  # as many rows as there are partitions
            .select((F.col("_o") + F.col("_i") + F.lit(start)).cast("bigint").alias(id_col), *cols))
