"""Tables whose partitions are replaced one by one, each as a validated step.

A partition's new rows are written beside the live data and counted there; only
then a row of the manifest (``_manifest``) says where the partition now is.
Readers take their folders from the manifest, so they see a partition before or
after its replacement, never in between, and a refused one not at all.  All
partitions of one call appear with one append of the manifest.

A manifest row: ``part`` (the partition's value as text), ``location`` (its
folder; null: no rows), ``rows``, ``tag`` (of its source, where there is one),
``seq`` and ``published_at``; the row of the greatest ``seq`` counts.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_per_key
from ..operators.loadlog import missing
from ..operators.quality import row_count_verdict
from ..session import stored

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "part string, location string, rows long, tag string, seq long, published_at timestamp"


def manifest_of(spark: SparkSession, root: str) -> DataFrame:
    """The current row of every partition; empty where nothing is published yet."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if not missing(e):
            raise
        rows = spark.createDataFrame([], MANIFEST_SCHEMA)
    return latest_per_key(rows, ["part"], ["seq"])


def publish_partitions(df: DataFrame, root: str, by: Column | str, rules: dict[str, Column] | None = None,
                       force: bool = False, tags: DataFrame | None = None) -> DataFrame:
    """Replace the partitions of ``df`` and return ``(part, rows, prev_rows, violations, verdict)`` of each.

    ``by`` is the partition's value.  A partition is refused (``failed``) when
    rows of it break one of ``rules`` (conditions on ``df``) or when its row
    count falls too far below the published one; ``force`` accepts any count.
    ``tags (part, tag)`` names the partitions to be replaced where some may have
    no rows left; those then are empty.

    One write of the rows; the counts come from two narrow columns of what was
    written.
    """
    spark, base = df.sparkSession, root.rstrip("/")
    version = f"{base}/v={_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    part = (F.col(by) if isinstance(by, str) else by).cast("string")
    # folders are named by a digest, so any value will do; null is a value of its own
    folder = F.md5(F.concat_ws(":", F.when(part.isNull(), "null").otherwise("value"), part))
    bad = sum((F.when(rule, 1).otherwise(0) for rule in (rules or {}).values()), F.lit(0))
    placed = df.withColumn("_part", part).withColumn("_bad", bad.cast("int")).withColumn("_folder", folder)
    placed.hint("rebalance", "_folder").write.partitionBy("_folder").parquet(version)
    # counted on what was written: two of its columns, both of few values
    counts = spark.read.schema(placed.schema).parquet(version).groupBy("_folder", F.col("_part").alias("part")).agg(
        F.count("*").alias("rows"), F.sum("_bad").cast("long").alias("violations"))
    new = counts.select("part", "rows", "violations", F.concat(F.lit(f"{version}/_folder="), "_folder").alias("location"))
    if tags is not None:
        new = (tags.select("part", "tag").join(new.withColumnRenamed("part", "p"), F.col("part").eqNullSafe(F.col("p")), "left")
               .select("part", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("violations", F.lit(0)).alias("violations"), "location", "tag"))
    else:
        new = new.withColumn("tag", F.lit(None).cast("string"))
    now = manifest_of(spark, root).select(F.col("part").alias("p"), F.col("rows").alias("prev_rows"))
    both = new.join(now, F.col("part").eqNullSafe(F.col("p")), "left").drop("p")
    count_verdict = F.lit("success") if force else row_count_verdict("rows", "prev_rows")
    outcome = stored(both.withColumn("verdict", F.when(F.col("violations") > 0, "failed").otherwise(count_verdict)), spark, "outcome")
    stamp = F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    (outcome.filter("verdict <> 'failed'")
     .select("part", "location", "rows", "tag", F.lit(time.time_ns()).alias("seq"), stamp.alias("published_at"))
     .coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}"))  # a row a partition, in one file
    return outcome.select("part", "rows", "prev_rows", "violations", "verdict")


def read_partitions(spark: SparkSession, root: str, parts: Iterable[str | None] | None = None) -> DataFrame:
    """The table's current rows; with ``parts`` only those partitions' folders are read."""
    rows = manifest_of(spark, root).filter("location IS NOT NULL")
    if parts is not None:
        wanted = spark.createDataFrame([(p,) for p in parts], "p string").distinct()
        rows = rows.join(wanted, F.col("part").eqNullSafe(F.col("p")), "left_semi")
    locations = [r["location"] for r in rows.select("location").collect()]
    if locations:
        return spark.read.parquet(*locations).drop("_part", "_bad")
    some = manifest_of(spark, root).filter("location IS NOT NULL").select("location").first()
    if some is None:
        raise FileNotFoundError(f"no published partition under {root}")
    return spark.read.parquet(some["location"]).drop("_part", "_bad").filter(F.lit(False))
