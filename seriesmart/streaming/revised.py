"""Ingest of a landing folder whose files may be revised under their names.

A file stream takes a name once.  Here a state table holds the tag of every file
taken (its length and time); a run joins the listing to it, reads new and
changed files only, and replaces exactly their rows.  Files that are no longer
there keep their rows, as a landing folder may be cleared; so do files of no
bytes, which Spark's listing passes over.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.partitions import manifest_of, publish_partitions, read_partitions
from ..sources.files import manifest
from ..sources.text import HEADER_PREFIX, parse_lines, read_lines, starts_with


def changed_files(spark: SparkSession, landing: str, out_root: str) -> DataFrame:
    """``(part, tag)``: path and tag of the files that are new or not as they were taken."""
    tag = F.concat_ws(":", "length", F.unix_micros(F.col("modified").cast("timestamp"))).alias("tag")
    there = manifest(spark, landing).select(F.col("path").alias("part"), tag)
    taken = manifest_of(spark, out_root).select("part", F.col("tag").alias("taken"))
    return there.join(taken, "part", "left").filter("taken IS NULL OR taken <> tag").select("part", "tag")


def ingest_revised(spark: SparkSession, landing: str, columns: Sequence[str], out_root: str,
                   min_fields: int | None = None, transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Take the new and changed files under ``landing``; returns how many.

    Rows of a changed file replace those it had, also when it has none any more.
    ``transform`` shapes the parsed rows and must keep ``_file``.
    """
    from ..session import stored
    changed = stored(changed_files(spark, landing, out_root), spark, "changed")
    paths = [r["part"] for r in changed.select("part").collect()]
    if not paths:
        return 0
    rows = parse_lines(read_lines(spark, paths, header=starts_with(HEADER_PREFIX), with_file=True), columns, min_fields, keep=("_file",))
    if transform is not None:
        rows = transform(rows)
    # rows name their file encoded; the state names it as it is listed
    names = manifest(spark, landing).select(F.col("path"), F.col("file"))
    rows = rows.join(F.broadcast(names), F.col("_file") == F.col("file")).drop("file", "_file")
    publish_partitions(rows.withColumnRenamed("path", "_source"), out_root, "_source", force=True, tags=changed)
    return len(paths)


def read_ingested(spark: SparkSession, out_root: str) -> DataFrame:
    """The rows of all files as last taken."""
    return read_partitions(spark, out_root).drop("_source")
