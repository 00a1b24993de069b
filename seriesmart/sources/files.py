"""File listing of a landing folder (path, size, time, optional MD5), and which
of many wanted paths it holds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .heads import open_stream

#: Bytes of a file that are hashed at once.
BLOCK = 1 << 23


def manifest(spark: SparkSession, root: str, with_md5: bool = False,
             glob: str | None = None) -> DataFrame:
    """One row per file under ``root`` (recursive): ``path, length, modified,
    file`` (the path as rows of the file name it); files of no bytes are passed over.  Content is read only when
    ``with_md5`` asks for a checksum - then each file is read by one task, a
    block at a time, so a file may be of any size.  (Where a file system can't be
    opened by URI, Spark reads the content as a value, up to 2 GB a file.)"""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root)
    cols = [F.col("path"), F.col("length"), F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("file")]
    if not with_md5:
        return df.select(*cols)
    first = df.select("path").first()
    if first is not None and not _known(first["path"]):
        return df.select(*cols, F.md5("content").alias("md5"))
    return df.select(*cols).mapInArrow(_digests, "path string, length long, modified timestamp, file string, md5 string")


def _known(path: str) -> bool:
    stream = open_stream(path)
    if stream is not None:
        stream.close()
    return stream is not None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            with open_stream(row.column(0)[0].as_py()) as stream:
                digest = digest_of(stream)
            yield pa.RecordBatch.from_arrays([*row.columns, pa.array([digest])], [*row.schema.names, "md5"])


def digest_of(stream, block: int = BLOCK) -> str:
    """MD5 of a stream, read in blocks."""
    md5 = hashlib.md5()
    while got := stream.read(block):
        md5.update(got)
    return md5.hexdigest()


def plain_path(path: Column | str) -> Column:
    """A path without its scheme: ``/folder/file``, with an authority ``//host/folder/file``."""
    return F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:", ""), r"^///+", "/")


def with_folders(files: DataFrame, path: str = "path") -> DataFrame:
    """A row for each file and each of its folders up to the root, as ``above``
    (without scheme; where there is an authority, with it and without)."""
    own = plain_path(path)
    both = F.array_distinct(F.array(own, F.regexp_replace(own, r"^//[^/]*", "")))
    steps = lambda p: F.transform(F.split(p, "/"), lambda _, i: F.array_join(F.slice(F.split(p, "/"), 1, i + 1), "/"))
    return files.withColumn("above", F.explode(F.array_distinct(F.flatten(F.transform(both, steps)))))


def wanted_paths(spark: SparkSession, wanted: Iterable[tuple], names: str) -> DataFrame:
    """Rows of ``names`` (the last one is ``path``), with the path as ``above`` is written."""
    rows = spark.createDataFrame(list(wanted), names)
    return rows.withColumn("above", F.regexp_replace(plain_path("path"), "/+$", ""))


def existing_per_key(spark: SparkSession, root: str, keys: Iterable, patterns: Sequence[str]) -> list[tuple[object, str]]:
    """For each key the first pattern (``{root}``, ``{key}`` placeholders)
    naming an existing file or folder under ``root``: ``[(key, path), ...]``.

    One listing of ``root``, whose files and folders are joined to the wanted
    paths; what comes back is a row a key."""
    base, keys = root.rstrip("/"), list(keys)
    wanted = [(i, j, p.format(root=base, key=k, year=k)) for i, k in enumerate(keys) for j, p in enumerate(patterns)]
    if not wanted:
        return []
    there = with_folders(manifest(spark, base).select("path")).select("above").distinct()
    found = (wanted_paths(spark, wanted, "i int, j int, path string").join(there, "above", "left_semi")
             .groupBy("i").agg(F.min_by("path", "j").alias("path")).orderBy("i").collect())
    return [(keys[r["i"]], r["path"]) for r in found]
