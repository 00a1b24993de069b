"""Header-named delimited files (CSV or TSV) of the older loader and QCEW.

Columns are matched to the header case-insensitively after trimming blanks
and quotes; wanted columns missing from the file come back as NULL.  Values
are typed by the target schema with ``try_cast`` (codes typed as strings keep
their leading zeros); ``''``, ``NA`` and ``NaN`` are NULL; a date column keeps
only text containing ``-``.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import date_guard
from ..functions.text import LEGACY_NULL_TOKENS, clean_text, null_if_token
from .heads import file_heads, misnamed, streamed_lines


def delimiter_of(line: str) -> str:
    """Tab when the line has one, else comma."""
    return "\t" if "\t" in line else ","


def detect_delimiter(spark: SparkSession, paths: str | Sequence[str]) -> str:
    """The delimiter of the first file's first line (reads one line)."""
    first = spark.read.text(paths if isinstance(paths, str) else list(paths)).limit(1).first()
    return delimiter_of(first["value"] if first is not None else "")


def clean_header(name: str) -> str:
    return name.strip().strip('"').strip().lower()


def _fields(line: str, sep: str) -> list[str]:
    return [clean_header(c) for c in next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])]


def read_delimited(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
                   schema: T.StructType | dict | None = None, sep: str | None = None,
                   null_tokens: Iterable[str] = LEGACY_NULL_TOKENS,
                   with_file: bool = False, multi_line: bool = False) -> DataFrame:
    """Read header-named files into ``columns`` (in that order), typed by
    ``schema``; ``with_file`` adds the source file path as ``_file``.

    Every file's columns go by its own header line: files are grouped by header
    and codec (gzip is known by the first bytes, whatever the name) and read in
    one scan a group; the driver holds the listing, not the lines.  ``sep`` None: each file's own delimiter.
    Quoted fields may hold delimiters and doubled quotes, a backslash is a
    character like any other; with ``multi_line`` they may also hold line
    breaks (such files aren't split among tasks).  Files without a line are
    left out."""
    types: dict[str, T.DataType] = {}
    if isinstance(schema, T.StructType):
        types = {f.name: f.dataType for f in schema.fields}
    elif schema:
        types = {k: (v if isinstance(v, T.DataType) else T.DataType.fromDDL(v))
                 for k, v in schema.items()}
    tokens = tuple(null_tokens)
    heads = file_heads(spark, paths).filter("line IS NOT NULL")

    def typed(raw: DataFrame, names: list[str], file: Column) -> DataFrame:
        at = {n: f"c{i}" for i, n in reversed(list(enumerate(names)))}  # the first of equal names
        out = []
        for c in columns:
            t = types.get(c, T.StringType())
            src = at.get(c.lower())
            if src is None:
                out.append(F.lit(None).cast(t).alias(c))
                continue
            v = null_if_token(clean_text(F.col(src)), tokens)
            if isinstance(t, T.DateType):
                v = date_guard(v)
            elif not isinstance(t, T.StringType):
                v = v.try_cast(t)
            out.append(v.alias(c))
        return raw.select(*out, *[file.alias("_file")] * with_file)

    def one(line: str, files: list[str], odd: bool) -> DataFrame:
        by = sep or delimiter_of(line)
        names = _fields(line, by)
        # positional names; the header line of each file is dropped by the reader
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        options = {"sep": by, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": str(multi_line).lower()}
        if not odd:
            raw = spark.read.schema(schema).options(**options).option("header", True).option("enforceSchema", True).csv(files)
            return typed(raw, names, F.col("_metadata.file_path"))
        same = misnamed(heads).filter(F.col("line") == line)
        rows = streamed_lines(spark, same, records=multi_line).filter("pos > 0 AND trim(value) <> ''")
        return typed(rows.select("file", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), options).alias("c")).select("file", "c.*"), names, F.col("file"))

    groups = heads.groupBy("line", (F.col("packed") != F.col("named")).alias("odd")).agg(F.collect_list("path").alias("files"))
    frames = [one(g["line"], sorted(g["files"]), g["odd"]) for g in groups.collect()]
    if not frames:
        names = [T.StructField(c, types.get(c, T.StringType())) for c in columns]
        return spark.createDataFrame([], T.StructType(names + [T.StructField("_file", T.StringType())] * with_file))
    return reduce(DataFrame.unionByName, frames)


def read_years(spark: SparkSession, root: str, years: Iterable[int], patterns: Sequence[str],
               columns: Sequence[str], schema=None, sep: str | None = ",") -> DataFrame:
    """Yearly files: for each year the first pattern (``{root}``/``{year}``
    placeholders, a file or a folder) that exists; found years with the same
    header are read in one scan.  Existence comes from one listing of ``root``."""
    from .files import existing_per_key
    found = [p for _, p in existing_per_key(spark, root, years, patterns)]
    if not found:
        raise FileNotFoundError(f"no yearly files under {root}")
    return read_delimited(spark, found, columns, schema, sep)
