"""Positional tab-separated text sources (fact, series, dimension files).

The raw files are read with ``spark.read.text`` and split with built-in
expressions, not with the CSV reader: a row with *more* fields than wanted is
cut to the wanted prefix, a row with *fewer* is skipped and counted, there is
no quoting, and every field is trimmed with NULL tokens mapped to NULL.  The
CSV reader's modes treat long and short rows alike, so it cannot express this.

Bad UTF-8 bytes become U+FFFD (lines with one are counted as ``replaced``);
gzip files are known by their first two bytes, whatever their name (``heads``).
Line ends LF, CRLF and CR all split lines.

Functions taking ``lines`` accept any DataFrame with a string ``value``
column, so batch, in-memory and streaming inputs share one parser.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import cast_value
from ..functions.text import DEFAULT_NULL_TOKENS, WHITESPACE, clean_field, clean_text, first_visible, is_blank, kept_here, null_if_token, strip_nul
from .heads import file_heads, misnamed, streamed_lines, without_headers

FACT_COLUMNS = ("series_id", "year", "period", "value", "footnote_codes")
HEADER_PREFIX = "series_id"
LINE = "_line"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str], with_order: bool = False,
               header: Callable[[Column], Column] | None = None, with_file: bool = False) -> DataFrame:
    """Raw lines as ``value``; with ``with_order`` also ``_line``, a struct that
    sorts lines in file order (file path, split start, position in the split);
    with ``with_file`` the path of the line's file as ``_file``.

    ``header`` says of a file's first line (a column) whether it is a header; such
    a line is dropped from its file.  Lines further down are data whatever they
    start with (only an exact repetition of its own file's header is dropped too).
    Gzip is known by a file's first bytes, whatever its name."""
    heads = file_heads(spark, _paths(paths))
    odd = misnamed(heads)
    whole = spark.read.text(_paths(paths))
    extra = []
    if odd.limit(1).count():
        right = [r["path"] for r in heads.filter("packed = named").select("path").collect()]
        whole = spark.read.text(right) if right else whole.filter(F.lit(False))
        extra = [streamed_lines(spark, odd).select("value", "file", F.lit(0).cast("bigint").alias("block"), "pos")]
    plain = whole.select(F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
    rows = reduce(DataFrame.unionAll, extra, plain)
    if header:
        rows = without_headers(rows, heads, header(F.col("line")))
    out = [F.col("value")]
    if with_order:
        out.append(F.struct("file", "block", "pos").alias(LINE))
    if with_file:
        out.append(F.col("file").alias("_file"))
    return rows.select(*out)


def starts_with(prefix: str) -> Callable[[Column], Column]:
    """A header test: the line, without NUL bytes and leading white space, starts with ``prefix``."""
    def test(line: Column) -> Column:
        line = strip_nul(line)
        return F.startswith(F.when(first_visible(line), line).otherwise(F.ltrim(line, F.lit(WHITESPACE))), F.lit(prefix))

    return test


def _flags(lines: DataFrame, n: int, strip_nul_bytes: bool, header_field: str | None,
           keep: Sequence[str] = ()) -> DataFrame:
    """The (NUL-free) line plus ``_real`` (neither blank nor a header line of an
    input without files) and ``_full``, whether it has ``n`` fields (``n - 1`` tabs: it goes on
    where that many fields end)."""
    v = F.col("value")
    if strip_nul_bytes:
        lines = lines.select(kept_here(strip_nul(v)).alias("value"), *keep)
    real = ~is_blank(v)
    if header_field:
        real = real & (clean_text(F.substring_index(v, "\t", 1)) != header_field)
    full = F.substring_index(v, "\t", n - 1) != v if n > 1 else v.isNotNull()
    return lines.select("value", real.alias("_real"), full.alias("_full"), *keep)


def parse_lines(lines: DataFrame, columns: Sequence[str], min_fields: int | None = None,
                null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
                header_field: str | None = None, strip_nul_bytes: bool = True,
                keep: Sequence[str] = (), observation: Observation | None = None) -> DataFrame:
    """Split tab-separated lines into the named positional columns (all strings).

    * blank lines are dropped; header lines are the business of ``read_lines``, which
      knows the files; for lines without files (a stream) ``header_field`` drops those
      whose whole first field is that name;
    * a line with fewer than ``min_fields`` fields (default: ``len(columns)``)
      is skipped - see ``count_skipped`` for the count;
    * extra fields are ignored; a missing optional field (when ``min_fields`` is
      lower than ``len(columns)``) is NULL;
    * each field is trimmed and NULL tokens (``''`` and ``'-'``) become NULL.
    ``keep`` names input columns carried through (e.g. ``_line``).
    With ``observation`` the counts ``kept`` and ``skipped`` (as in
    ``count_skipped``) and ``replaced`` (lines with U+FFFD) are collected while the rows are parsed, no extra pass.

    A line is split once, and only as far as the wanted columns: whether it has
    ``min_fields`` is seen from its tabs.
    """
    n = len(columns) if min_fields is None else min_fields
    tokens = tuple(null_tokens)
    flagged = _flags(lines, n, strip_nul_bytes, header_field, keep)
    if observation is not None:
        real, full = F.col("_real"), F.col("_full")
        flagged = flagged.observe(observation,
                                  F.count_if(real & full).cast("bigint").alias("kept"),
                                  F.count_if(real & ~full).cast("bigint").alias("skipped"),
                                  F.count_if(F.contains("value", F.lit("\ufffd"))).cast("bigint").alias("replaced"))
    ok = flagged.filter(F.col("_real") & F.col("_full"))
    parts = ok.select(kept_here(F.split("value", "\t", len(columns) + 1)).alias("_p"), *keep)
    # a step of its own: else each use of a field in the code that trims it takes it out of the line again, and
    # with a few columns the generated method is too long (8,000 bytes) for the JVM to compile
    fields = parts.select(*[F.try_element_at("_p", F.lit(i + 1)).alias(c) for i, c in enumerate(columns)], *keep)
    trimmed = fields.select(*[clean_text(c).alias(c) for c in columns], *keep)
    return trimmed.select(*[null_if_token(c, tokens).alias(c) for c in columns], *keep)


def count_skipped(lines: DataFrame, columns: Sequence[str] | int, min_fields: int | None = None,
                  header_field: str | None = None,
                  strip_nul_bytes: bool = True) -> DataFrame:
    """One row ``kept, skipped``: lines parsed vs. lines dropped for too few fields.

    Blank and header lines are neither kept nor counted as skipped.
    """
    width = columns if isinstance(columns, int) else len(columns)
    n = width if min_fields is None else min_fields
    flagged = _flags(lines, n, strip_nul_bytes, header_field)
    real, full = F.col("_real"), F.col("_full")
    return flagged.agg(F.count_if(real & full).cast("bigint").alias("kept"),
                       F.count_if(real & ~full).cast("bigint").alias("skipped"))


def read_facts(spark: SparkSession, paths, columns: Sequence[str] = FACT_COLUMNS,
               min_fields: int | None = None, mode: str = "strict",
               observation: Observation | None = None) -> DataFrame:
    """Fact lines -> ``series_id, year int, period, value (text), footnote_codes``.

    ``value`` stays text until the wide table's decimal cast, so no precision is
    lost on the way.  ``year`` is cast here (strict: bad text fails the load).
    """
    df = parse_lines(read_lines(spark, paths, header=starts_with(HEADER_PREFIX)), columns, min_fields,
                     observation=observation)
    if "year" in columns:
        df = df.withColumn("year", cast_value("year", "int", mode, what="year"))
    return df


def read_series(spark: SparkSession, paths, columns: Sequence[str],
                min_fields: int | None = None) -> DataFrame:
    """Series lines -> one row per series with the dataset's positional columns."""
    return parse_lines(read_lines(spark, paths, header=starts_with(HEADER_PREFIX)), columns, min_fields)


def latest_by_line(df: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """Last line wins per ``key``: ``max_by`` over the file order (partial aggregation,
    so a key repeated on a third of all lines still spreads over all tasks)."""
    best = F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.col(LINE)).alias("_v")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def read_series_mapping(spark: SparkSession, paths,
                        columns: Sequence[str] = ("series_id", "area_code", "item_code",
                                                  "seasonal_code"),
                        required: Sequence[str] | None = None, min_fields: int = 3) -> DataFrame:
    """Series -> code mapping: lines need ``min_fields`` fields and non-empty
    required codes (default: the first ``min_fields`` columns); last line wins."""
    required = list(required or columns[:min_fields])
    df = parse_lines(read_lines(spark, paths, with_order=True, header=starts_with(HEADER_PREFIX)), columns,
                     min_fields, null_tokens=("",), keep=(LINE,))
    present = [F.col(c).isNotNull() for c in required]
    df = df.filter(reduce(lambda a, b: a & b, present))
    return latest_by_line(df, columns[0], columns[1:])


def read_dimension(spark: SparkSession, paths, key_col: int = 0, name_col: int = 1,
                   null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Code list -> ``(code, name)``.

    The first line of a file is a header when it contains a tab.  The code is
    field ``key_col`` (rows with an empty code are ignored), the name field
    ``name_col`` (NULL when missing, empty or ``-``); NUL bytes are removed and
    the last line wins for a repeated code.
    """
    lines = read_lines(spark, paths, with_order=True, header=lambda line: F.contains(line, F.lit("\t")))
    lines = lines.withColumn("value", kept_here(strip_nul("value")))
    parts = F.split(F.col("value"), "\t", max(key_col, name_col) + 2)
    # fields, then trimmed ones, as in ``parse_lines``
    fields = lines.filter(~is_blank("value")).select(kept_here(parts).alias("_p"), LINE).select(
        F.try_element_at("_p", F.lit(key_col + 1)).alias("code"), F.try_element_at("_p", F.lit(name_col + 1)).alias("name"), LINE)
    rows = (fields.select(clean_text("code").alias("code"), clean_field("name", null_tokens).alias("name"), LINE)
            .filter(F.col("code").isNotNull() & (F.col("code") != "")))
    return latest_by_line(rows, "code", ["name"])


def read_dimension_table(spark: SparkSession, paths, pk_column: str,
                         columns: Sequence[str] | None = None,
                         null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """A whole code-list table.  A file's first line is its header when it starts
    with ``pk_column``; with ``columns`` the fields are taken by position into
    those names, otherwise the header names them.  Missing trailing fields are NULL."""
    header = starts_with(pk_column)
    if columns is None:
        head = file_heads(spark, _paths(paths)).filter(header(F.col("line"))).orderBy("file").select("line").first()
        if head is None:
            raise ValueError(f"no header line starting with {pk_column!r} and no column list")
        columns = [c.strip() for c in head["line"].replace("\0", "").split("\t")]
    return parse_lines(read_lines(spark, paths, header=header), columns, min_fields=1, null_tokens=null_tokens)


def read_bulk(spark: SparkSession, paths, columns: Sequence[str]) -> DataFrame:
    """A bulk data file: all listed columns, header ``series_id`` dropped."""
    return parse_lines(read_lines(spark, paths, header=starts_with(HEADER_PREFIX)), columns)


def read_parts(spark: SparkSession, root: str, stem: str, header: Callable[[Column], Column] | None = None) -> DataFrame:
    """Lines of a dataset split into numbered parts (``{stem}_data_1``,
    ``{stem}_data_2``, ...), else of the single ``{stem}`` file; all parts are
    read in one scan."""
    base = root.rstrip("/")
    try:
        return read_lines(spark, f"{base}/{stem}_data_[0-9]*", header=header)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    return read_lines(spark, f"{base}/{stem}", header=header)
