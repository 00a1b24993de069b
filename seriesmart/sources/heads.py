"""What a reader must know of files before it scans them: first line and codec.

``file_heads`` is one distributed job over the file listing, whatever the number
of files: a task opens its files by their URI, reads the first bytes (more only
if the first line is longer), and looks at the first two for gzip.  Its rows stay
a table; readers join it, so plans hold no literal per file and the driver no line.

Files whose codec is not what their name says (gzip without ``.gz``, or the
other way round) can't be given to Spark's own readers, which go by the name;
``streamed_lines`` reads those, a file a task (gzip can't be split anyway), in
blocks of bounded size.

File systems that can't be opened by URI here: the first lines come from one
scan with Spark's reader, and the codec from the name.
"""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

#: Bytes read at once.
BLOCK = 1 << 16
#: Headers of files that are broadcast at most; beyond it, header-like lines are joined by a shuffle.
BROADCAST_FILES = 100_000
GZIP = b"\x1f\x8b"
BOM = b"\xef\xbb\xbf"


def listing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, file, length)`` of the files that Spark's readers would read, no content; ``file`` as rows name it."""
    found = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return found.select("path", F.col("_metadata.file_path").alias("file"), "length")


def open_stream(path: str):
    """A byte stream of a file by its path or URI; None where its file system isn't known here."""
    from pyarrow import fs
    local = re.fullmatch(r"(?:file:(?://)?)?(/.*)", path)
    if local:
        return fs.LocalFileSystem().open_input_stream(local.group(1), compression=None)
    try:
        system, name = fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError):
        return None
    return system.open_input_stream(name, compression=None)


def first_line(stream, block: int = BLOCK) -> tuple[bool, bytes | None]:
    """(whether a stream is gzip, its first line without line end and byte order mark); None for an empty one."""
    data = stream.read(block)
    packed = data[:2] == GZIP
    inflate = zlib.decompressobj(wbits=31) if packed else None
    held, got = [], data
    while got:
        held.append(inflate.decompress(got) if packed else got)
        end = re.search(rb"[\r\n]", held[-1])
        if end:
            held[-1] = held[-1][:end.start()]
            break
        got = inflate.unused_data if packed and inflate.eof else b""
        if got:
            inflate = zlib.decompressobj(wbits=31)  # the next member of the same file
        else:
            got = stream.read(block)
    else:
        if not any(held):
            return packed, None
    return packed, b"".join(held).removeprefix(BOM)


def _opened(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stream = open_stream(path)
                packed, line = None, None
                if stream is not None:
                    with stream:
                        packed, line = first_line(stream)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([file]), pa.array([packed], pa.bool_()), pa.array([line], pa.binary())],
                                                 ["path", "file", "packed", "line"])

    read = listing(spark, paths).select("path", "file").mapInArrow(run, "path string, file string, packed boolean, line binary")
    return stored(read.select("path", "file", "packed", F.endswith("path", F.lit(".gz")).alias("named"),
                              F.make_valid_utf8(F.col("line").cast("string")).alias("line")), spark, "heads")


def file_heads(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, file, packed, named, line)`` of every file: gzip by its bytes, by its name, its first line (null: empty)."""
    heads = _opened(spark, paths)
    if not heads.filter("packed IS NULL").limit(1).count():
        return heads
    rows = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("line"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    lines = rows.groupBy("file").agg(F.min_by("line", "at").alias("line"))
    return heads.select("path", "file", F.col("named").alias("packed"), "named").join(lines, "file", "left")


def misnamed(heads: DataFrame) -> DataFrame:
    """The files whose codec isn't what their name says."""
    return heads.filter("packed <> named")


def lines_in(stream, packed: bool, block: int = 1 << 20) -> Iterator[bytes]:
    """The lines of a stream: LF, CRLF and CR end one; no byte order mark."""
    data = gzip.GzipFile(fileobj=stream) if packed else stream
    held, start, half = [], True, False
    while got := data.read(block):
        if start:
            got, start = got.removeprefix(BOM), False
        if half:
            got = got.removeprefix(b"\n")
        half = got.endswith(b"\r")
        *whole, last = re.split(rb"\r\n|\n|\r", got)
        if whole:
            yield b"".join([*held, whole[0]])
            yield from whole[1:]
            held = []
        held.append(last)
    if rest := b"".join(held):
        yield rest


def streamed_lines(spark: SparkSession, files: DataFrame, records: bool = False) -> DataFrame:
    """``(value, file, pos)`` of the lines of ``files (path, file, packed)``, each file by its own codec.

    With ``records`` a line whose quotes are open goes on in the next one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, file, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held, at, size = [], 0, 0
                with open_stream(path) as stream:
                    lines = lines_in(stream, packed)
                    for line in _records(lines) if records else lines:
                        held.append(line)
                        size += len(line)
                        if size >= 1 << 22 or len(held) >= 20_000:
                            yield _batch(held, file, at)
                            held, at, size = [], at + len(held), 0
                yield _batch(held, file, at)

    n = max(1, min(files.count(), 10_000))
    got = files.select("path", "file", "packed").repartition(n, "path").mapInArrow(run, "value binary, file string, pos long")
    return got.select(F.make_valid_utf8(F.col("value").cast("string")).alias("value"), "file", "pos")


def _batch(lines: list[bytes], file: str, at: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array([file] * len(lines), pa.string()),
                                       pa.array(range(at, at + len(lines)), pa.int64())], ["value", "file", "pos"])


def _records(lines: Iterator[bytes]) -> Iterator[bytes]:
    held = b""
    for line in lines:
        held = held + b"\n" + line if held else line
        if held.count(b'"') % 2 == 0:
            yield held
            held = b""
    if held:
        yield held


def without_headers(rows: DataFrame, heads: DataFrame, is_header: Column | None) -> DataFrame:
    """The rows ``(value, file, ..)`` without the first line of each file that is a header.

    ``is_header`` is a condition on a column ``line`` (None: every first line
    is one).  The files' headers are a small table that is joined by file and
    line; only lines that look like a header are looked up.
    """
    like = F.lit(True) if is_header is None else is_header
    own = heads.filter("line IS NOT NULL").filter(like).select(F.col("file").alias("_file"), F.col("line").alias("_head"))
    rows = rows.withColumn("line", F.col("value")).withColumn("_like", like).drop("line")
    same = (F.when(F.col("_like"), F.col("value")) == F.col("_head")) & (F.col("file") == F.col("_file"))
    if own.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES:
        data = rows.join(F.broadcast(own), same, "left_anti")
    else:  # two scans: only lines that look like a header are shuffled
        data = rows.filter("NOT _like").union(rows.filter("_like").join(own.hint("merge"), same, "left_anti"))
    # What is made of a value later, casts that may fail among it, must not be pushed down to where headers
    # still are: an expression that isn't deterministic stays where it is.
    here = F.when(F.monotonically_increasing_id() >= 0, F.col("value"))
    return data.drop("_like").withColumn("value", here)
