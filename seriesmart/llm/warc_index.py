"""Web archives with a two-level capture index.

*Archives.*  Each task writes its pages as WARC records, each a gzip member of
its own, into files of at most ``FILE`` bytes in the shared folder.  Of equal
payloads of ``LEAST`` bytes or more, the page with the largest id is a response
and the others revisit it, without payload.

*Index.*  One pass over the archives reads every record's header and digest.
Captures are sorted by their reversed-host URL key (``com,example,www)/path``)
and page id into range partitions; in each, ``LINES`` captures make a block that
is stored compressed, and a sparse directory has the first key of each block.

*Lookup.*  A key is searched among the partitions' first keys (one small row a
partition), then, by binary search, in its partition's directory and in the one
block that can hold it.  The record is then read by its place alone.

File, offset and length of a record come from the task that wrote it and ended
well, so files of lost or repeated attempts are never referred to.  Tasks reach
the shared folder by its URI through pyarrow's file systems.

Defined results: a null html is an empty payload; a null url has an empty key; a
null id sorts first, has no id in its header and is never one that others
revisit unless no copy has an id; rows that repeat the largest id of a payload
are all responses; an empty table gives no archives and an empty result;
further columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlsplit
from uuid import uuid4

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .graph import stored

LEAST, FILE, LINES = 1000, 1 << 30, 2048
DATE = "1970-01-01T00:00:00Z"


# --- keys and records -----------------------------------------------------------------------

def url_key(url: str | None) -> str:
    """Reversed host in lower case, port if it isn't the usual one, then the rest of the URL."""
    if not url:
        return ""
    url = _field(url).replace("\t", "%09")
    try:
        p = urlsplit(url.strip())
        host, port = (p.hostname or "").rstrip("."), p.port
    except ValueError:
        return url
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){p.path or '/'}" + (f"?{p.query}" if p.query else "") + (f"#{p.fragment}" if p.fragment else "")


def _field(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid4()}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one gzip member."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pa.fs.LocalFileSystem(), uri)


# --- archives -------------------------------------------------------------------------------

def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages ``(page_id, url, html)`` as records; ``(page_id, url_key, file, offset, length)`` of each.

    The result must be stored before it is used: computing it writes the files.
    """
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= LEAST
    first = plain.filter(large).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first")).filter("n > 1").select("digest", "first")
    paired = plain.join(first, "digest", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size = None, "", 0
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        try:
            for batch in batches:
                made = []
                for page_id, url, html, digest, first in zip(*(batch.column(c).to_pylist() for c in range(5))):
                    if out is None or size >= FILE:
                        if out is not None:
                            out.close()
                        path, size = f"{uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{base}/{path}", compression=None)
                    kind = "response" if first is None or page_id == first else "revisit"
                    data = record(page_id, url, html.encode(), digest, kind, first)
                    out.write(data)
                    made.append((page_id, url_key(url), f"{folder}/{path}", size, len(data)))
                    size += len(data)
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _PLACE)], names=_PLACE_NAMES)
        finally:
            if out is not None:
                out.close()

    return paired.select("page_id", "url", "html", "digest", "first").mapInArrow(run, _PLACE_DDL)


_PLACE_NAMES = ["page_id", "url_key", "file", "offset", "length"]
_PLACE = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_PLACE_DDL = "page_id long, url_key string, file string, offset long, length long"


# --- index ----------------------------------------------------------------------------------

class Index(NamedTuple):
    #: (part, block, first_key, first_id, data): blocks of sorted captures, compressed.
    blocks: DataFrame
    #: (first_key, first_id, part) of each partition, in order.
    top: list[tuple[str, int, int]]


def _line(key: str, page_id: int, file: str, offset: int, length: int) -> str:
    return "\t".join((key, str(page_id), file, str(offset), str(length)))


#: Captures of a partition of the index, on average: what a task looks up keys in.
CAPTURES = 20_000
#: Stands for a null id: it sorts first.
NO_ID = -(1 << 63)


def index(places: DataFrame, spark: SparkSession) -> Index:
    """The two-level index of records at ``places``."""
    keyed = places.select("url_key", F.coalesce("page_id", F.lit(NO_ID)).alias("page_id"), "file", "offset", "length")
    n = 1 + places.count() // CAPTURES
    ordered = keyed.repartitionByRange(n, "url_key", "page_id", "file", "offset").sortWithinPartitions("url_key", "page_id", "file", "offset")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def block(rows: list) -> pd.DataFrame:
            data = zlib.compress("\n".join(_line(*r) for r in rows).encode(), 6)
            return pd.DataFrame([(n, rows[0][0], rows[0][1], data)], columns=["block", "first_key", "first_id", "data"])

        for batch in batches:
            held += batch.itertuples(index=False, name=None)
            while len(held) >= LINES:
                yield block(held[:LINES])
                held, n = held[LINES:], n + 1
        if held:
            yield block(held)

    made = ordered.mapInPandas(run, "block long, first_key string, first_id long, data binary")
    blocks = stored(made.select(F.spark_partition_id().alias("part"), "*"), spark, "blocks")
    # One row a partition of the index, whatever the number of captures.
    top = blocks.filter("block = 0").select("first_key", "first_id", "part").collect()
    return Index(blocks, sorted((r.first_key, r.first_id, r.part) for r in top))


def lookup(keys: DataFrame, idx: Index) -> DataFrame:
    """``(file, offset, length)`` of every record that the keys ``(url_key, page_id)`` have.

    Keys that occur in several rows are looked up once; so are their records.
    """
    starts, parts = [t[:2] for t in idx.top], [t[2] for t in idx.top]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, page_id in batch.itertuples(index=False, name=None):
                # The records of one key may go on in the partitions after.
                at = bisect_right(starts, (key, page_id)) - 1
                low = at
                while low > 0 and starts[low] == (key, page_id):
                    low -= 1
                out += [(parts[i], key, page_id) for i in range(max(low, 0), at + 1)]
            yield pd.DataFrame(out, columns=["part", "url_key", "page_id"])

    asked = (keys.select("url_key", F.coalesce("page_id", F.lit(NO_ID)).alias("page_id")).distinct()
             .mapInPandas(route, "part int, url_key string, page_id long"))

    def search(blocks: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        directory = list(zip(blocks["first_key"], blocks["first_id"]))
        data, at, lines, held, found = blocks["data"].tolist(), -1, [], [], []
        for want in sorted(zip(wanted["url_key"], wanted["page_id"])):
            b = max(bisect_right(directory, want) - 1, 0)
            while b > 0 and directory[b] == want:
                b -= 1
            while b < len(data) and directory[b] <= want:
                if b != at:
                    at, lines = b, [x.split("\t") for x in zlib.decompress(data[b]).decode().split("\n")]
                    held = [(x[0], int(x[1])) for x in lines]
                i = bisect_right(held, want) - 1
                while i >= 0 and held[i] == want:
                    found.append((lines[i][2], int(lines[i][3]), int(lines[i][4])))
                    i -= 1
                b += 1
        return pd.DataFrame(found, columns=["file", "offset", "length"])

    return idx.blocks.groupBy("part").cogroup(asked.groupBy("part")).applyInPandas(search, "file string, offset long, length long")


def read(places: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at ``(file, offset, length)``, by range reads in order of place.

    Every payload is read and held against its digest; without ``payloads`` it is
    not handed on (null), only its length.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, source = None, None
        for batch in batches:
            out = []
            for file, offset, length in batch.itertuples(index=False, name=None):
                if file != name:
                    if source is not None:
                        source.close()
                    fs, path = _open(file)
                    name, source = file, fs.open_input_file(path)
                fields, payload = parse(source.read_at(length, offset))
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise OSError(f"a record of {file} at {offset} doesn't have its digest")
                ids = [int(fields[f]) if fields.get(f, "None") != "None" else None for f in ("X-Page-ID", "X-Refers-To-Page-ID")]
                out.append((ids[0], fields.get("WARC-Target-URI"), payload if payloads and kind == "response" else None,
                            len(payload) if kind == "response" else None, digest, kind, ids[1]))
            yield pd.DataFrame(out, columns=_READ).astype({"page_id": "Int64", "n": "Int64", "refers_to": "Int64"})
        if source is not None:
            source.close()

    ordered = places.select("file", "offset", "length").repartition("file", (F.col("offset") / (8 << 20)).cast("long")).sortWithinPartitions("file", "offset")
    return ordered.mapInPandas(run, "page_id long, url string, payload binary, n long, digest string, kind string, refers_to long")


_READ = ["page_id", "url", "payload", "n", "digest", "kind", "refers_to"]


def archive(pages: DataFrame, spark: SparkSession) -> tuple[DataFrame, Index]:
    """Write the pages; where the records are, and their index."""
    places = stored(write(pages, scratch_path(spark, "warc")), spark, "places")
    return places, index(places, spark)
