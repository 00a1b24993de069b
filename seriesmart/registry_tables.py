"""Registered queries of the tables' upkeep: codecs, partitions, revised files,
the compacted log, bucketed tables."""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import append_log, check_unique, compact_log, latest_log, longer_than, read_log, run_errors
from .registry_loads import _event_log, table
from .session import scratch_path
from .sinks import create_table, publish_partitions, read_partitions, table_exists, write_bucketed, write_tsv
from .sources import read_series
from .streaming import ingest_revised, read_ingested

#: Lines of a landed file at most.
FILE_LINES = 1_000_000

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        ORACLE_SQL[fn.__name__] = sql
        return fn
    return add


def _write_files(lines: DataFrame, path: str, header: str, files: int) -> None:
    """The files of ``lines (name, packed, line)`` under ``path``, each with the header first: files whose names
    say nothing of their codec.  A null line is none (its file is there all the same).

    A file's lines come to one task of about ``files``, in blocks that are written as they come."""
    from pyarrow import compute, fs

    def opened(name: str, packed: bool, held: ExitStack):
        local = re.fullmatch(r"(?:file:(?://)?)?(/.*)", f"{path}/{name}")
        system, at = (fs.LocalFileSystem(), local.group(1)) if local else fs.FileSystem.from_uri(f"{path}/{name}")
        system.create_dir(at.rsplit("/", 1)[0])
        out = held.enter_context(system.open_output_stream(at, compression=None))
        if packed:
            out = held.enter_context(gzip.GzipFile(fileobj=out, mode="wb"))
        out.write(f"{header}\n".encode())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, None
        with ExitStack() as held:
            for batch in batches:
                runs, start = compute.run_end_encode(batch.column(0)), 0
                for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    if name != now:
                        held.close()
                        now, out = name, opened(name, batch.column(1)[start].as_py(), held)
                    some = batch.column(2).slice(start, end - start).drop_null().to_pylist()
                    out.write(b"".join(line + b"\n" for line in some))
                    start = end
                yield batch.select([0]).slice(0, 0)

    rows = lines.select("name", "packed", F.col("line").cast("binary").alias("line")).repartition(files, "name").sortWithinPartitions("name")
    rows.mapInArrow(run, "name string").write.format("noop").mode("overwrite").save()


@query("SELECT CAST(o_orderkey AS STRING) AS series_id, CAST(o_custkey AS STRING) AS v, o_orderstatus AS status FROM orders")
def gzip_by_magic(spark, sf):
    """Orders in files of a customer group each: gzip without .gz, plain text, plain text named .gz, gzip named .gz."""
    path = scratch_path(spark, "magic")
    o = table(spark, sf, "orders")
    g = F.coalesce(F.pmod("o_custkey", F.lit(64)), F.lit(0))
    name = F.concat(F.lit("part"), g.cast("string"), F.when(g % 4 >= 2, ".gz").otherwise(".txt"))
    lines = o.select(name.alias("name"), (g % 2 == 1).alias("packed"), F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus").alias("line"))
    _write_files(lines, path, "series_id\tv\tstatus", 64)
    return read_series(spark, path, ["series_id", "v", "status"])


@query("""SELECT CAST(year(o_orderdate) AS STRING) AS part, o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
          WHERE year(o_orderdate) <> 1995 OR o_orderpriority <> '5-LOW' GROUP BY 1, 2""")
def partition_validated(spark, sf):
    """Orders by year; then a year loses a fifth of its rows (published with a warning), another most of
    them and a third gets a value that is too long (both refused)."""
    root = scratch_path(spark, "validated")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("yr"))
    publish_partitions(o, root, "yr")
    revised = o.filter("yr = 1995 AND o_orderpriority <> '5-LOW' OR yr = 1996 AND o_orderstatus = 'P' OR yr = 1997")
    long = F.when((F.col("yr") == 1997) & (F.col("o_orderstatus") == "P"), F.lit("P?")).otherwise(F.col("o_orderstatus"))
    publish_partitions(revised.withColumn("o_orderstatus", long), root, "yr", rules={"status": longer_than("o_orderstatus", 1)})
    now = read_partitions(spark, root)
    return now.groupBy(F.col("yr").cast("string").alias("part"), "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("""SELECT CAST(o_orderkey AS STRING) AS series_id, CASE WHEN o_orderstatus = 'P' THEN 'revised' ELSE o_orderpriority END AS v
          FROM orders WHERE o_orderstatus <> 'O'""")
def stream_revised_files(spark, sf):
    """Landed files of orders, one a status (more where it has over ``FILE_LINES`` orders): three at the least; then a
    status' files are revised under their names, another's come to hold nothing, the third's stay."""
    landing, out = scratch_path(spark, "revised"), scratch_path(spark, "revised_out")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("series_id"), F.col("o_orderpriority").alias("v"), "o_orderstatus")
    counts = {r["o_orderstatus"]: r["count"] for r in o.filter(F.col("o_orderstatus").isin(*"FOP")).groupBy("o_orderstatus").count().collect()}
    files = {status: max(1, -(-counts.get(status, 0) // FILE_LINES)) for status in "FOP"}

    def land(status: str, rows: DataFrame) -> None:
        # dealt in turn, whatever the keys; a row without a line for each file, as it may get no other
        place = lambda i: F.concat(F.lit(f"{status}-"), (i % files[status]).cast("string"), F.lit(".txt")).alias("name")
        lines = rows.select(place(F.monotonically_increasing_id()), F.concat_ws("\t", "series_id", "v").alias("line"))
        every = spark.range(files[status]).select(place(F.col("id")), F.lit(None).cast("string").alias("line"))
        _write_files(every.union(lines).withColumn("packed", F.lit(False)), landing, "series_id\tv", files[status])

    for status in "FOP":
        land(status, o.filter(F.col("o_orderstatus") == status))
    first = ingest_revised(spark, landing, ["series_id", "v"], out)
    none = ingest_revised(spark, landing, ["series_id", "v"], out)
    land("P", o.filter("o_orderstatus = 'P'").withColumn("v", F.lit("revised")))
    land("O", o.filter("false"))
    again = ingest_revised(spark, landing, ["series_id", "v"], out)
    if (first, none, again) != (sum(files.values()), 0, files["O"] + files["P"]):
        raise RuntimeError(f"files taken: {first}, {none}, {again}")
    return read_ingested(spark, out)


@query("""SELECT CAST(user_id AS STRING) AS dataset, CASE WHEN event_type <> 'view' THEN event_type ELSE '' END AS etag, event_id AS seq,
                 CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status
          FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def log_compacted(spark, sf):
    """Events appended to a log in four parts, compacted after the second and the third."""
    path = scratch_path(spark, "compacted")
    log = _event_log(table(spark, sf, "events"))
    for i in range(4):
        append_log(log.filter(F.pmod("seq", F.lit(4)) == i), path)
        if i in (1, 2):
            compact_log(spark, path)
    return latest_log(read_log(spark, path)).select("dataset", "etag", "seq", "status")


@query("""SELECT CAST(user_id AS STRING) AS dataset, 'all' AS data_key, 'unknown error' AS error_message, ts AS load_timestamp FROM events WHERE event_type = 'error'""")
def run_error_list(spark, sf):
    """The error list of the events' log."""
    return run_errors(_event_log(table(spark, sf, "events")))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def pk_duplicates_bucketed(spark, sf):
    """Repeated keys of a table that is bucketed by the order: checked without an exchange."""
    t = write_bucketed(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), _name("lines"), "l_orderkey", 8, scratch_path(spark, "bucketed"))
    return check_unique(t, ["l_orderkey", "l_linenumber"])


@query("""SELECT o_orderstatus, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus""")
def bucketed_join(spark, sf):
    """Lines and orders, both bucketed by the order: joined without an exchange of either."""
    li = write_bucketed(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), _name("lines"), "l_orderkey", 8, scratch_path(spark, "bucketed"))
    o = write_bucketed(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), _name("orders"), "o_orderkey", 8, scratch_path(spark, "bucketed"))
    both = li.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("parts"))


def _name(what: str) -> str:
    return f"seriesmart_{what}_{uuid.uuid4().hex}"


@query("""SELECT c_nationkey, count(*) AS n, true AS created, false AS created_again, true AS known, false AS unknown FROM customer GROUP BY c_nationkey""")
def table_created(spark, sf):
    """A table made once, asked for, and filled with customers."""
    name = _name("customers")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.LongType())])
    made, again = (create_table(spark, name, schema, scratch_path(spark, "created")) for _ in range(2))
    table(spark, sf, "customer").select(F.col("c_custkey").cast("long"), F.col("c_nationkey").cast("long")).write.insertInto(name)
    known, unknown = table_exists(spark, name), table_exists(spark, name + "_not")
    return spark.table(name).groupBy("c_nationkey").agg(F.count("*").alias("n")).select(
        "c_nationkey", "n", *[F.lit(x).alias(k) for k, x in (("created", made), ("created_again", again), ("known", known), ("unknown", unknown))])
