"""Sinks: staged full refresh, append, partition replace, CSV/TSV export.

A full refresh never overwrites the data readers use: each load writes a new
version folder, is validated there, and only then is the version recorded as
current (an appended row in ``_versions``; the load log records the same
location).  A failed validation leaves the previous version in place.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = "_versions"
_VERSION_SCHEMA = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])


@dataclass
class WriteResult:
    location: str
    rows: int
    status: str = "success"
    message: str | None = None
    metrics: dict | None = None


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: Sequence[str] = (), extra_metrics: Sequence = (),
                   options: dict | None = None) -> dict:
    """Write ``df`` and return its row count (plus ``extra_metrics``) measured
    during the same job - no second pass over the data."""
    obs = Observation(f"w_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra_metrics)
    w = observed.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return dict(obs.get)


def publish_full_refresh(df: DataFrame, root: str,
                         validate: Callable[..., tuple[str, str | None]] | None = None,
                         partition_by: Sequence[str] = (), extra_metrics: Sequence = ()) -> WriteResult:
    """Write a new version of the table under ``root``, validate it, and
    publish it only when the verdict is not ``failed``.

    ``validate(rows)`` - or ``validate(rows, metrics)`` when ``extra_metrics``
    are given - returns ``(status, message)``; the metrics are counted during
    the write itself, and ``metrics['location']`` names the staged version
    (for checks that read it back before it is published)."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    location = f"{root.rstrip('/')}/v={stamp}-{uuid.uuid4().hex[:8]}"
    metrics = write_observed(df, location, partition_by=partition_by, extra_metrics=extra_metrics)
    rows = int(metrics["rows"])
    if validate is None:
        status, message = "success", None
    elif extra_metrics:
        status, message = validate(rows, {**metrics, "location": location})
    else:
        status, message = validate(rows)
    if status != "failed":
        _record_version(df.sparkSession, root, location, rows)
    return WriteResult(location, rows, status, message, metrics)


def _record_version(spark: SparkSession, root: str, location: str, rows: int) -> None:
    import time
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    from ..operators.loadlog import literal_rows
    row = literal_rows(spark, [{"location": location, "rows": rows, "published_at": now,
                                "seq": time.time_ns()}], _VERSION_SCHEMA)
    row.write.mode("append").parquet(f"{root.rstrip('/')}/{VERSIONS}")


def current_location(spark: SparkSession, root: str) -> str | None:
    try:
        v = spark.read.schema(_VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/{VERSIONS}")
    except AnalysisException as e:
        from ..operators.loadlog import missing
        if not missing(e):
            raise
        return None
    best = v.orderBy(F.col("published_at").desc(), F.col("seq").desc()).select("location").first()
    return best["location"] if best else None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    loc = current_location(spark, root)
    if loc is None:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(loc)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> dict:
    return write_observed(df, path, mode="append", partition_by=partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str] | str = "year") -> dict:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite)."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    return write_observed(df, path, mode="overwrite", partition_by=cols,
                          options={"partitionOverwriteMode": "dynamic"})


def export_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """CSV export without row names (one file per task, header in each); a quote
    inside a value is doubled, a backslash is a character like any other."""
    df.write.mode("overwrite").option("header", header).option("sep", sep).option("escape", '"').csv(path)


def write_tsv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> None:
    """Tab-separated text in the raw-file shape: no quoting, NULL as empty
    field, values written exactly (no trimming), optional header per file."""
    w = (df.select(*[F.col(c) if c in partition_by else F.col(c).cast("string").alias(c)
                     for c in df.columns]).write.mode(mode))
    if partition_by:
        w = w.partitionBy(*partition_by)
    (w
     .option("sep", "\t").option("header", header)
     .option("quote", "").option("escape", "").option("quoteAll", False)
     .option("nullValue", "").option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One string column written as text lines (for raw fixtures)."""
    lines.write.mode(mode).text(path)


def _ident(name: str) -> str:
    """Quote each part of a (possibly qualified) table or column name."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(spark: SparkSession, name: str, location: str,
                   partition_by: Sequence[str] = ()) -> None:
    """Make catalog table ``name`` read the published version at ``location``:
    created on first use, otherwise re-pointed (``ALTER TABLE ... SET
    LOCATION``), so readers switch from one complete version to the next."""
    if not table_exists(spark, name):
        df = spark.read.parquet(location)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        sql = f"CREATE TABLE {_ident(name)} ({ddl}) USING parquet"
        if partition_by:
            sql += " PARTITIONED BY (" + ", ".join(_ident(c) for c in partition_by) + ")"
        spark.sql(sql + f" LOCATION {_literal(location)}")
    else:
        spark.sql(f"ALTER TABLE {_ident(name)} SET LOCATION {_literal(location)}")
    if partition_by:
        spark.sql(f"ALTER TABLE {_ident(name)} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str] | str, buckets: int, location: str,
                   sort: bool = True) -> DataFrame:
    """Write ``df`` as catalog table ``name`` at ``location``, hashed on ``keys`` into ``buckets``.

    Tables bucketed alike on their join keys are joined, grouped and checked for
    repeated keys without an exchange, as often as they are read; the rows move
    once, when they are written (one file a bucket).
    """
    cols = [keys] if isinstance(keys, str) else list(keys)
    w = df.repartition(buckets, *cols).write.format("parquet").mode("overwrite").option("path", location).bucketBy(buckets, *cols)
    (w.sortBy(*cols) if sort else w).saveAsTable(name)
    return df.sparkSession.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                 partition_by: Sequence[str] = ()) -> bool:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet``; True when it was created."""
    if table_exists(spark, name):
        return False
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({ddl}) USING parquet"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(_ident(c) for c in partition_by) + ")"
    if location:
        sql += f" LOCATION {_literal(location)}"
    spark.sql(sql)
    return True
