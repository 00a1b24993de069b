"""The load log: an append-only table of load outcomes and the decisions on it.

Every load appends one row per ``(dataset, data_key)``; the current state of a
key is its latest row (``load_timestamp``, then ``seq``).  Appending instead of
updating in place keeps history, needs no MERGE-capable table format, and
lets validation compare against the last *successful* load.

All decisions are set-wise: a DataFrame of candidates in (``source_heads``:
``dataset, data_key, etag, last_modified, source_url``), a verdict column out.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import bounded_broadcast
from .latest import latest_per_key, top_k

KEYS = ("dataset", "data_key")
ORDER = ("load_timestamp", "seq")

LOG_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("load_timestamp", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("location", T.StringType()),
])

HEADS_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("source_url", T.StringType()),
])


def literal_rows(spark: SparkSession, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """A few rows built from literals (no Python worker involved); an empty
    frame of ``schema`` when ``rows`` is empty."""
    frames = [spark.range(1).select(*[F.lit(r.get(f.name)).cast(f.dataType).alias(f.name)
                                      for f in schema.fields]) for r in rows]
    if not frames:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def empty_log(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, [], LOG_SCHEMA)


# appends of several loads into one log folder must not overlap (each write
# commits through the folder's temporary directory)
_LOCK = threading.Lock()


def missing(e: AnalysisException) -> bool:
    """Whether the error says that a path does not exist."""
    return (e.getCondition() or "") == "PATH_NOT_FOUND"


#: Compacted logs: pointer rows and the folders of each generation, which plain readers of the folder pass over.
POINTER, GENERATION = "_generations", "_generation"


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not missing(e):
            raise
        return None


def generation(spark: SparkSession, path: str) -> int:
    """The log's generation: 0 until it is compacted."""
    pointer = _read(spark, f"{path.rstrip('/')}/{POINTER}", "generation int")
    return 0 if pointer is None else pointer.agg(F.max("generation")).first()[0] or 0


def _folders(path: str, g: int) -> tuple[str | None, str]:
    """Snapshot and tail of a generation."""
    base = path.rstrip("/")
    return (f"{base}/{GENERATION}/{g}/snapshot", f"{base}/{GENERATION}/{g}/tail") if g else (None, base)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log at ``path`` (the snapshot of its generation and what was appended
    since); empty where there is none yet.  Writes nothing."""
    parts = [_read(spark, p, LOG_SCHEMA) for p in _folders(path, generation(spark, path)) if p]
    parts = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else empty_log(spark)


def compact_log(spark: SparkSession, path: str, keep_all: bool = False) -> int:
    """Put the log's files together into the snapshot of a new generation.

    The snapshot keeps of each key the latest row and the latest successful one,
    which is all that decisions and validations look at; with ``keep_all``, every
    row.  Readers go over to it with the pointer's row, written last; appends go
    to the new generation's own folder, so a log has the files of one snapshot
    and of the appends since.  Appends of this process wait meanwhile; those of
    other processes must not run at the same time.  Returns the generation.
    """
    with _LOCK:
        log = read_log(spark, path)
        if not keep_all:
            last = latest_per_key(log, KEYS, ORDER)
            good = latest_per_key(log.filter("status = 'success'"), KEYS, ORDER)
            log = last.unionByName(good).distinct()
        g = generation(spark, path) + 1
        log.select(*LOG_SCHEMA.fieldNames()).hint("rebalance").write.mode("overwrite").parquet(_folders(path, g)[0])
        literal_rows(spark, [{"generation": g}], T.StructType([T.StructField("generation", T.IntegerType())])).write.mode("append").parquet(f"{path.rstrip('/')}/{POINTER}")
        return g


def log_rows(spark: SparkSession, entries: Sequence[dict]) -> DataFrame:
    """Log rows from a few Python dicts (one per dataset of a run)."""
    import datetime as _dt
    import time as _time
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    base = _time.time_ns()
    rows = []
    for i, e in enumerate(entries):
        r = {f.name: e.get(f.name) for f in LOG_SCHEMA.fields}
        r["load_timestamp"] = r["load_timestamp"] or now
        r["seq"] = r["seq"] if r["seq"] is not None else base + i
        r["status"] = r["status"] or "success"
        rows.append(r)
    return literal_rows(spark, rows, LOG_SCHEMA)


def append_log(entries: DataFrame, path: str) -> None:
    with _LOCK:
        tail = _folders(path, generation(entries.sparkSession, path))[1]
        entries.select(*LOG_SCHEMA.fieldNames()).write.mode("append").parquet(tail)


def latest_log(log: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """Current state per key (what an upsert keyed on ``keys`` would leave)."""
    return latest_per_key(log, keys, order)


def shown_etag() -> Column:
    """The etag as it is displayed: ``N/A`` when missing."""
    return F.coalesce(F.nullif(F.col("etag"), F.lit("")), F.lit("N/A"))


def recent_log(log: DataFrame, n: int = 10, order: Sequence[str] = ORDER) -> DataFrame:
    """The ``n`` newest log rows, newest first; ``etag`` shown as ``N/A`` when missing."""
    shown = log
    if "etag" in log.columns:
        shown = log.withColumn("etag", shown_etag())
    return top_k(shown, n, order)


def full_log(log: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    return log.orderBy(*[F.col(c).desc() for c in order])


def run_summary(log: DataFrame, status_col: str = "status", count_col: str = "n") -> DataFrame:
    """Number of log rows per outcome; ``run_errors`` has the texts."""
    return log.groupBy(status_col).agg(F.count(F.lit(1)).alias(count_col))


def run_errors(log: DataFrame, since=None) -> DataFrame:
    """The error list of a run: ``(dataset, data_key, error_message, load_timestamp)`` of every failed
    load (from ``since`` on), a row each - rows rather than one value, which would grow with the run."""
    failed = log.filter(F.col("status") == "failed")
    if since is not None:
        failed = failed.filter(F.col("load_timestamp") >= F.lit(since))
    return failed.select("dataset", "data_key", F.coalesce("error_message", F.lit("unknown error")).alias("error_message"), "load_timestamp")


def _decide(heads: DataFrame, log: DataFrame, keys: Sequence[str], rule,
            order: Sequence[str] = ORDER) -> DataFrame:
    cur = latest_log(log, keys, order).select(*keys, F.lit(True).alias("_known"),
                                       F.col("etag").alias("_log_etag"),
                                       F.col("status").alias("_log_status"))
    j = heads.join(cur, list(keys), "left")
    return j.select(*heads.columns, rule(F.col("etag"), F.col("_known").isNull(),
                                         F.col("_log_status"), F.col("_log_etag")))


def reload_rule(etag: Column, absent: Column, status: Column, log_etag: Column) -> Column:
    """No log row -> reload; last load failed -> reload; no etag now -> keep
    (a flaky source must not force a reload); else reload when the etag changed."""
    no_etag = etag.isNull() | (etag == "")
    return (F.when(absent, F.lit(True))
            .when(status == "failed", F.lit(True))
            .when(no_etag, F.lit(False))
            .otherwise(~log_etag.eqNullSafe(etag))).alias("reload")


def download_rule(etag: Column, absent: Column, status: Column, log_etag: Column) -> Column:
    """Older rule: no etag now -> download first; then as ``reload_rule``."""
    no_etag = etag.isNull() | (etag == "")
    return (F.when(no_etag, F.lit(True))
            .when(absent, F.lit(True))
            .when(status == "failed", F.lit(True))
            .otherwise(~log_etag.eqNullSafe(etag))).alias("download")


def should_reload(heads: DataFrame, log: DataFrame, keys: Sequence[str] = KEYS,
                  order: Sequence[str] = ORDER) -> DataFrame:
    """``heads`` plus a boolean ``reload`` per key (see ``reload_rule``)."""
    return _decide(heads, log, keys, reload_rule, order)


def should_download(heads: DataFrame, log: DataFrame, keys: Sequence[str] = KEYS,
                    order: Sequence[str] = ORDER) -> DataFrame:
    """``heads`` plus a boolean ``download`` per key (see ``download_rule``)."""
    return _decide(heads, log, keys, download_rule, order)


def already_loaded(datasets: DataFrame, log: DataFrame, force: bool = False,
                   data_key: str = "all") -> DataFrame:
    """Per dataset: skip the load when its ``data_key`` entry (``all``) says success."""
    cur = latest_log(log.filter(F.col("data_key") == data_key), ["dataset"])
    ok = cur.select("dataset", (F.col("status") == "success").alias("_ok"))
    j = datasets.join(bounded_broadcast(ok), "dataset", "left")
    skip = F.lit(False) if force else F.coalesce(F.col("_ok"), F.lit(False))
    return j.select(*datasets.columns, skip.alias("skip"))


def stale_success(log: DataFrame, max_age: str, keys: Sequence[str] = KEYS,
                  now: Column | None = None, ts_col: str = "load_timestamp",
                  ok: Column | None = None) -> DataFrame:
    """Keys whose last successful load is older than ``now - max_age``
    (``max_age`` an interval text such as ``'2 days'``).  ``now`` defaults to
    the current time; keys that never succeeded give ``last_ok`` NULL and are
    not reported here (they show up as failed)."""
    import re
    if not re.fullmatch(r"\s*\d+\s+(second|minute|hour|day|week)s?\s*", max_age, re.IGNORECASE):
        raise ValueError(f"max_age must look like '2 days', not {max_age!r}")
    ok = (F.col("status") == "success") if ok is None else ok
    last = log.groupBy(*keys).agg(F.max(F.when(ok, F.col(ts_col))).alias("last_ok"))
    now = F.current_timestamp() if now is None else now
    return last.filter(F.col("last_ok") < now - F.expr(f"INTERVAL {max_age}"))


def failed_loads(log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys whose current state is failed."""
    return latest_log(log, keys).filter(F.col("status") == "failed")


def alerts(log: DataFrame, max_age: str = "2 days", deviation: float = 0.1,
           keys: Sequence[str] = KEYS, now: Column | None = None) -> DataFrame:
    """All alerts of the log as rows ``keys..., alert, detail``:

    * ``failed``: the key's current state is a failed load;
    * ``stale``: no successful load within ``max_age`` of ``now``;
    * ``row_deviation``: the last successful load's row count differs from
      the one before it by more than ``deviation`` of it.
    """
    keys = list(keys)
    failed = failed_loads(log, keys).select(*keys, F.lit("failed").alias("alert"),
                                            F.col("error_message").alias("detail"))
    stale = stale_success(log, max_age, keys, now).select(
        *keys, F.lit("stale").alias("alert"), F.col("last_ok").cast("string").alias("detail"))
    ok = log.filter(F.col("status") == "success")
    last = latest_per_key(ok, keys, ORDER, ["rows_loaded", *ORDER]).select(
        *keys, F.col("rows_loaded").alias("_new"), F.struct(*ORDER).alias("_at"))
    earlier = (ok.join(bounded_broadcast(last), keys)
               .filter(F.struct(*ORDER) < F.col("_at")))
    prev = earlier.groupBy(*keys).agg(F.max_by("rows_loaded", F.struct(*ORDER)).alias("_prev"),
                                      F.first("_new").alias("_new"))
    moved = prev.filter((F.col("_prev") > 0)
                        & (F.abs(F.col("_new") - F.col("_prev")) > F.lit(deviation) * F.col("_prev")))
    dev = moved.select(*keys, F.lit("row_deviation").alias("alert"),
                       F.concat(F.col("_prev").cast("string"), F.lit(" -> "),
                                F.col("_new").cast("string")).alias("detail"))
    return failed.unionByName(stale).unionByName(dev)
