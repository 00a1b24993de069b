"""Load one dataset end to end: decide -> read -> denormalize -> stage ->
validate -> publish -> log.

Every step is a Spark job over the whole input; the driver only holds the
decision, a handful of counts and one log row per dataset.
"""

from __future__ import annotations

import traceback
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import year_chunks
from ..operators.loadlog import append_log, empty_log, latest_log, log_rows, read_log, should_reload
from ..operators.quality import has_duplicates, previous_loads, table_rules, verdict_of
from ..session import stored
from ..sinks.writers import publish_full_refresh
from ..sources.text import read_dimension, read_facts, read_series
from .specs import DatasetSpec
from .wide import wide_table


@dataclass
class DatasetPaths:
    """Where the raw files of one dataset are (files, folders or globs)."""
    data: str | Sequence[str]
    series: str | Sequence[str]
    dims: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def in_folder(cls, folder: str, spec: DatasetSpec) -> "DatasetPaths":
        f = folder.rstrip("/")
        return cls(f"{f}/{spec.data_file}", f"{f}/{spec.series_file}",
                   {k: f"{f}/{v}" for k, v in spec.dimension_files.items()})


@dataclass
class LoadResult:
    dataset: str
    status: str                 # success / warning / failed / skipped
    rows: int | None = None
    location: str | None = None
    message: str | None = None
    skipped_lines: int | None = None
    violations: dict | None = None
    chunks: list | None = None      # (chunk_start, chunk_end, chunk_rows, total_rows)


def read_inputs(spark: SparkSession, spec: DatasetSpec, paths: DatasetPaths, mode: str = "strict",
                observation: Observation | None = None):
    dims = {k: read_dimension(spark, p, *spec.dim_columns.get(k, (0, 1)))
            for k, p in paths.dims.items()}
    series = read_series(spark, paths.series, spec.series_columns)
    facts = read_facts(spark, paths.data, spec.fact_columns, mode=mode, observation=observation)
    return facts, series, dims


def stored_lists(spark: SparkSession, dims: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The code lists, read once into one small table, and their row counts."""
    if not dims:
        return {}, {}
    every = reduce(DataFrame.unionByName, [d.select("code", "name", F.lit(k).alias("_dim")) for k, d in dims.items()])
    lists = stored(every, spark, "lists")
    rows = {r["_dim"]: r["count"] for r in lists.groupBy("_dim").count().collect()}
    return {k: lists.filter(F.col("_dim") == k).drop("_dim") for k in dims}, {k: rows.get(k, 0) for k in dims}


def load_dataset(spark: SparkSession, spec: DatasetSpec, paths: DatasetPaths, out_root: str,
                 log_path: str | None = None, heads: DataFrame | None = None, force: bool = False,
                 mode: str = "strict", data_key: str = "all", check_keys: bool = True,
                 count_rule: str = "last_success") -> LoadResult:
    """Load one dataset; the result says ``success``, ``warning`` (published,
    row count dropped), ``failed`` (not published) or ``skipped``.

    Passes over the data: one over the code lists (stored and counted), one over the series file (uniqueness), one staged
    write that also counts parsed/skipped lines and constraint violations,
    and - with ``check_keys`` - one aggregate over the staged key columns.
    In ``strict`` mode a NOT NULL, VARCHAR(n) or PRIMARY KEY violation fails
    the load before it is published (as the target table would reject it);
    ``tolerant`` mode publishes and reports the counts in ``violations``.
    The row count is compared with the load that ``count_rule`` names (see
    ``operators.quality.COUNT_RULES``); ``force`` also accepts any count.
    """
    log = read_log(spark, log_path) if log_path else empty_log(spark)
    head_row = None
    if heads is not None:
        head = heads.filter((F.col("dataset") == spec.key) & (F.col("data_key") == data_key))
        head_row = should_reload(head, log).first()      # the head's columns plus the verdict
        if head_row is not None and not head_row["reload"] and not force:
            return LoadResult(spec.key, "skipped", message="source unchanged")

    def _log(status, rows=None, location=None, message=None):
        if log_path:
            entry = {"dataset": spec.key, "data_key": data_key, "rows_loaded": rows,
                     "status": status, "error_message": message, "location": location}
            if head_row is not None:
                entry.update(etag=head_row["etag"], last_modified=head_row["last_modified"],
                             source_url=head_row["source_url"])
            append_log(log_rows(spark, [entry]), log_path)

    try:
        lines = Observation(f"lines_{spec.key}")
        facts, series, dims = read_inputs(spark, spec, paths, mode, observation=lines)
        # one aggregate gives the series count (join strategy) and the key check
        stats = (series.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("dups")).first())
        if stats["dups"]:
            raise ValueError(f"{spec.key}: duplicate series_id in the series file")
        dims, dim_rows = stored_lists(spark, dims)
        # one file set per year, hot years split by AQE's rebalance; rows
        # sorted by series inside each file so row-group statistics prune
        # series lookups (the reference's indexes); the year prefix is the
        # order the partitioned write needs anyway
        order = ["year", "series_id", "period"] if spec.chunk_years else ["series_id", "year", "period"]

        def place(rows: DataFrame) -> DataFrame:
            if spec.surrogate_id:
                return rows
            rows = rows.hint("rebalance", "year") if spec.chunk_years else rows
            # a sort below a join is dropped as idle (the joins that follow keep the order), unless an
            # expression that isn't deterministic stands between
            here = F.when(F.monotonically_increasing_id() >= 0, F.col("value"))
            return rows.sortWithinPartitions(*order).withColumn("value", here)

        joined, values = Observation(f"join_{spec.key}"), Observation(f"values_{spec.key}")
        wide = wide_table(facts, series, dims, spec, mode=mode,
                          series_rows=int(stats["rows"] or 0), observation=joined,
                          values_observation=values, dim_rows=dim_rows, place=place)
        prev = latest_log(previous_loads(log, count_rule).filter(
            (F.col("dataset") == spec.key) & (F.col("data_key") == data_key)),
            ["dataset", "data_key"]).select("rows_loaded", "status").first()
        prev_rows = prev["rows_loaded"] if prev and not force else None
        rules = table_rules(spec.columns)

        key_checked = False

        def validate(rows: int, metrics: dict):
            nonlocal key_checked
            if lines.get.get("kept", 0) == 0:
                return "failed", f"{spec.key}: empty fact file"
            if mode == "strict":
                # the target's NOT NULL / VARCHAR(n) / PRIMARY KEY reject the load
                bad = {k: metrics[k] for k in rules if metrics[k]}
                if bad:
                    return "failed", f"{spec.key}: constraint violations {bad}"
                if check_keys and spec.primary_key:
                    key_checked = True
                    if has_duplicates(spark.read.parquet(metrics["location"]), list(spec.primary_key)):
                        return "failed", f"{spec.key}: duplicate primary key {spec.primary_key}"
            v = verdict_of(rows, prev_rows, prev["status"] if prev else None)
            msg = None
            if v != "success" and prev_rows:
                msg = f"{rows} rows is {100.0 * rows / prev_rows:.1f}% of the previous {prev_rows}"
            return v, msg

        res = publish_full_refresh(
            wide, f"{out_root.rstrip('/')}/{spec.table}", validate,
            partition_by=("year",) if spec.chunk_years else (),
            extra_metrics=[F.count_if(rule).cast("bigint").alias(name) for name, rule in rules.items()])
        violations = {k: res.metrics[k] for k in rules}
        violations.update(joined.get)
        violations.update(values.get)
        violations["replaced_lines"] = lines.get.get("replaced", 0)
        chunks = None
        if res.status != "failed":
            staged = spark.read.parquet(res.location)
            if (check_keys and spec.primary_key and not key_checked
                    and has_duplicates(staged, list(spec.primary_key))):
                violations["duplicate_keys"] = 1
            if spec.chunk_years and res.rows:
                chunks = [tuple(r) for r in year_chunks(staged.select("year"), spec.chunk_years)
                          .orderBy("chunk_start").collect()]
        if res.status == "failed":
            _log("failed", res.rows, None, res.message)
        else:
            _log("success", res.rows, res.location, res.message)
        return LoadResult(spec.key, res.status, res.rows, res.location, res.message,
                          lines.get.get("skipped"), violations, chunks)
    except Exception as e:  # one dataset's failure does not stop the others
        _log("failed", 0, None, str(e))
        return LoadResult(spec.key, "failed", 0, None, f"{e}\n{traceback.format_exc()}")


def load_all(spark: SparkSession, specs: Sequence[DatasetSpec], folders: Mapping[str, str],
             out_root: str, log_path: str | None = None, workers: int = 1, **kw) -> list[LoadResult]:
    """Load several datasets, each isolated (one failure does not stop the
    others).  With ``workers`` > 1 the datasets' jobs are submitted from that
    many driver threads and run side by side on the cluster (use the FAIR
    scheduler to share it evenly); results keep the order of ``specs``."""
    todo = [s for s in specs if s.key in folders]

    def one(s):
        return load_dataset(spark, s, DatasetPaths.in_folder(folders[s.key], s), out_root, log_path, **kw)

    if workers <= 1:
        return [one(s) for s in todo]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(one, todo))
