"""The two other load shapes: star (code-list tables + mapped fact table) and
bulk (one tab-separated file straight into a table).

Both are compositions of the same operators as the wide tables: text scans,
a join sized by Spark, the reload decision, row-count validation against the
last success, a staged publish and an appended log row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import cast_value
from ..operators.joins import bounded_broadcast
from ..operators.loadlog import (append_log, empty_log, latest_log, log_rows, read_log,
                                 should_reload)
from ..operators.quality import verdict_of
from ..sinks.writers import WriteResult, publish_full_refresh
from ..sources.text import (HEADER_PREFIX, parse_lines, read_bulk, read_dimension_table, read_lines,
                            read_series_mapping, starts_with)


@dataclass(frozen=True)
class StarDim:
    key: str                       # e.g. 'area'; also the header's key column
    file: str
    table: str
    columns: tuple | None = None   # positional names; None: the header names them


@dataclass(frozen=True)
class StarSpec:
    key: str
    data_file: str
    fact_table: str
    dims: tuple = ()
    series_file: str | None = None


MAPPED_COLUMNS = ("area_code", "item_code", "seasonal_code")


def read_star_facts(spark: SparkSession, paths, mapping: DataFrame | None = None,
                    observation: Observation | None = None, mode: str = "strict",
                    max_rows: int | None = None, mapping_rows: int | None = None) -> DataFrame:
    """Fact lines of the star shape: ``series_id, year int, period, value double``
    from the first four fields (lines with fewer are skipped).  With a series
    ``mapping`` the series' codes are added and unknown series are dropped;
    ``observation`` then also counts them as ``unmapped``."""
    rows = parse_lines(read_lines(spark, paths, header=starts_with(HEADER_PREFIX)), ["series_id", "year", "period", "value"],
                       min_fields=4, null_tokens=())
    year = F.when(F.col("year") != "", F.col("year"))
    value = F.when(~F.col("value").isin("", "-"), F.col("value"))
    rows = rows.select("series_id", cast_value(year, "int", mode, "year").alias("year"), "period",
                       cast_value(value, "double", mode, "value").alias("value"))
    if mapping is None:
        return rows.observe(observation, F.count(F.lit(1)).alias("rows")) if observation else rows
    m = bounded_broadcast(mapping.select("series_id", *MAPPED_COLUMNS)
                          .withColumn("_mapped", F.lit(True)), max_rows, mapping_rows)
    j = rows.join(m, "series_id", "left")
    if observation is not None:
        j = j.observe(observation, F.count_if(F.col("_mapped").isNull()).cast("bigint").alias("unmapped"))
    return j.filter(F.col("_mapped")).select("series_id", *MAPPED_COLUMNS, "year", "period", "value")


def publish_and_log(spark: SparkSession, df: DataFrame, root: str, log: DataFrame,
                    log_path: str | None, dataset: str, data_key: str = "all", head=None,
                    partition_by: Sequence[str] = ()) -> WriteResult:
    """Stage ``df`` under ``root``, validate its row count against the last
    successful load of ``(dataset, data_key)``, publish unless failed, log."""
    prev = latest_log(log.filter((F.col("status") == "success") & (F.col("dataset") == dataset)
                                 & (F.col("data_key") == data_key)),
                      ["dataset", "data_key"]).select("rows_loaded").first()
    prev_rows = prev["rows_loaded"] if prev else None

    def validate(rows: int):
        v = verdict_of(rows, prev_rows)
        msg = None if v == "success" else f"{rows} rows against {prev_rows} before"
        return v, msg

    res = publish_full_refresh(df, root, validate, partition_by=partition_by)
    _append(spark, log_path, dataset, data_key, head, "failed" if res.status == "failed" else "success",
            res.rows, None if res.status == "failed" else res.location, res.message)
    return res


def _append(spark, log_path, dataset, data_key, head, status, rows, location, message):
    if not log_path:
        return
    entry = {"dataset": dataset, "data_key": data_key, "rows_loaded": rows, "status": status,
             "error_message": message, "location": location}
    if head is not None:
        entry.update(etag=head["etag"], last_modified=head["last_modified"],
                     source_url=head["source_url"])
    append_log(log_rows(spark, [entry]), log_path)


def _decide(spark, heads, log, dataset, data_key, force):
    """(reload?, head row) for one log key; no heads means always load."""
    if heads is None:
        return True, None
    h = heads.filter((F.col("dataset") == dataset) & (F.col("data_key") == data_key))
    row = should_reload(h, log).first()
    if row is None:
        return True, None
    return force or row["reload"], row


def load_star_dataset(spark: SparkSession, spec: StarSpec, folder: str, out_root: str,
                      log_path: str | None = None, heads: DataFrame | None = None,
                      force: bool = False) -> dict[str, WriteResult | str]:
    """Code-list tables (each with its own reload decision), the series
    mapping, then the fact table mapped through it; one log row per table."""
    base, out = folder.rstrip("/"), out_root.rstrip("/")
    log = read_log(spark, log_path) if log_path else empty_log(spark)
    results: dict[str, WriteResult | str] = {}
    for d in spec.dims:
        name = f"{spec.key}_{d.key}"
        go, head = _decide(spark, heads, log, name, "all", force)
        if not go:
            results[name] = "skipped"
            continue
        try:
            table = read_dimension_table(spark, f"{base}/{d.file}", d.key,
                                         list(d.columns) if d.columns else None)
            results[name] = publish_and_log(spark, table, f"{out}/{d.table}", log, log_path, name, head=head)
        except Exception as e:  # a broken code list doesn't stop the others
            _append(spark, log_path, name, "all", head, "failed", 0, None, str(e))
            results[name] = WriteResult("", 0, "failed", str(e))
    name = f"{spec.key}_fact"
    go, head = _decide(spark, heads, log, name, "all", force)
    if not go:
        results[name] = "skipped"
        return results
    obs = Observation(f"star_{spec.key}")
    try:
        mapping = (read_series_mapping(spark, f"{base}/{spec.series_file}") if spec.series_file else None)
        facts = read_star_facts(spark, f"{base}/{spec.data_file}", mapping, obs)
        res = publish_and_log(spark, facts, f"{out}/{spec.fact_table}", log, log_path, name, head=head)
        res.metrics = {**(res.metrics or {}), **obs.get}
        results[name] = res
    except Exception as e:
        _append(spark, log_path, name, "all", head, "failed", 0, None, str(e))
        results[name] = WriteResult("", 0, "failed", str(e))
    return results


def load_bulk_dataset(spark: SparkSession, key: str, path: str, columns: Sequence[str],
                      out_root: str, table: str, log_path: str | None = None,
                      heads: DataFrame | None = None, force: bool = False) -> WriteResult | str:
    """One bulk file: decision, scan of all listed columns, validation, publish, log."""
    log = read_log(spark, log_path) if log_path else empty_log(spark)
    go, head = _decide(spark, heads, log, key, "all", force)
    if not go:
        return "skipped"
    try:
        return publish_and_log(spark, read_bulk(spark, path, columns),
                               f"{out_root.rstrip('/')}/{table}", log, log_path, key, head=head)
    except Exception as e:
        _append(spark, log_path, key, "all", head, "failed", 0, None, str(e))
        return WriteResult("", 0, "failed", str(e))
