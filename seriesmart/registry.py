"""Registered test queries: each package operator run over the driver's tables.

Every query reads the given Parquet tables (or files Spark writes from them)
in full and goes through the package's operators; ``ORACLE_SQL`` holds the
same result as DuckDB SQL over the raw tables.  Round-trip queries first write
raw text shaped like the survey files (tab-separated, padded, with short rows,
blank lines, NUL bytes, header lines) under the session's checkpoint folder,
then parse it back.

The driver's tables stand in for survey files: ``lineitem`` for facts,
``orders`` for series, ``customer``/``part``/``supplier`` for code lists and
``events`` for the load log (``user_id`` = dataset, ``event_type`` = etag or
status, ``event_id`` = load order; events below half the largest id are the
previous load, the rest the new one).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import (LEGACY_NULL_TOKENS, DEFAULT_NULL_TOKENS, cast_columns, cast_value,
                        http_date, null_if_token, period_label, seasonal_from_id, seasonal_label,
                        url_segment)
from .operators import (Lookup, alerts, already_loaded, check_constraints, check_unique, denormalize, deviation_alert,
                        dimension_sizes, latest_log, longer_than, lookup_join, min_max_year,
                        not_null, orphan_counts, recent_log, row_count_verdict, run_summary,
                        should_download, should_reload, skip_counts, stale_success, table_counts,
                        validate_row_count as validate_counts, with_surrogate_id, year_chunks,
                        year_range)
from .plans import (DatasetPaths, DatasetSpec, LegacySpec, StarDim, StarSpec, load_dataset,
                    load_legacy_dataset, load_star_dataset, parse_ddl)
from .session import scratch_path
from .sinks import (export_csv, publish_full_refresh, read_current, replace_partitions,
                    write_lines, write_tsv)
from .sources import (count_skipped, detect_delimiter, manifest, parse_lines, read_bulk,
                      read_delimited, read_dimension, read_dimension_table, read_lines, read_parts,
                      read_series_mapping, read_years)
from .streaming import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query | None = None, *, name: str | None = None):
    """Register ``fn`` under its own name or ``name``."""
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        return f
    return add(fn) if fn is not None else add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code_list(df: DataFrame, code: str, name: str) -> DataFrame:
    return df.select(F.col(code).alias("code"), F.col(name).alias("name"))


def _half(events: DataFrame):
    """The id that splits the log into the previous and the new load."""
    return events.select((F.max("event_id") / 2).alias("m")).scalar()


# --- scans and sources -------------------------------------------------------

@query
def tsv_positional_scan(spark, sf):
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "tsv_positional_scan")
    # the file carries more fields than wanted: they are cut off positionally
    write_tsv(li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice",
                        "l_partkey", "l_suppkey", "l_shipdate"), path)
    rows = parse_lines(read_lines(spark, path),
                       ["l_orderkey", "l_linenumber", "l_returnflag", "value"])
    return cast_columns(rows, {"l_orderkey": "bigint", "l_linenumber": "int",
                               "value": "decimal(14,2)"})


@query
def short_row_filter(spark, sf):
    """Raw lines from orders: low-priority orders become blank lines, pending
    orders short rows (two fields), the rest full rows."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    full = F.concat_ws("\t", k.cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_orderstatus"), F.col("o_totalprice").cast("string"))
    short = F.concat_ws("\t", k.cast("string"), F.col("o_custkey").cast("string"))
    line = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("  "))
            .when(F.col("o_orderstatus") == "P", short).otherwise(full))
    return count_skipped(o.select(line.alias("value")), 4)


@query
def dim_last_wins(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "dim_last_wins")
    # a code list in which a code repeats; the file is in o_orderkey order
    write_tsv(o.orderBy("o_orderkey").select(F.col("o_custkey").alias("code"),
                                             F.col("o_orderstatus").alias("name")),
              path, header=True)
    d = read_dimension(spark, path)
    return d.select(F.col("code").cast("bigint").alias("o_custkey"), "name")


@query
def dimension_table_scan(spark, sf):
    p = table(spark, sf, "part")
    path = scratch_path(spark, "dimension_table_scan")
    write_tsv(p, path, header=True)
    d = read_dimension_table(spark, path, pk_column="p_partkey")
    d = cast_columns(d, {"p_partkey": "bigint", "p_size": "int"})
    return d.select("p_partkey", "p_name", "p_brand", "p_size")


@query
def bulk_scan(spark, sf):
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "bulk_scan")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    write_tsv(c.select(F.col("c_custkey").alias("series_id"), *cols[1:]), path, header=True)
    d = cast_columns(read_bulk(spark, path, cols), {"c_custkey": "bigint", "c_nationkey": "int"})
    return d.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query
def series_mapping_filter(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "series_mapping_filter")
    # status P plays the empty code: such series are not mapped
    write_tsv(o.select(F.col("o_orderkey").alias("series_id"),
                       F.col("o_custkey").alias("area_code"),
                       F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
                           F.col("o_orderstatus")).alias("item_code")), path, header=True)
    m = read_series_mapping(spark, path, columns=("series_id", "area_code", "item_code"))
    return m.select(F.col("series_id").cast("bigint").alias("o_orderkey"),
                    F.col("area_code").cast("bigint").alias("o_custkey"),
                    F.col("item_code").alias("o_orderstatus"))


@query
def header_mapped_scan(spark, sf):
    s = table(spark, sf, "supplier")
    path = scratch_path(spark, "header_mapped_scan")
    # header in another case; the wanted column 'absent' is not in the file
    export_csv(s.select(F.col("s_suppkey").alias("S_SUPPKEY"), F.col("s_name").alias("S_Name"),
                        F.col("s_nationkey").alias("s_NationKey"), "s_acctbal"), path)
    return read_delimited(spark, path, ["s_suppkey", "s_name", "s_nationkey", "absent"],
                          {"s_suppkey": "bigint", "s_nationkey": "int", "absent": "string"})


@query
def delimiter_detect(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    comma = scratch_path(spark, "delimiter_detect_comma")
    tab = scratch_path(spark, "delimiter_detect_tab")
    export_csv(s, comma)
    write_tsv(s, tab, header=True)
    out = None
    for label, path in (("comma_file", comma), ("tab_file", tab)):
        sep = detect_delimiter(spark, path)
        d = read_delimited(spark, path, ["s_suppkey", "s_nationkey"],
                           {"s_suppkey": "bigint", "s_nationkey": "int"}, sep=sep)
        r = d.agg(F.count(F.lit(1)).alias("n"), F.sum("s_nationkey").cast("bigint").alias("key_sum"))
        r = r.select(F.lit(label).alias("f"), F.lit(sep).alias("delim"), "n", "key_sum")
        out = r if out is None else out.unionByName(r)
    return out


@query
def multi_part_union(spark, sf):
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "multi_part_union")
    for i, status in enumerate(("F", "O", "P"), start=1):
        write_tsv(o.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus"),
                  f"{root}/orders_data_{i}")
    rows = parse_lines(read_parts(spark, root, "orders"), ["o_orderkey", "o_orderstatus"])
    return cast_columns(rows, {"o_orderkey": "bigint"})


@query
def multi_year_scan(spark, sf):
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "multi_year_scan")
    y = F.year("o_orderdate")
    (o.select(y.alias("year"), "o_orderkey", y.alias("y"))
     .write.partitionBy("y").option("header", True).csv(root))
    d = read_years(spark, root, range(1990, 2025), ["{root}/y={year}", "{root}/{year}.csv"],
                   ["year", "o_orderkey"], {"year": "int", "o_orderkey": "bigint"})
    return d.groupBy(F.col("year").alias("yr")).agg(F.count(F.lit(1)).alias("n"))


@query
def nul_strip(spark, sf):
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "nul_strip")
    name = F.concat(F.substring("c_name", 1, 4), F.lit("\x00"), F.expr("substring(c_name, 5)"),
                    F.lit("\x00"))
    write_lines(c.select(F.concat_ws("\t", F.col("c_custkey").cast("string"), name).alias("value")), path)
    rows = parse_lines(read_lines(spark, path), ["c_custkey", "c_name"])
    return cast_columns(rows, {"c_custkey": "bigint"})


@query
def trim_normalize(spark, sf):
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "trim_normalize")
    line = F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit("  \t 　"),
                    F.col("c_name"), F.lit("   \r"))
    write_lines(c.select(line.alias("value")), path)
    rows = parse_lines(read_lines(spark, path), ["c_custkey", "c_name"])
    return cast_columns(rows, {"c_custkey": "bigint"})


@query
def stream_file_ingest(spark, sf):
    e = table(spark, sf, "events")
    landing = scratch_path(spark, "stream_landing")
    out = scratch_path(spark, "stream_out")
    ckpt = scratch_path(spark, "stream_ckpt")
    write_tsv(e.select("event_id", "user_id", "event_type"), landing)
    cols = ["event_id", "user_id", "event_type"]
    stream_ingest(spark, landing, cols, out, ckpt)
    return cast_columns(spark.read.parquet(out), {"event_id": "bigint", "user_id": "bigint"})


@query
def file_manifest(spark, sf):
    n = table(spark, sf, "lineitem")
    path = scratch_path(spark, "file_manifest")
    export_csv(n.select("l_orderkey", "l_linenumber", "l_returnflag"), path)
    m = manifest(spark, path, with_md5=True, glob="*.csv")
    return m.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "md5")


# --- projections, casts, labels ----------------------------------------------

@query
def null_token_normalize(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey",
                    null_if_token("c_mktsegment", (*DEFAULT_NULL_TOKENS, "BUILDING")).alias("seg"))


@query
def null_token_legacy(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey",
                    null_if_token("c_mktsegment", (*LEGACY_NULL_TOKENS, "BUILDING")).alias("seg"))


@query
def decimal_cast(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     cast_value(F.col("l_extendedprice").cast("string"), "decimal(14,2)").alias("value"))


@query
def schema_typed_cast(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "schema_typed_cast")
    write_tsv(o.select("o_orderkey", F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("code"),
                       F.col("o_orderpriority").alias("bad")), path, header=True)
    return read_delimited(spark, path, ["o_orderkey", "code", "bad"],
                          {"o_orderkey": "bigint", "code": "string", "bad": "int"})


@query
def date_guard(spark, sf):
    """Order dates as text; open orders carry them without dashes (dropped)."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "date_guard")
    d = F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "yyyyMMdd"))
    write_tsv(o.select("o_orderkey", d.alias("d")), path, header=True)
    return read_delimited(spark, path, ["o_orderkey", "d"], {"o_orderkey": "bigint", "d": "date"})


@query
def period_label_case(spark, sf):
    o = table(spark, sf, "orders")
    period = F.concat(F.lit("M"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"))
    counts = o.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("period", period_label("period").alias("period_name"), "n")


@query
def seasonal_label_case(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", seasonal_label("o_orderstatus", "F", "O").alias("seasonal_name"))


@query
def substring_key_join(spark, sf):
    p = table(spark, sf, "part")
    r = table(spark, sf, "region")
    code = seasonal_from_id("p_brand", 7)
    regions = _code_list(r.withColumn("k", F.col("r_regionkey").cast("string")), "k", "r_name")
    j = lookup_join(p.withColumn("code", code), regions, "code", "r_name")
    return j.select("p_partkey", "code", "r_name")


@query
def rfc_timestamp(spark, sf):
    e = table(spark, sf, "events")
    text = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    return e.select("event_id", http_date(text).alias("ts"))


@query(name="url_segment")
def url_segment_query(spark, sf):
    pg = table(spark, sf, "pages")
    return pg.select("page_id", url_segment("url", -2).alias("seg"))


@query(name="year_range_filter")
def date_range_filter(spark, sf):
    o = table(spark, sf, "orders")
    return year_range(o, 1996, 1997, "o_orderdate").select("o_orderkey", "o_totalprice")


@query
def surrogate_id(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return with_surrogate_id(p, ["p_partkey"])


# --- joins and denormalization -----------------------------------------------

@query
def star_denormalize(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    dims = {"customer": _code_list(table(spark, sf, "customer"), "c_custkey", "c_name"),
            "part": _code_list(table(spark, sf, "part"), "p_partkey", "p_name"),
            "supplier": _code_list(table(spark, sf, "supplier"), "s_suppkey", "s_name")}
    lookups = [Lookup("customer", "c_name", key="o_custkey"),
               Lookup("part", "p_name", key="l_partkey", on="fact"),
               Lookup("supplier", "s_name", key="l_suppkey", on="fact")]
    return denormalize(li, o, dims, lookups, fact_key="l_orderkey", series_key="o_orderkey",
                       select=["l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "c_name",
                               "l_partkey", "p_name", "l_suppkey", "s_name"])


@query
def left_lookup_keeps_unmatched(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    small = table(spark, sf, "part").filter(F.col("p_size") < 25)
    return denormalize(li, o, {"part": _code_list(small, "p_partkey", "p_name")},
                       [Lookup("part", "p_name", key="l_partkey", on="fact")],
                       fact_key="l_orderkey", series_key="o_orderkey",
                       select=["l_orderkey", "l_linenumber", "l_partkey", "p_name"])


@query
def map_join_skip_count(spark, sf):
    li = table(spark, sf, "lineitem")
    mapped = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return skip_counts(li, mapped, "l_orderkey", "o_orderkey")


@query
def anti_join_orphans(spark, sf):
    li = table(spark, sf, "lineitem")
    mapped = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return orphan_counts(li, mapped, "l_orderkey", "o_orderkey")


# --- aggregates, windows, sort -----------------------------------------------

@query
def table_counts_union(spark, sf):
    return table_counts({t: table(spark, sf, t) for t in ("orders", "lineitem", "part")})


@query(name="dimension_sizes")
def dimension_sizes_query(spark, sf):
    p = table(spark, sf, "part")
    return dimension_sizes({"brand": p.select(F.col("p_brand").alias("code")),
                            "type": p.select(F.col("p_type").alias("code"))})


@query(name="min_max_year")
def min_max_year_query(spark, sf):
    return min_max_year(table(spark, sf, "orders"), "o_orderdate")


@query
def year_chunk_progress(spark, sf):
    return year_chunks(table(spark, sf, "orders"), 2, "o_orderdate")


@query
def log_upsert_latest(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest_log(e, ["user_id", "event_type"], ["ts", "event_id"])


@query
def recent_log_topk(spark, sf):
    e = table(spark, sf, "events")
    return recent_log(e, 10, ("ts", "event_id")).select("event_id", "user_id", "event_type", "ts")


@query(name="run_summary")
def run_summary_query(spark, sf):
    return run_summary(table(spark, sf, "events"), "event_type")


# --- data quality and change detection ---------------------------------------

@query
def pk_duplicates(spark, sf):
    return check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def constraint_violations(spark, sf):
    p = table(spark, sf, "part")
    return check_constraints(p, {"null_names": not_null("p_name"), "too_long": longer_than("p_name", 10)})


def _load_counts(spark, sf):
    e = table(spark, sf, "events")
    m = _half(e)
    return e.groupBy("user_id").agg(
        F.count_if(F.col("event_id") < m).cast("bigint").alias("prev_rows"),
        F.count_if(F.col("event_id") >= m).cast("bigint").alias("new_rows"))


@query
def validate_row_count(spark, sf):
    c = _load_counts(spark, sf)
    return c.select("user_id", "prev_rows", "new_rows",
                    row_count_verdict("new_rows", "prev_rows").alias("verdict"))


@query
def row_deviation_alert(spark, sf):
    c = _load_counts(spark, sf)
    return c.filter(deviation_alert("new_rows", "prev_rows", 0.1)).select("user_id")


@query(name="stale_success")
def stale_success_query(spark, sf):
    e = table(spark, sf, "events")
    now = e.select(F.max("ts")).scalar()
    return stale_success(e, "2 days", keys=["user_id"], now=now, ts_col="ts",
                         ok=F.col("event_type") != "error")


def _log_and_heads(spark, sf):
    """Previous log: per dataset (user) its latest event before the split,
    failed when that event is an error; a dataset whose latest earlier event
    is a signup was registered but never loaded, so it has no log row.
    Source heads: the latest event after the split; a source whose latest
    event is a view sent no etag."""
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    m = _half(e)
    last_prev = latest_log(e.filter(F.col("event_id") < m), ["user_id"], ["event_id"])
    log = (last_prev.filter(F.col("event_type") != "signup")
           .select("user_id", F.col("event_type").alias("etag"),
                   F.when(F.col("event_type") == "error", F.lit("failed"))
                   .otherwise(F.lit("success")).alias("status"),
                   F.col("event_id").alias("seq")))
    new = latest_log(e.filter(F.col("event_id") >= m), ["user_id"], ["event_id"])
    heads = new.select("user_id", F.when(F.col("event_type") == "view", F.lit(None))
                       .otherwise(F.col("event_type")).alias("etag"))
    return log, heads


def _event_log(e):
    """Events as load-log rows: dataset = user, one load per event, failed
    when the event is an error."""
    return e.select(F.col("user_id").alias("dataset"), F.lit("all").alias("data_key"),
                    F.when(F.col("event_type") == "error", F.lit("failed"))
                    .otherwise(F.lit("success")).alias("status"),
                    F.col("ts").alias("load_timestamp"), F.col("event_id").alias("seq"),
                    F.col("value"))


@query
def already_loaded_skip(spark, sf):
    """Skip a dataset whose current ``all`` entry says success."""
    e = table(spark, sf, "events")
    datasets = e.select(F.col("user_id").alias("dataset")).distinct()
    return already_loaded(datasets, _event_log(e)).select(F.col("dataset").alias("user_id"), "skip")


@query
def validate_against_last_success(spark, sf):
    """New row counts (events after the split) judged against the last
    successful earlier load; a failed load never lowers the bar.  Earlier
    loads per user: a successful one with the user's non-error events before
    the split, and a failed one with the error events."""
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    m = _half(e)
    ok = F.col("event_type") != "error"
    before = e.filter(F.col("event_id") < m)
    loads = []
    for status, cond in (("success", ok), ("failed", ~ok)):
        loads.append(before.groupBy(F.col("user_id").alias("dataset")).agg(
            F.count_if(cond).alias("rows_loaded"), F.max(F.when(cond, F.col("ts"))).alias("load_timestamp"),
            F.max(F.when(cond, F.col("event_id"))).alias("seq"))
            .filter(F.col("rows_loaded") > 0)
            .withColumns({"data_key": F.lit("all"), "status": F.lit(status)}))
    log = loads[0].unionByName(loads[1])
    new = (e.filter(F.col("event_id") >= m).groupBy(F.col("user_id").alias("dataset"))
           .agg(F.count(F.lit(1)).alias("rows_loaded")).withColumn("data_key", F.lit("all")))
    v = validate_counts(new, log)
    return v.select(F.col("dataset").alias("user_id"), "new_rows", "prev_rows", "verdict")


@query
def load_log_alerts(spark, sf):
    """Alerts over a log where every event is a load of its user's dataset
    (error events failed), with floor(value) rows: failed datasets, no
    success within two days of the newest event, and a row count that moved
    more than 10 % between the last two successful loads."""
    e = table(spark, sf, "events")
    log = _event_log(e).withColumns({"rows_loaded": F.floor("value").cast("bigint"),
                                     "error_message": F.lit(None).cast("string")})
    now = e.select(F.max("ts")).scalar()
    return alerts(log, "2 days", 0.1, now=now).select(F.col("dataset").alias("user_id"), "alert")


@query(name="should_reload")
def should_reload_query(spark, sf):
    log, heads = _log_and_heads(spark, sf)
    return should_reload(heads, log, keys=["user_id"], order=["seq"]).select("user_id", "reload")


@query(name="should_download")
def should_download_query(spark, sf):
    log, heads = _log_and_heads(spark, sf)
    return should_download(heads, log, keys=["user_id"], order=["seq"]).select("user_id", "download")


# --- sinks --------------------------------------------------------------------

@query
def full_refresh_roundtrip(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    root = scratch_path(spark, "full_refresh")
    res = publish_full_refresh(s, root, validate=lambda rows: ("success", None))
    assert res.status == "success"
    return read_current(spark, root)


@query
def partition_replace(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus",
                                          F.year("o_orderdate").alias("yr"))
    path = scratch_path(spark, "partition_replace")
    o.write.partitionBy("yr").parquet(path)
    # a revised 1996 that keeps only status F: only that year's folder changes
    replace_partitions(o.filter((F.col("yr") == 1996) & (F.col("o_orderstatus") == "F")), path, "yr")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "yr")


@query
def csv_export_roundtrip(spark, sf):
    n = table(spark, sf, "nation")
    path = scratch_path(spark, "csv_export")
    export_csv(n, path)
    return read_delimited(spark, path, ["n_nationkey", "n_name", "n_regionkey"],
                          {"n_nationkey": "int", "n_regionkey": "int"})


# --- the whole load, end to end ----------------------------------------------

# A survey-shaped dataset over the driver's tables: lineitem rows are the
# observations of series = orders, customer is the code list of the series'
# customer code, the order status plays the seasonal flag (F adjusted, O not).
ORDERS_SURVEY = DatasetSpec(
    key="orders_survey", title="Orders as a survey", table="orders_wide",
    data_file="orders_survey.data", series_file="orders_survey.series",
    dimension_files={"customer": "orders_survey.customer"},
    series_columns=("series_id", "customer_code", "status", "priority"),
    lookups=(Lookup("customer", "customer_name", key="customer_code"),),
    columns=parse_ddl("series_id varchar(20) not null, year int not null, "
                      "period varchar(3) not null, period_name varchar(50), value decimal(14,2), "
                      "customer_code varchar(20), customer_name varchar(100), "
                      "seasonal_code varchar(1), seasonal_name varchar(30), "
                      "footnote_codes varchar(10)"),
    code_from={"seasonal_code": "status",
               "seasonal_name": "CASE status WHEN 'F' THEN 'Seasonally Adjusted' "
                                "WHEN 'O' THEN 'Not Seasonally Adjusted' END"},
    # several lines of one order ship in the same month: no (series, year,
    # period) key on this data
    chunk_years=2, primary_key=())


def survey_files(spark, sf) -> str:
    """Raw survey-shaped files derived from lineitem, orders and customer."""
    li, o, c = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    src = scratch_path(spark, "survey_src")
    spec = ORDERS_SURVEY
    period = F.concat(F.lit("M"), F.lpad(F.month("l_shipdate").cast("string"), 2, "0"))
    write_tsv(li.select(F.col("l_orderkey").alias("series_id"), F.year("l_shipdate").alias("year"),
                        period.alias("period"), F.col("l_extendedprice").alias("value"),
                        F.col("l_returnflag").alias("footnote_codes")),
              f"{src}/{spec.data_file}", header=True)
    write_tsv(o.select(F.col("o_orderkey").alias("series_id"), F.col("o_custkey").alias("customer_code"),
                       F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")),
              f"{src}/{spec.series_file}", header=True)
    write_tsv(c.select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name")),
              f"{src}/{spec.dimension_files['customer']}", header=True)
    return src


@query
def survey_load_end_to_end(spark, sf):
    spec = ORDERS_SURVEY
    src = survey_files(spark, sf)
    out = scratch_path(spark, "survey_out")
    res = load_dataset(spark, spec, DatasetPaths.in_folder(src, spec), out, f"{out}/_load_log")
    if res.status == "failed":
        raise RuntimeError(f"load failed: {res.message}")
    return spark.read.parquet(res.location)


ORDERS_STAR = StarSpec(key="orders_star", data_file="orders_star.data", fact_table="orders_fact",
                       dims=(StarDim("area", "orders_star.area", "orders_area",
                                     ("area_code", "area_name")),),
                       series_file="orders_star.series")


@query
def star_path_load(spark, sf):
    """The star load shape: a code-list table, a series mapping (orders with
    status P carry an empty item code and are not mapped) and the fact table
    of lineitem rows mapped through it."""
    li, o, c = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    src = scratch_path(spark, "star_src")
    spec = ORDERS_STAR
    period = F.concat(F.lit("M"), F.lpad(F.month("l_shipdate").cast("string"), 2, "0"))
    write_tsv(li.select(F.col("l_orderkey").alias("series_id"), F.year("l_shipdate").alias("year"),
                        period.alias("period"), F.col("l_extendedprice").alias("value")),
              f"{src}/{spec.data_file}", header=True)
    item = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderpriority"))
    write_tsv(o.select(F.col("o_orderkey").alias("series_id"), F.col("o_custkey").alias("area_code"),
                       item.alias("item_code"), F.col("o_orderstatus").alias("seasonal_code")),
              f"{src}/{spec.series_file}", header=True)
    write_tsv(c.select(F.col("c_custkey").alias("area_code"), F.col("c_name").alias("area_name")),
              f"{src}/{spec.dims[0].file}", header=True)
    out = scratch_path(spark, "star_out")
    res = load_star_dataset(spark, spec, src, out, f"{out}/_load_log")["orders_star_fact"]
    if res.status == "failed":
        raise RuntimeError(f"load failed: {res.message}")
    return spark.read.parquet(res.location)


ORDERS_LEGACY = LegacySpec("orders_legacy", "orders_narrow",
                           (("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                            ("o_orderstatus", "string"), ("o_orderdate", "date")))


@query
def legacy_parts_load(spark, sf):
    """The older loader's shape: two parts of one dataset, one comma-separated
    with an upper-case header, one tab-separated; each part decided and logged
    on its own, both loaded in one job."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    root = scratch_path(spark, "legacy_src")
    export_csv(o.filter(F.col("o_orderstatus") == "F").toDF(*[c.upper() for c in o.columns]),
               f"{root}/orders_data_1")
    write_tsv(o.filter(F.col("o_orderstatus") != "F"), f"{root}/orders_data_2", header=True)
    out = scratch_path(spark, "legacy_out")
    res = load_legacy_dataset(spark, ORDERS_LEGACY, [f"{root}/orders_data_1", f"{root}/orders_data_2"],
                              out, f"{out}/_load_log")
    if res["status"] == "failed":
        raise RuntimeError("load failed")
    return spark.read.parquet(res["location"]).drop("loaded_at")


ORACLE_SQL: dict[str, str] = {
    "already_loaded_skip": "SELECT user_id, event_type <> 'error' AS skip FROM (SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1",
    "validate_against_last_success": "WITH cut AS (SELECT MAX(event_id) / 2 AS m FROM events), a AS (SELECT user_id, CAST(SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS ok_rows FROM events CROSS JOIN cut WHERE event_id < m GROUP BY user_id), new AS (SELECT user_id, COUNT(*) AS new_rows FROM events CROSS JOIN cut WHERE event_id >= m GROUP BY user_id) SELECT n.user_id, n.new_rows, NULLIF(a.ok_rows, 0) AS prev_rows, CASE WHEN a.ok_rows IS NULL OR a.ok_rows <= 0 THEN 'success' WHEN n.new_rows < a.ok_rows * 0.5 THEN 'failed' WHEN n.new_rows < a.ok_rows * 0.9 THEN 'warning' ELSE 'success' END AS verdict FROM new n LEFT JOIN a ON n.user_id = a.user_id",
    "anti_join_orphans": "SELECT l_orderkey, COUNT(*) AS n FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F') GROUP BY l_orderkey",
    "bulk_scan": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "constraint_violations": "SELECT CAST(SUM(CASE WHEN p_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_names, CAST(SUM(CASE WHEN length(p_name) > 10 THEN 1 ELSE 0 END) AS BIGINT) AS too_long FROM part",
    "csv_export_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "date_guard": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS d FROM orders",
    "decimal_cast": "SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(14,2)) AS value FROM lineitem",
    "delimiter_detect": "SELECT 'comma_file' AS f, ',' AS delim, COUNT(*) AS n, CAST(SUM(s_nationkey) AS BIGINT) AS key_sum FROM supplier UNION ALL SELECT 'tab_file', chr(9), COUNT(*), CAST(SUM(s_nationkey) AS BIGINT) FROM supplier",
    "dim_last_wins": "SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS name FROM orders GROUP BY o_custkey",
    "dimension_sizes": "SELECT 'brand' AS dim, COUNT(DISTINCT p_brand) AS n FROM part UNION ALL SELECT 'type', COUNT(DISTINCT p_type) FROM part",
    "dimension_table_scan": "SELECT p_partkey, p_name, p_brand, p_size FROM part",
    "full_refresh_roundtrip": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "header_mapped_scan": "SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS VARCHAR) AS absent FROM supplier",
    "legacy_parts_load": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
    "left_lookup_keeps_unmatched": "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN (SELECT * FROM part WHERE p_size < 25) p ON l.l_partkey = p.p_partkey",
    "load_log_alerts": "WITH lg AS (SELECT user_id, event_id, ts, event_type, CAST(FLOOR(value) AS BIGINT) AS rows_loaded FROM events), cur AS (SELECT user_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM lg) t WHERE rn = 1), ok AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM lg WHERE event_type <> 'error'), failed AS (SELECT user_id, 'failed' AS alert FROM cur WHERE event_type = 'error'), stale AS (SELECT user_id, 'stale' AS alert FROM ok WHERE rn = 1 AND ts < (SELECT MAX(ts) FROM events) - INTERVAL 2 DAY), dev AS (SELECT n.user_id, 'row_deviation' AS alert FROM ok n JOIN ok p ON n.user_id = p.user_id AND n.rn = 1 AND p.rn = 2 WHERE p.rows_loaded > 0 AND abs(n.rows_loaded - p.rows_loaded) > 0.1 * p.rows_loaded) SELECT user_id, alert FROM failed UNION ALL SELECT user_id, alert FROM stale UNION ALL SELECT user_id, alert FROM dev",
    "log_upsert_latest": "SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1",
    "map_join_skip_count": "SELECT CAST(SUM(CASE WHEN o.o_orderkey IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS loaded, CAST(SUM(CASE WHEN o.o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS skipped FROM lineitem l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') o ON l.l_orderkey = o.o_orderkey",
    "min_max_year": "SELECT CAST(MIN(year(o_orderdate)) AS INTEGER) AS min_year, CAST(MAX(year(o_orderdate)) AS INTEGER) AS max_year FROM orders",
    "multi_part_union": "SELECT o_orderkey, o_orderstatus FROM orders",
    "multi_year_scan": "SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS n FROM orders GROUP BY 1",
    "nul_strip": "SELECT c_custkey, c_name FROM customer",
    "null_token_legacy": "SELECT c_custkey, CASE WHEN c_mktsegment IN ('', 'NA', 'NaN', 'BUILDING') THEN NULL ELSE c_mktsegment END AS seg FROM customer",
    "null_token_normalize": "SELECT c_custkey, CASE WHEN c_mktsegment IN ('', '-', 'BUILDING') THEN NULL ELSE c_mktsegment END AS seg FROM customer",
    "partition_replace": "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders WHERE year(o_orderdate) <> 1996 OR o_orderstatus = 'F'",
    "period_label_case": "SELECT period, CASE period WHEN 'M01' THEN 'JAN' WHEN 'M02' THEN 'FEB' WHEN 'M03' THEN 'MAR' WHEN 'M04' THEN 'APR' WHEN 'M05' THEN 'MAY' WHEN 'M06' THEN 'JUN' WHEN 'M07' THEN 'JUL' WHEN 'M08' THEN 'AUG' WHEN 'M09' THEN 'SEP' WHEN 'M10' THEN 'OCT' WHEN 'M11' THEN 'NOV' WHEN 'M12' THEN 'DEC' ELSE period END AS period_name, COUNT(*) AS n FROM (SELECT 'M' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS period FROM orders) t GROUP BY period",
    "pk_duplicates": "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
    "recent_log_topk": "SELECT event_id, user_id, event_type, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 10",
    "rfc_timestamp": "SELECT event_id, date_trunc('second', ts) AS ts FROM events",
    "row_deviation_alert": "WITH cut AS (SELECT MAX(event_id) / 2 AS m FROM events), c AS (SELECT user_id, SUM(CASE WHEN event_id < m THEN 1 ELSE 0 END) AS p, SUM(CASE WHEN event_id >= m THEN 1 ELSE 0 END) AS n FROM events CROSS JOIN cut GROUP BY user_id) SELECT user_id FROM c WHERE p > 0 AND abs(n - p) > 0.1 * p",
    "run_summary": "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type",
    "schema_typed_cast": "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR),12,'0') AS code, TRY_CAST(o_orderpriority AS INTEGER) AS bad FROM orders",
    "seasonal_label_case": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Seasonally Adjusted' WHEN 'O' THEN 'Not Seasonally Adjusted' ELSE NULL END AS seasonal_name FROM orders",
    "series_mapping_filter": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
    "short_row_filter": "SELECT CAST(SUM(CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS kept, CAST(SUM(CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS skipped FROM orders",
    "should_download": "WITH cut AS (SELECT MAX(event_id) / 2 AS m FROM events), prev AS (SELECT user_id, etag, status FROM (SELECT user_id, event_type AS etag, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events CROSS JOIN cut WHERE event_id < m) t WHERE rn = 1 AND etag <> 'signup'), head AS (SELECT user_id, CASE WHEN etag = 'view' THEN NULL ELSE etag END AS etag FROM (SELECT user_id, event_type AS etag, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events CROSS JOIN cut WHERE event_id >= m) t WHERE rn = 1) SELECT h.user_id, CASE WHEN h.etag IS NULL OR h.etag = '' THEN true WHEN p.user_id IS NULL THEN true WHEN p.status = 'failed' THEN true ELSE h.etag IS DISTINCT FROM p.etag END AS download FROM head h LEFT JOIN prev p ON h.user_id = p.user_id",
    "should_reload": "WITH cut AS (SELECT MAX(event_id) / 2 AS m FROM events), prev AS (SELECT user_id, etag, status FROM (SELECT user_id, event_type AS etag, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events CROSS JOIN cut WHERE event_id < m) t WHERE rn = 1 AND etag <> 'signup'), head AS (SELECT user_id, CASE WHEN etag = 'view' THEN NULL ELSE etag END AS etag FROM (SELECT user_id, event_type AS etag, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events CROSS JOIN cut WHERE event_id >= m) t WHERE rn = 1) SELECT h.user_id, CASE WHEN p.user_id IS NULL THEN true WHEN p.status = 'failed' THEN true WHEN h.etag IS NULL OR h.etag = '' THEN false ELSE h.etag IS DISTINCT FROM p.etag END AS reload FROM head h LEFT JOIN prev p ON h.user_id = p.user_id",
    "stale_success": "SELECT user_id, MAX(CASE WHEN event_type <> 'error' THEN ts END) AS last_ok FROM events GROUP BY user_id HAVING MAX(CASE WHEN event_type <> 'error' THEN ts END) < (SELECT MAX(ts) FROM events) - INTERVAL 2 DAY",
    "star_path_load": "SELECT CAST(l.l_orderkey AS VARCHAR) AS series_id, CAST(o.o_custkey AS VARCHAR) AS area_code, o.o_orderpriority AS item_code, o.o_orderstatus AS seasonal_code, CAST(year(l.l_shipdate) AS INTEGER) AS year, 'M' || lpad(CAST(month(l.l_shipdate) AS VARCHAR), 2, '0') AS period, CAST(CAST(l.l_extendedprice AS VARCHAR) AS DOUBLE) AS value FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus <> 'P'",
    "star_denormalize": "SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_custkey, c.c_name, l.l_partkey, p.p_name, l.l_suppkey, s.s_name FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey",
    "stream_file_ingest": "SELECT event_id, user_id, event_type FROM events",
    "substring_key_join": "SELECT p.p_partkey, substring(p.p_brand, 7, 1) AS code, r.r_name FROM part p LEFT JOIN region r ON substring(p.p_brand, 7, 1) = CAST(r.r_regionkey AS VARCHAR)",
    "survey_load_end_to_end": "SELECT CAST(l.l_orderkey AS VARCHAR) AS series_id, CAST(year(l.l_shipdate) AS INTEGER) AS year, 'M' || lpad(CAST(month(l.l_shipdate) AS VARCHAR), 2, '0') AS period, CASE 'M' || lpad(CAST(month(l.l_shipdate) AS VARCHAR), 2, '0') WHEN 'M01' THEN 'JAN' WHEN 'M02' THEN 'FEB' WHEN 'M03' THEN 'MAR' WHEN 'M04' THEN 'APR' WHEN 'M05' THEN 'MAY' WHEN 'M06' THEN 'JUN' WHEN 'M07' THEN 'JUL' WHEN 'M08' THEN 'AUG' WHEN 'M09' THEN 'SEP' WHEN 'M10' THEN 'OCT' WHEN 'M11' THEN 'NOV' WHEN 'M12' THEN 'DEC' END AS period_name, CAST(CAST(l.l_extendedprice AS VARCHAR) AS DECIMAL(14,2)) AS value, CAST(o.o_custkey AS VARCHAR) AS customer_code, c.c_name AS customer_name, o.o_orderstatus AS seasonal_code, CASE o.o_orderstatus WHEN 'F' THEN 'Seasonally Adjusted' WHEN 'O' THEN 'Not Seasonally Adjusted' END AS seasonal_name, l.l_returnflag AS footnote_codes FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
    "surrogate_id": "SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_partkey) AS BIGINT) AS id, p_partkey, p_name FROM part",
    "table_counts_union": "SELECT 'orders' AS tbl, COUNT(*) AS n FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'part', COUNT(*) FROM part",
    "trim_normalize": "SELECT c_custkey, c_name FROM customer",
    "tsv_positional_scan": "SELECT l_orderkey, l_linenumber, l_returnflag, CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(14,2)) AS value FROM lineitem",
    "url_segment": "SELECT page_id, list_extract(string_split(url, '/'), -2) AS seg FROM pages",
    "validate_row_count": "WITH cut AS (SELECT MAX(event_id) / 2 AS m FROM events), c AS (SELECT user_id, SUM(CASE WHEN event_id < m THEN 1 ELSE 0 END) AS prev_rows, SUM(CASE WHEN event_id >= m THEN 1 ELSE 0 END) AS new_rows FROM events CROSS JOIN cut GROUP BY user_id) SELECT user_id, CAST(prev_rows AS BIGINT) AS prev_rows, CAST(new_rows AS BIGINT) AS new_rows, CASE WHEN prev_rows <= 0 THEN 'success' WHEN new_rows < prev_rows * 0.5 THEN 'failed' WHEN new_rows < prev_rows * 0.9 THEN 'warning' ELSE 'success' END AS verdict FROM c",
    "year_chunk_progress": "WITH y AS (SELECT CAST(year(o_orderdate) AS INT) AS yr FROM orders), b AS (SELECT MIN(yr) AS lo, MAX(yr) AS hi FROM y), c AS (SELECT CAST(lo + floor((yr - lo) / 2.0) * 2 AS INT) AS chunk_start, hi, COUNT(*) AS chunk_rows FROM y CROSS JOIN b GROUP BY 1, hi) SELECT chunk_start, CAST(LEAST(chunk_start + 1, hi) AS INT) AS chunk_end, chunk_rows, CAST(SUM(chunk_rows) OVER (ORDER BY chunk_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_rows FROM c",
    "year_range_filter": "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997",
}

from . import registry_loads, registry_tables  # noqa: E402  (register their queries here, after the helpers above)

for _more in (registry_loads, registry_tables):
    QUERIES.update(_more.QUERIES)
    ORACLE_SQL.update(_more.ORACLE_SQL)
