"""More registered queries: the ten datasets' loads and the load's edge cases.

Each dataset of the catalog is fed from the driver's tables under its own file
names, positional columns and code lists, and loaded by ``load_dataset``:
``lineitem`` (one row per order and month, so that the primary key holds) gives
the facts, ``orders`` with their customers the series, and nations, market
segments, priorities, seasons and months the code lists.  Orders with status P
have no series, some codes are NULL (customers in debt), each code list lacks
one code, and the fact files hold short lines.  The oracles are built from the
same catalog entry as SQL over the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.labels import PERIOD_LABELS
from .operators import append_log, check_constraints, out_of_range, read_log, with_surrogate_id
from .operators.loadlog import LOG_SCHEMA, latest_log, shown_etag
from .operators.quality import validate_row_count
from .plans import DatasetPaths, LegacySpec, load_all, load_dataset, load_legacy_dataset
from .plans.legacy_specs import LEGACY_DATASETS, part_names
from .plans.specs import DATASETS, DatasetSpec
from .session import scratch_path
from .sinks import append, export_csv, write_lines, write_tsv
from .sources import manifest, parse_lines, read_delimited, read_dimension_table, read_lines, read_series
from .sources.files import existing_per_key

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        ORACLE_SQL[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# --- the ten datasets ------------------------------------------------------------------------

#: Kind of code list -> (code of a series as SQL over orders and customer, the
#: list's source table, its code and name there, the code that the list lacks).
KINDS = {
    "nation": ("CASE WHEN c_acctbal < 0 THEN '-' ELSE CAST(c_nationkey AS STRING) END",
               "nation", "CAST(n_nationkey AS STRING)", "n_name", "n_regionkey = 2"),
    "segment": ("substring(c_mktsegment, 1, 2)", "customer", "substring(c_mktsegment, 1, 2)", "c_mktsegment", "c_mktsegment = 'MACHINERY'"),
    "priority": ("substring(o_orderpriority, 1, 1)", "orders", "substring(o_orderpriority, 1, 1)", "o_orderpriority", "o_orderpriority = '5-LOW'"),
    "season": ("CASE o_orderstatus WHEN 'F' THEN 'S' ELSE 'U' END", "orders", "CASE o_orderstatus WHEN 'F' THEN 'S' ELSE 'U' END",
               "CASE o_orderstatus WHEN 'F' THEN 'Adjusted' ELSE 'Raw' END", "o_orderstatus = 'P'"),
    "digit": ("", "region", "CAST(r_regionkey AS STRING)", "r_name", "r_name = 'ASIA'"),
    "month": ("", "lineitem", "'M' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0')",
              "'Month ' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0')", "month(l_shipdate) = 12"),
}


def _kind(spec: DatasetSpec, column: str) -> str | None:
    """The kind of code in a column of the series file."""
    if column.startswith("seasonal"):
        return "season"
    if not column.endswith("_code"):
        return None
    codes = [c for c in spec.series_columns if c.endswith("_code") and not c.startswith("seasonal")]
    return ("nation", "segment", "priority")[codes.index(column) % 3]


def _list_kind(spec: DatasetSpec, dim: str) -> str:
    if dim == "period":
        return "month"
    lk = next(x for x in spec.lookups if x.dim == dim)
    return _kind(spec, lk.key) if lk.key else "digit"


def _survey_files(spark: SparkSession, sf: str, spec: DatasetSpec) -> str:
    src = scratch_path(spark, spec.key)
    for t in ("orders", "customer", "nation", "region", "lineitem"):
        table(spark, sf, t).createOrReplaceTempView(t)
    facts = spark.sql("""SELECT l_orderkey AS series_id, year(l_shipdate) AS year, 'M' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS period,
                                max(l_extendedprice) AS value, max(l_returnflag) AS footnote_codes
                         FROM lineitem GROUP BY l_orderkey, year(l_shipdate), month(l_shipdate)""")
    write_tsv(facts.select(*spec.fact_columns), f"{src}/{spec.data_file}", header=True)
    write_lines(spark.sql("SELECT r_name || '\\t2000' AS value FROM region"), f"{src}/{spec.data_file}", mode="append")
    columns = ["CAST(o_orderkey AS STRING) AS series_id"]
    for c in spec.series_columns[1:]:
        kind = _kind(spec, c)
        columns.append(f"{KINDS[kind][0] if kind else 'o_orderpriority'} AS {c}")
    write_tsv(spark.sql(f"SELECT {', '.join(columns)} FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'"),
              f"{src}/{spec.series_file}", header=True)
    for dim, file in spec.dimension_files.items():
        if dim == "period" and spec.period_name != "lookup":
            continue
        _, source, code, name, lacks = KINDS[_list_kind(spec, dim)]
        key_col, name_col = spec.dim_columns.get(dim, (0, 1))
        width = [F.lit("x").alias(f"c{i}") for i in range(max(key_col, name_col) + 1)]
        width[key_col], width[name_col] = F.col("code"), F.col("name")
        write_tsv(spark.sql(f"SELECT DISTINCT {code} AS code, {name} AS name FROM {source} WHERE NOT ({lacks})").select(*width), f"{src}/{file}", header=True)
    return src


def _load(spark: SparkSession, sf: str, spec: DatasetSpec):
    src, out = _survey_files(spark, sf, spec), scratch_path(spark, f"{spec.key}_out")
    paths = DatasetPaths.in_folder(src, spec)
    if spec.period_name != "lookup":
        paths.dims = {k: v for k, v in paths.dims.items() if k != "period"}
    res = load_dataset(spark, spec, paths, out, f"{out}/_load_log")
    if res.status == "failed":
        raise RuntimeError(f"load failed: {res.message}")
    return res


def _wide_sql(spec: DatasetSpec) -> str:
    """The wide table as DuckDB SQL over the raw tables."""
    null = lambda e: f"NULLIF({e}, '-')"
    code = lambda c: null(KINDS[_kind(spec, c)][0])
    ctes = ["""f AS (SELECT l_orderkey, CAST(year(l_shipdate) AS INT) AS yr, 'M' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS period,
                     max(l_extendedprice) AS v, max(l_returnflag) AS note FROM lineitem GROUP BY 1, 2, 3)"""]
    joins, out = [], []
    for i, lk in enumerate(spec.lookups):
        if lk.dim == "period" and spec.period_name != "lookup":
            continue
        _, source, c, name, lacks = KINDS[_list_kind(spec, lk.dim)]
        ctes.append(f"d{i} AS (SELECT DISTINCT {c} AS code, {name} AS name FROM {source} WHERE NOT ({lacks}))")
        key = "f.period" if lk.dim == "period" else code(lk.key) if lk.key else "substring(CAST(f.l_orderkey AS STRING), 3, 1)"
        joins.append(f"LEFT JOIN d{i} ON d{i}.code = {key}")
    named = {lk.name_out: f"d{i}.name" for i, lk in enumerate(spec.lookups)}
    labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PERIOD_LABELS.items())
    fixed = {"series_id": "CAST(f.l_orderkey AS STRING)", "year": "f.yr", "period": "f.period", "footnote_codes": "f.note",
             "value": f"CAST(CAST(f.v AS STRING) AS {spec.value_type})"}
    for name, _, _ in spec.columns:
        source = spec.code_from.get(name)
        if name in fixed:
            e = fixed[name]
        elif name == "period_name" and spec.period_name == "case":
            e = f"CASE f.period {labels} ELSE f.period END"
        elif name in named:
            e = named[name]
        elif source in spec.series_columns or name in spec.series_columns:
            e = code(source if source in spec.series_columns else name)
        elif source and source.startswith("substring"):
            e = "substring(CAST(f.l_orderkey AS STRING), 3, 1)"
        elif source:  # a CASE over the seasonal code
            e = f"CASE {KINDS['season'][0]} WHEN 'S' THEN 'Seasonally Adjusted' WHEN 'U' THEN 'Not Seasonally Adjusted' END"
        else:
            e = "CAST(NULL AS STRING)"
        out.append(f"{e} AS {name}")
    if spec.surrogate_id:
        out.insert(0, "ROW_NUMBER() OVER (ORDER BY CAST(f.l_orderkey AS STRING), f.yr, f.period) AS id")
    return (f"WITH {', '.join(ctes)} SELECT {', '.join(out)} FROM f JOIN orders ON o_orderkey = f.l_orderkey "
            f"JOIN customer ON c_custkey = o_custkey {' '.join(joins)} WHERE o_orderstatus <> 'P'")


def _register(spec: DatasetSpec) -> None:
    def wide(spark, sf):
        return spark.read.parquet(_load(spark, sf, spec).location)
    wide.__name__ = f"wide_{spec.key}"
    query(_wide_sql(spec))(wide)


for _spec in DATASETS.values():
    _register(_spec)


@query("""WITH f AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, year(l_shipdate), month(l_shipdate))
          SELECT count(*) FILTER (WHERE o_orderstatus <> 'P') AS n_rows, (SELECT count(*) FROM region) AS skipped_lines,
                 count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus = 'P') AS orphan_facts
          FROM f LEFT JOIN orders ON o_orderkey = l_orderkey""")
def surrogate_id_load_counts(spark, sf):
    """Counts of a load that numbers its rows: every line counted once."""
    res = _load(spark, sf, DATASETS["cpi"])
    return spark.sql(f"SELECT CAST({res.rows} AS BIGINT) AS n_rows, CAST({res.skipped_lines} AS BIGINT) AS skipped_lines, "
                     f"CAST({res.violations['orphan_facts']} AS BIGINT) AS orphan_facts")


# --- the older loader ------------------------------------------------------------------------

_LEGACY = LegacySpec("orders_parts", "orders_parts", (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string")), stamp=False)


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE o_custkey END AS o_custkey, o_orderstatus FROM orders")
def legacy_partial_reload(spark, sf):
    """Two loads of three parts; before the second only the first part changes (all its customers become -1)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    src, out = scratch_path(spark, "partial_src"), scratch_path(spark, "partial_out")
    parts = [f"{src}/orders_data_{i}" for i in (1, 2, 3)]
    for path, status in zip(parts, "FOP"):
        export_csv(o.filter(F.col("o_orderstatus") == status), path)

    def heads(tag):
        return spark.sql(f"SELECT 'orders_parts' AS dataset, 'part' || i AS data_key, CASE i WHEN 1 THEN '{tag}' ELSE 'same' END AS etag, "
                         "CAST(NULL AS TIMESTAMP) AS last_modified, 'src' AS source_url FROM VALUES (1), (2), (3) AS t(i)")

    load_legacy_dataset(spark, _LEGACY, parts, out, f"{out}/_load_log", heads("old"))
    export_csv(o.filter("o_orderstatus = 'F'").withColumn("o_custkey", F.lit(-1)), parts[0])
    res = load_legacy_dataset(spark, _LEGACY, parts, out, f"{out}/_load_log", heads("new"))
    return spark.read.parquet(res["location"])


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders")
def mixed_header_parts(spark, sf):
    """Parts of orders with their columns in another order, case and delimiter, one without a column."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    src = scratch_path(spark, "mixed_src")
    export_csv(o.filter("o_orderstatus = 'F'"), f"{src}/a")
    write_tsv(o.filter("o_orderstatus = 'O'").select("o_orderstatus", F.col("o_custkey").alias("O_CUSTKEY"), "o_orderkey"), f"{src}/b", header=True)
    export_csv(o.filter("o_orderstatus = 'P'").select("o_custkey", "o_orderkey"), f"{src}/c")
    return read_delimited(spark, [f"{src}/{x}" for x in "abc"], ["o_orderkey", "o_custkey", "o_orderstatus"], {"o_orderkey": "bigint", "o_custkey": "bigint"})


@query("""SELECT c_custkey, c_name || ', "' || c_mktsegment || '", C:\\' || c_nationkey || '\\' AS label FROM customer""")
def quoted_csv_roundtrip(spark, sf):
    """Names with delimiters, quotes and backslashes, exported and read again."""
    c = table(spark, sf, "customer").select("c_custkey", F.concat(
        "c_name", F.lit(', "'), "c_mktsegment", F.lit('", C:\\'), F.col("c_nationkey").cast("string"), F.lit("\\")).alias("label"))
    path = scratch_path(spark, "quoted")
    export_csv(c, path)
    return read_delimited(spark, path, ["c_custkey", "label"], {"c_custkey": "bigint"})


@query("""SELECT CAST(l_orderkey AS STRING) AS series_id, CAST(year(l_shipdate) AS INT) AS year, 'M' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS period,
                 CAST(CAST(l_extendedprice AS STRING) AS DECIMAL(28,10)) AS value, l_returnflag AS footnote_codes FROM lineitem""")
def legacy_catalog_parts(spark, sf):
    """A dataset of the older catalog with two parts (seasonally unadjusted and adjusted: line status O and F)."""
    entry = LEGACY_DATASETS["la"]
    li = table(spark, sf, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("series_id"), F.year("l_shipdate").alias("year"), F.concat(F.lit("M"), F.lpad(F.month("l_shipdate").cast("string"), 2, "0")).alias("period"),
                     F.col("l_extendedprice").alias("value"), F.col("l_returnflag").alias("footnote_codes"), "l_linestatus")
    src, out = scratch_path(spark, "la_src"), scratch_path(spark, "la_out")
    parts = part_names(entry, src)
    for path, status in zip(parts, "OF"):
        write_tsv(rows.filter(F.col("l_linestatus") == status).drop("l_linestatus"), path, header=True)
    res = load_legacy_dataset(spark, entry.spec, parts, out, f"{out}/_load_log")
    return spark.read.parquet(res["location"]).drop("loaded_at")


@query("""SELECT CAST(c_custkey AS STRING) AS area_fips, CAST(o_orderkey AS STRING) AS industry_code, CAST(year(o_orderdate) AS INT) AS year,
                 CAST(quarter(o_orderdate) AS INT) AS qtr, CAST(CAST(o_totalprice AS STRING) AS DECIMAL(28,10)) AS total_qtrly_wages,
                 CAST(o_orderdate AS DATE) AS date, c_name AS area_title FROM orders JOIN customer ON o_custkey = c_custkey""")
def legacy_catalog_years(spark, sf):
    """The yearly files of the older catalog's census, one folder a year."""
    entry = LEGACY_DATASETS["qcew"]
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_name").alias("area_title"), F.col("c_custkey").alias("area_fips"), F.col("o_orderkey").alias("industry_code"),
        F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("qtr"), F.col("o_totalprice").alias("total_qtrly_wages"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.year("o_orderdate").alias("y"))
    src, out = scratch_path(spark, "qcew_src"), scratch_path(spark, "qcew_out")
    rows.write.partitionBy("y").option("header", True).csv(src)
    parts = [p for _, p in existing_per_key(spark, src, range(entry.years[0], entry.years[1] + 1), ["{root}/y={year}"])]
    res = load_legacy_dataset(spark, entry.spec, parts, out, f"{out}/_load_log", year_keyed=True)
    return spark.read.parquet(res["location"]).select("area_fips", "industry_code", "year", "qtr", "total_qtrly_wages", "date", "area_title")


# --- headers, compression, bytes ------------------------------------------------------------

@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'series_id_' ELSE 'id_' END || o_orderkey AS series_id, o_custkey AS v, 'series' AS kind FROM orders
          UNION ALL SELECT 'c_custkey_' || c_custkey, c_nationkey, 'list' FROM customer""")
def header_first_line(spark, sf):
    """Files with and without a header whose data lines start like one."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    src = scratch_path(spark, "headers")
    rows = o.select(F.concat(F.when(F.col("o_orderstatus") == "F", F.lit("series_id_")).otherwise(F.lit("id_")), F.col("o_orderkey").cast("string")).alias("series_id"), "o_custkey", "o_orderstatus")
    write_tsv(rows.filter("o_orderstatus = 'F'").drop("o_orderstatus"), f"{src}/with", header=True)
    write_tsv(rows.filter("o_orderstatus <> 'F'").drop("o_orderstatus"), f"{src}/without")
    series = read_series(spark, [f"{src}/with", f"{src}/without"], ["series_id", "v"])
    write_tsv(c.select(F.concat(F.lit("c_custkey_"), F.col("c_custkey").cast("string")).alias("c_custkey"), "c_nationkey"), f"{src}/list", header=True)
    dim = read_dimension_table(spark, f"{src}/list", "c_custkey").toDF("series_id", "v")
    both = series.withColumn("kind", F.lit("series")).union(dim.withColumn("kind", F.lit("list")))
    return both.withColumn("v", F.col("v").cast("bigint"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def gzip_roundtrip(spark, sf):
    path = scratch_path(spark, "gzip")
    c = table(spark, sf, "customer")
    c.select(F.concat_ws("\t", "c_custkey", "c_name", "c_mktsegment").alias("value")).write.option("compression", "gzip").text(path)
    return parse_lines(read_lines(spark, path), ["c_custkey", "c_name", "c_mktsegment"]).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("SELECT c_custkey, c_name || chr(65533) || '!' AS name FROM customer")
def bad_utf8_replaced(spark, sf):
    """A byte that is no UTF-8 becomes U+FFFD."""
    path = scratch_path(spark, "utf8")
    line = F.concat(F.col("c_custkey").cast("string").cast("binary"), F.lit(b"\t"), F.col("c_name").cast("binary"), F.unhex(F.lit("FF21")))
    write_lines(table(spark, sf, "customer").select(line.cast("string").alias("value")), path)
    rows = parse_lines(read_lines(spark, path), ["c_custkey", "name"])
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("""SELECT CAST(sum(strlen(line) + 1) AS BIGINT) AS length, md5(string_agg(line || chr(10), '' ORDER BY c_custkey)) AS md5
          FROM (SELECT c_custkey, c_nationkey, c_mktsegment, c_custkey || chr(9) || c_name AS line FROM customer) GROUP BY c_nationkey, c_mktsegment""")
def file_checksums(spark, sf):
    """A file of customers per nation and segment: its length and checksum."""
    path = scratch_path(spark, "files")
    c = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", "c_custkey", F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    rows = c.repartition("c_nationkey", "c_mktsegment").sortWithinPartitions("c_nationkey", "c_mktsegment", "c_custkey")
    rows.drop("c_custkey").write.partitionBy("c_nationkey", "c_mktsegment").text(path)
    return manifest(spark, path, with_md5=True, glob="part-*").select("length", "md5")


# --- checks, counts and the log --------------------------------------------------------------

@query("""SELECT CAST(count(*) FILTER (WHERE l_extendedprice >= 9999.995) AS BIGINT) AS price_beyond, CAST(0 AS BIGINT) AS tax_beyond FROM lineitem""")
def numeric_range_violations(spark, sf):
    """Values that do not fit NUMERIC(6,2), as texts."""
    li = table(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("string").alias("p"), F.col("l_tax").cast("string").alias("t"))
    return check_constraints(li, {"price_beyond": out_of_range("p", 6, 2), "tax_beyond": out_of_range("t", 6, 2)})


@query("SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY o_orderstatus")
def append_parts(spark, sf):
    """Three appends into one table."""
    path = scratch_path(spark, "appended")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for status in "FOP":
        append(o.filter(F.col("o_orderstatus") == status), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


def _user_log(spark, sf) -> DataFrame:
    """Events below half the largest id as a load log (those above are the new loads)."""
    e = table(spark, sf, "events")
    half = e.select((F.max("event_id") / 2).alias("m")).scalar()
    return _event_log(e.filter(F.col("event_id") < half))


def _event_log(e: DataFrame) -> DataFrame:
    """Events as a load log: users are datasets, errors failed loads, a number from
    the event's id the rows (purchases have none)."""
    rows = F.when(F.col("event_type") != "purchase", F.pmod("event_id", F.lit(100)).cast("int"))
    have = {"dataset": F.col("user_id").cast("string"), "data_key": F.lit("all"), "rows_loaded": rows, "load_timestamp": F.col("ts").cast("timestamp"),
            "status": F.when(F.col("event_type") == "error", "failed").otherwise("success"), "seq": F.col("event_id"),
            "etag": F.when(F.col("event_type") != "view", F.col("event_type")).otherwise(F.lit(""))}
    return e.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields])


_PREVIOUS = """WITH h AS (SELECT max(event_id) / 2 AS m FROM events),
    l AS (SELECT user_id, event_type, CASE WHEN event_type <> 'purchase' THEN event_id % 100 END AS r, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k
          FROM events, h WHERE event_id < m {only}),
    n AS (SELECT user_id, count(*) AS n FROM events, h WHERE event_id >= m GROUP BY user_id)
    SELECT CAST(n.user_id AS STRING) AS dataset, n.n AS new_rows, CAST(r AS BIGINT) AS prev_rows,
           CASE WHEN r IS NULL OR r <= 0 OR event_type = 'error' THEN 'success' WHEN n.n < r * 0.5 THEN 'failed' WHEN n.n < r * 0.9 THEN 'warning' ELSE 'success' END AS verdict,
           CASE WHEN r > 0 THEN round(100.0 * n.n / r, 1) END AS pct_of_prev
    FROM n LEFT JOIN l ON l.user_id = n.user_id AND l.k = 1"""


def _verdicts(spark, sf, rule):
    e = table(spark, sf, "events")
    half = e.select((F.max("event_id") / 2).alias("m")).scalar()
    new = (e.filter(F.col("event_id") >= half).groupBy(F.col("user_id").cast("string").alias("dataset"))
           .agg(F.count("*").alias("rows_loaded")).withColumn("data_key", F.lit("all")))
    got = validate_row_count(new, _user_log(spark, sf), rule=rule)
    return got.select("dataset", "new_rows", F.col("prev_rows").cast("bigint").alias("prev_rows"), "verdict",
                      F.when(F.col("prev_rows") > 0, F.col("pct_of_prev")).cast("double").alias("pct_of_prev"))


@query(_PREVIOUS.format(only="AND event_type <> 'error'"))
def count_rule_last_success(spark, sf):
    return _verdicts(spark, sf, "last_success")


@query(_PREVIOUS.format(only=""))
def count_rule_latest(spark, sf):
    return _verdicts(spark, sf, "latest")


@query("""SELECT row_number() OVER (ORDER BY ts DESC, event_id DESC) AS place, CAST(user_id AS STRING) AS dataset,
                 CASE WHEN event_type <> 'view' THEN event_type ELSE 'N/A' END AS etag FROM events""")
def whole_log_newest_first(spark, sf):
    """All events as a log, in order and numbered, an empty etag shown as N/A; the log is written and read again."""
    path = scratch_path(spark, "log")
    append_log(_event_log(table(spark, sf, "events")), path)
    log = read_log(spark, path)
    shown = log.select("dataset", shown_etag().alias("etag"), (-F.unix_micros("load_timestamp")).alias("newest"), (-F.col("seq")).alias("next"))
    return with_surrogate_id(shown, ["newest", "next"], "place").select("place", "dataset", "etag")


@query("""WITH f AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, year(l_shipdate), month(l_shipdate)),
               n AS (SELECT count(*) AS n FROM f JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P')
          SELECT dataset, status, CASE WHEN status = 'success' THEN n ELSE 0 END AS rows_loaded
          FROM (VALUES ('cpi', 'success'), ('jolts', 'failed'), ('state_metro', 'success')) t(dataset, status), n""")
def failing_dataset_is_isolated(spark, sf):
    """Three loads, the second without its files: its failure is logged, the others load their rows."""
    specs = [DATASETS[k] for k in ("cpi", "jolts", "state_metro")]
    folders = {s.key: _survey_files(spark, sf, s) if s.key != "jolts" else scratch_path(spark, "nothing") for s in specs}
    out = scratch_path(spark, "isolated")
    load_all(spark, specs, folders, out, f"{out}/_load_log")
    return latest_log(read_log(spark, f"{out}/_load_log")).select("dataset", "status", "rows_loaded")

