"""Command line: ``python -m seriesmart load|status``.

load:   python -m seriesmart load --datasets cpi,ppi --landing /data/raw --out /data/mart
            --log /data/mart/_load_log [--heads heads.csv] [--force] [--tolerant] [--workers 4]
        Raw files of dataset ``k`` are read from ``<landing>/<k>/`` under their
        catalog names (e.g. ``cu.data.1.AllItems``).  ``--heads`` is a CSV with
        ``dataset,data_key,etag,last_modified,source_url`` (the source tags that
        decide whether a dataset is reloaded).
        ``--shape legacy`` loads the older catalog's header-named files:
        ``<landing>/<k>/<k>_data`` (or ``_1``, ``_2``, ...; one file a year for the
        quarterly census).  ``--shape bulk`` loads each named dataset's fact file as
        it is, ``--shape star`` its code lists, series mapping and mapped facts.
status: python -m seriesmart status --out /data/mart --log /data/mart/_load_log
        Rows per published table and the ten newest log rows.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m seriesmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="load datasets from raw files into validated wide tables")
    ld.add_argument("--datasets", default="all", help="'all' or a comma list of dataset keys")
    ld.add_argument("--landing", required=True, help="folder with one sub-folder of raw files per dataset")
    ld.add_argument("--out", required=True, help="root of the published tables")
    ld.add_argument("--log", required=True, help="path of the load log")
    ld.add_argument("--heads", help="CSV of source tags: dataset,data_key,etag,last_modified,source_url")
    ld.add_argument("--force", action="store_true", help="load even when the source is unchanged")
    ld.add_argument("--tolerant", action="store_true", help="store NULL for unfit values instead of failing")
    ld.add_argument("--workers", type=int, default=1, help="datasets loaded side by side")
    ld.add_argument("--shape", choices=["wide", "legacy", "bulk", "star"], default="wide",
                    help="wide tables (default), the older loader's tables, one bulk table, or the star tables")
    ld.add_argument("--count-rule", choices=["last_success", "latest"], default="last_success",
                    help="the load that a new row count is compared with (wide)")
    st = sub.add_parser("status", help="rows per published table and the newest load-log rows")
    st.add_argument("--out", required=True)
    st.add_argument("--log", required=True)
    for p in (ld, st):
        p.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .operators.loadlog import HEADS_SCHEMA, read_log
    from .plans import load_all, select_datasets, status_report
    from .session import SCALE_CONF, ensure_checkpoint_dir
    from .sinks import current_location

    b = SparkSession.builder.appName("seriesmart")
    if args.master:
        b = b.master(args.master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)

    if args.cmd == "load":
        specs = select_datasets(args.datasets)
        heads = (spark.read.schema(HEADS_SCHEMA).option("header", True).csv(args.heads)
                 if args.heads else None)
        landing = args.landing.rstrip("/")
        if args.shape != "wide":
            return _load_shape(spark, args, specs, landing, heads)
        folders = {s.key: f"{landing}/{s.key}" for s in specs}
        results = load_all(spark, specs, folders, args.out, args.log, workers=args.workers,
                           heads=heads, force=args.force, count_rule=args.count_rule,
                           mode="tolerant" if args.tolerant else "strict")
        for r in results:
            print(f"{r.dataset:18s} {r.status:8s} rows={r.rows} skipped_lines={r.skipped_lines} "
                  f"{'' if not r.message else r.message.splitlines()[0]}")
        return 0 if all(r.status != "failed" for r in results) else 1

    from .plans import DATASETS
    tables = {}
    for s in DATASETS.values():
        loc = current_location(spark, f"{args.out.rstrip('/')}/{s.table}")
        if loc:
            tables[s.table] = spark.read.parquet(loc)
    counts, recent = status_report(tables, read_log(spark, args.log)) if tables else (None, None)
    if counts is not None:
        counts.show(truncate=False)
    (recent if recent is not None else read_log(spark, args.log)).show(10, truncate=False)
    return 0


def _load_shape(spark, args, specs, landing: str, heads) -> int:
    """The loads of the other shapes; 1 when any failed."""
    from .plans import StarDim, StarSpec, load_bulk_dataset, load_legacy_dataset, load_star_dataset, yearly_files
    from .plans.legacy_specs import part_names, select_legacy, year_patterns
    found: dict[str, tuple] = {}
    if args.shape == "legacy":
        for e in select_legacy(args.datasets):
            folder = f"{landing}/{e.key}"
            try:
                parts = (yearly_files(spark, folder, range(e.years[0], e.years[1] + 1), year_patterns(e.key))
                         if e.years else part_names(e, folder))
                r = load_legacy_dataset(spark, e.spec, parts, args.out, args.log, heads, args.force, bool(e.years))
                found[e.key] = r["status"], r.get("rows"), r.get("message")
            except Exception as x:  # one dataset's failure does not stop the others
                found[e.key] = "failed", 0, str(x)
    for s in specs if args.shape == "bulk" else ():
        r = load_bulk_dataset(spark, s.key, f"{landing}/{s.key}/{s.data_file}", s.fact_columns, args.out, f"{s.table}_bulk",
                              args.log, heads, args.force)
        found[s.key] = ("skipped", None, None) if r == "skipped" else (r.status, r.rows, r.message)
    for s in specs if args.shape == "star" else ():
        dims = tuple(StarDim(k, f, f"{s.key}_{k}") for k, f in s.dimension_files.items())
        star = StarSpec(s.key, s.data_file, f"{s.key}_fact", dims, s.series_file)
        for name, r in load_star_dataset(spark, star, f"{landing}/{s.key}", args.out, args.log, heads, args.force).items():
            found[name] = ("skipped", None, None) if r == "skipped" else (r.status, r.rows, r.message)
    for name, (status, rows, message) in found.items():
        print(f"{name:28s} {status:8s} rows={rows} {'' if not message else message.splitlines()[0]}")
    return int(any(status == "failed" for status, _, _ in found.values()))


if __name__ == "__main__":
    sys.exit(main())
