"""The older loader's shape: header-named CSV/TSV parts into narrow tables.

A dataset is one or more part files (``{key}_data_1..n`` or one file; the
yearly census has one file per year).  Every part gets its own download
decision and its own log row with *its own* row count; when one changed, all
parts are read (one scan per distinct header) and staged with their source
file.  Rows are counted by file on the staged rows, the files joined to the
parts; a version is written only from staged rows whose counts hold.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.loadlog import append_log, empty_log, log_rows, read_log, should_download
from ..operators.quality import verdict_of
from ..operators.latest import latest_per_key
from ..sinks.writers import WriteResult, publish_full_refresh
from ..sources.delimited import read_delimited
from ..sources.files import existing_per_key, plain_path, wanted_paths, with_folders
from ..sources.heads import listing
from ..session import stored


@dataclass(frozen=True)
class LegacySpec:
    key: str
    table: str
    columns: tuple          # (name, type) in table order; types are Spark DDL types
    stamp: bool = True      # add loaded_at


def part_keys(parts: Sequence[str], year_keyed: bool = False) -> list[str]:
    """Log keys of the parts: ``all`` for one part, ``part1..n`` for several,
    or the year for yearly files (taken from the file name)."""
    if year_keyed:
        out = []
        for p in parts:
            m = re.search(r"(19|20)\d{2}", os.path.basename(p.rstrip("/")))
            out.append(m.group(0) if m else os.path.basename(p))
        return out
    return ["all"] if len(parts) == 1 else [f"part{i + 1}" for i in range(len(parts))]


def read_parts_delimited(spark: SparkSession, parts: Sequence[str], spec: LegacySpec) -> DataFrame:
    """All parts, each file by its own header and delimiter, with ``_file``."""
    df = read_delimited(spark, list(parts), [n for n, _ in spec.columns], dict(spec.columns), with_file=True)
    return df.withColumn("loaded_at", F.current_timestamp()) if spec.stamp else df


def rows_per_part(spark: SparkSession, staged: DataFrame, named: Sequence[tuple[str, str]]) -> dict[str, int]:
    """Rows of each part ``(path, key)``: staged rows counted by source file, and
    each file joined to the part that names it or one of its folders (a pattern
    with wildcards is listed first)."""
    parts = [(k, p) for p, k in named if not re.search(r"[*?\[{]", p)]
    wanted = wanted_paths(spark, parts, "key string, path string").select("key", "above")
    for p, k in named:
        if re.search(r"[*?\[{]", p):
            wanted = wanted.union(listing(spark, p).select(F.lit(k), plain_path("path")))
    counts = staged.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("n"))
    files = with_folders(listing(spark, [p for p, _ in named]).distinct().join(counts, "file"))
    per_file = files.join(wanted, "above").groupBy("file", "key").agg(F.max("n").alias("n"))
    return {r["key"]: r["n"] for r in per_file.groupBy("key").agg(F.sum("n").alias("n")).collect()}


def load_legacy_dataset(spark: SparkSession, spec: LegacySpec, parts: Sequence[str], out_root: str,
                        log_path: str | None = None, heads: DataFrame | None = None,
                        force: bool = False, year_keyed: bool = False) -> dict:
    """Decide per part; when any part changed, load *all* parts into a new
    version (a published table always holds every part), log the changed ones.

    Each part's count is validated against its own last successful one (``force``
    accepts any).  An error leaves a ``failed`` row for every part to load."""
    log = read_log(spark, log_path) if log_path else empty_log(spark)
    named = list(zip(parts, part_keys(parts, year_keyed)))
    decided: Mapping[str, object] = {}
    todo = named
    if heads is not None:
        h = heads.filter(F.col("dataset") == spec.key)
        decided = {r["data_key"]: r for r in should_download(h, log).collect()}
        todo = [(p, k) for p, k in named if force or k not in decided or decided[k]["download"]]
    if not todo:
        return {"status": "skipped", "parts": {}}

    def entries(status: str, counts: Mapping[str, int], message: str | None, location: str | None) -> None:
        if not log_path:
            return
        rows = []
        for p, k in todo:
            e = {"dataset": spec.key, "data_key": k, "rows_loaded": counts.get(k, 0), "status": status,
                 "error_message": message, "location": location, "source_url": p}
            if k in decided:
                e.update(etag=decided[k]["etag"], last_modified=decided[k]["last_modified"])
            rows.append(e)
        append_log(log_rows(spark, rows), log_path)

    try:
        ok = log.filter((F.col("dataset") == spec.key) & (F.col("status") == "success"))
        last = {r["data_key"]: r["rows_loaded"] for r in
                latest_per_key(ok, ["data_key"], ["load_timestamp", "seq"], ["rows_loaded"]).collect()}
        staged = stored(read_parts_delimited(spark, parts, spec), spark, f"staged_{spec.key}")
        found = rows_per_part(spark, staged, named)
        verdicts = {k: "success" if force else verdict_of(found.get(k, 0), last.get(k)) for _, k in todo}
        worst = max(verdicts.values(), key=("success", "warning", "failed").index)
        text = ", ".join(f"{k}: {found.get(k, 0)} rows against {last[k]} before" for k, v in verdicts.items() if v != "success")
        if worst == "failed":
            res = WriteResult(None, sum(found.values()), "failed", text)
        else:
            res = publish_full_refresh(staged.drop("_file"), f"{out_root.rstrip('/')}/{spec.table}", lambda rows: (worst, text or None))
    except Exception as e:
        entries("failed", {}, str(e), None)
        return {"status": "failed", "rows": 0, "location": None, "parts": {}, "message": str(e)}
    status = "failed" if res.status == "failed" else "success"
    entries(status, found, res.message, res.location if status == "success" else None)
    return {"status": res.status, "rows": res.rows, "location": res.location,
            "parts": {k: found.get(k, 0) for _, k in todo}, "message": res.message}


def yearly_files(spark: SparkSession, root: str, years, patterns: Sequence[str]) -> list[str]:
    """For each year the first pattern that names an existing file or folder."""
    return [p for _, p in existing_per_key(spark, root, years, patterns)]
