"""D1-D10 end to end on synthetic survey files, against a brute-force expectation."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from rawfiles import write_text
from pyspark.sql import functions as F

from seriesmart.functions import PERIOD_LABELS
from seriesmart.operators import Lookup, denormalize, log_rows
from seriesmart.operators.loadlog import HEADS_SCHEMA, read_log
from seriesmart.plans import DATASETS, DatasetPaths, load_dataset, read_inputs, wide_table
from seriesmart.sinks import read_current

PERIODS = ["M01", "M02", "M13", "Q01", "X99"]
YEARS = [2019, 2020, 2021]


def make_files(root, spec):
    """Series, fact and code-list files for one dataset; returns the rows as dicts."""
    series = []
    for i in range(4):
        sid = f"{spec.key[:2].upper()}{'S' if i % 2 else 'U'}{i:05d}"
        row = {"series_id": sid}
        for c in spec.series_columns[1:]:
            if c == "seasonal" or c == "seasonal_code":
                row[c] = "S" if i % 2 else "U"
            elif c.endswith("_code"):
                row[c] = "ZZ" if i == 3 else f"0{i % 2}"
            else:
                row[c] = f"{c}-{i}"
        series.append(row)
    lines = ["\t".join(spec.series_columns)]
    lines += ["\t".join(r[c] for c in spec.series_columns) for r in series]
    write_text(f"{root}/{spec.series_file}", "\n".join(lines) + "\n")

    dims = {}
    for d, fname in spec.dimension_files.items():
        if d == "seasonal":
            m = {"S": "Seasonally Adjusted", "U": "Not Seasonally Adjusted"}
        elif d == "period":
            m = {"M01": "JAN", "M02": "FEB", "Q01": "QTR1"}
        else:
            m = {"00": f"{d} zero", "01": f"{d} one"}
        dims[d] = m
        body = "code\tname\r\n" + "".join(f"{k}\t{v}\r\n" for k, v in m.items())
        write_text(f"{root}/{fname}", body)

    facts = []
    n = 0
    for s in series + [{"series_id": "NOSERIES"}]:
        for y in YEARS:
            for p in PERIODS:
                n += 1
                facts.append({"series_id": s["series_id"], "year": y, "period": p,
                              "value": f"{n}.{n % 1000:03d}5", "footnote_codes": "P" if n % 3 else "-"})
    cols = spec.fact_columns
    body = "\t".join(cols) + "\n" + "".join(
        "\t".join(str(f[c]) for c in cols) + "\n" for f in facts)
    write_text(f"{root}/{spec.data_file}", body)
    return series, facts, dims


def expected_rows(spec, series, facts, dims):
    by_id = {s["series_id"]: s for s in series}
    scale = int(spec.value_type.split(",")[1].rstrip(")"))
    out = []
    for f in facts:
        s = by_id.get(f["series_id"])
        if s is None:
            continue
        row = {"series_id": f["series_id"], "year": f["year"], "period": f["period"],
               "value": Decimal(f["value"]).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)}
        if "footnote_codes" in spec.fact_columns:
            row["footnote_codes"] = None if f["footnote_codes"] == "-" else f["footnote_codes"]
        if spec.period_name == "lookup":
            row["period_name"] = dims["period"].get(f["period"])
        else:
            row["period_name"] = PERIOD_LABELS.get(f["period"], f["period"])

        def code(expr):
            if expr.startswith("substring"):
                return f["series_id"][2]
            if expr.startswith("CASE"):
                return {"S": "Seasonally Adjusted", "U": "Not Seasonally Adjusted"}.get(s["seasonal"])
            return s[expr]

        for lk in spec.lookups:
            if lk.dim == "period":
                continue
            k = code(lk.key_sql) if lk.key_sql else s[lk.key]
            row[lk.name_out] = dims[lk.dim].get(k)
        for name, _, _ in spec.columns:
            if name in spec.code_from:
                row[name] = code(spec.code_from[name])
            elif name not in row:
                row[name] = s.get(name)
        out.append(tuple(row[n] for n, _, _ in spec.columns))
    return sorted(out, key=repr)


@pytest.mark.parametrize("key", sorted(DATASETS))
def test_wide_table(spark, tmp_path, key):
    spec = DATASETS[key]
    series, facts, dims = make_files(str(tmp_path), spec)
    f, s, d = read_inputs(spark, spec, DatasetPaths.in_folder(str(tmp_path), spec))
    got = wide_table(f, s, d, spec, with_id=False)
    assert got.columns == list(spec.output_names)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == expected_rows(spec, series, facts, dims)
    assert len(rows) == 4 * len(YEARS) * len(PERIODS)


def test_cpi_surrogate_id(spark, tmp_path):
    spec = DATASETS["cpi"]
    make_files(str(tmp_path), spec)
    f, s, d = read_inputs(spark, spec, DatasetPaths.in_folder(str(tmp_path), spec))
    got = wide_table(f, s, d, spec).collect()
    assert [r["id"] for r in got] == list(range(1, len(got) + 1)) or \
        sorted(r["id"] for r in got) == list(range(1, len(got) + 1))
    ordered = sorted(got, key=lambda r: r["id"])
    keys = [(r["series_id"], r["year"], r["period"]) for r in ordered]
    assert keys == sorted(keys)


def test_denormalize_order_property(spark):
    """Lookups joined to the series first == every lookup joined to the joined rows."""
    import random
    rnd = random.Random(7)
    facts = spark.createDataFrame([(rnd.randint(0, 30), rnd.choice("abcd"), i) for i in range(400)],
                                  "sid int, p string, v int")
    series = spark.createDataFrame([(i, rnd.choice([None, "x", "y", "z"]), rnd.randint(0, 5))
                                    for i in range(25)], "sid int, c1 string, c2 int")
    dims = {"d1": spark.createDataFrame([("x", "X"), ("y", "Y")], "code string, name string"),
            "d2": spark.createDataFrame([(i, f"n{i}") for i in range(4)], "code int, name string"),
            "dp": spark.createDataFrame([("a", "A"), ("c", "C")], "code string, name string")}
    lks = [Lookup("d1", "n1", key="c1"), Lookup("d2", "n2", key="c2"), Lookup("dp", "np", key="p", on="fact")]
    got = sorted(tuple(r) for r in denormalize(facts, series, dims, lks, "sid",
                                               select=["sid", "v", "n1", "n2", "np"]).collect())
    naive = (facts.join(series, "sid")
             .join(dims["d1"].withColumnRenamed("name", "n1"), F.col("c1") == F.col("code"), "left").drop("code")
             .join(dims["d2"].withColumnRenamed("name", "n2"), F.col("c2") == F.col("code"), "left").drop("code")
             .join(dims["dp"].withColumnRenamed("name", "np"), F.col("p") == F.col("code"), "left").drop("code")
             .select("sid", "v", "n1", "n2", "np"))
    assert got == sorted(tuple(r) for r in naive.collect())
    # also when nothing is broadcast (the shuffled plan)
    got2 = sorted(tuple(r) for r in denormalize(facts, series, dims, lks, "sid", max_rows=0,
                                                select=["sid", "v", "n1", "n2", "np"]).collect())
    assert got2 == got


def _heads(spark, key, etag):
    return spark.createDataFrame([(key, "all", etag, dt.datetime(2024, 5, 1), f"src/{key}")], HEADS_SCHEMA)


def test_load_lifecycle(spark, tmp_path):
    spec = DATASETS["unemployment"]
    src = str(tmp_path / "src")
    make_files(src, spec)
    out, log_path = str(tmp_path / "out"), str(tmp_path / "log")
    paths = DatasetPaths.in_folder(src, spec)

    r1 = load_dataset(spark, spec, paths, out, log_path, heads=_heads(spark, spec.key, "e1"))
    assert r1.status == "success" and r1.rows == 60 and r1.skipped_lines == 0
    # the fact file has 15 rows of a series that does not exist
    assert r1.violations["orphan_facts"] == 15 and r1.violations["bad_values"] == 0
    assert "duplicate_keys" not in r1.violations
    assert read_current(spark, f"{out}/la_data").count() == 60

    # same etag: nothing to do
    r2 = load_dataset(spark, spec, paths, out, log_path, heads=_heads(spark, spec.key, "e1"))
    assert r2.status == "skipped"

    # a truncated fact file: below half of the last success -> failed, not published
    lines = open(f"{src}/{spec.data_file}").read().splitlines()
    write_text(f"{src}/{spec.data_file}", "\n".join(lines[:20]) + "\n")
    r3 = load_dataset(spark, spec, paths, out, log_path, heads=_heads(spark, spec.key, "e2"))
    assert r3.status == "failed" and r3.rows < 30
    assert read_current(spark, f"{out}/la_data").count() == 60

    # a text value in strict mode fails the load; the log says why
    write_text(f"{src}/{spec.data_file}", "\n".join(lines + ["UNU00000\t2022\tM01\tabc\t"]) + "\n")
    r4 = load_dataset(spark, spec, paths, out, log_path, heads=_heads(spark, spec.key, "e3"))
    assert r4.status == "failed" and "cannot cast" in r4.message
    log = read_log(spark, log_path)
    assert [r["status"] for r in log.orderBy("seq").collect()] == ["success", "failed", "failed"]

    # tolerant mode loads it with a NULL value
    r5 = load_dataset(spark, spec, paths, out, log_path, heads=_heads(spark, spec.key, "e3"),
                      mode="tolerant")
    assert r5.status == "success" and r5.rows == 61 and r5.violations["bad_values"] == 1


def test_null_year_policies(spark, tmp_path):
    for key, expect in (("cpi", "kept"), ("unemployment", "dropped"), ("ppi", "error")):
        spec = DATASETS[key]
        root = str(tmp_path / key)
        make_files(root, spec)
        p = f"{root}/{spec.data_file}"
        with open(p, "a") as fh:
            fh.write("\t".join([f"{spec.key[:2].upper()}U00000", "", "M01", "1"] +
                               ([""] if len(spec.fact_columns) == 5 else [])) + "\n")
        f, s, d = read_inputs(spark, spec, DatasetPaths.in_folder(root, spec))
        w = wide_table(f, s, d, spec, with_id=False)
        if expect == "error":
            with pytest.raises(Exception, match="NULL year"):
                w.collect()
        else:
            n = w.filter(F.col("year").isNull()).count()
            assert n == (1 if expect == "kept" else 0)


def test_empty_fact_and_duplicate_series_fail(spark, tmp_path):
    spec = DATASETS["employment"]
    make_files(str(tmp_path), spec)
    paths = DatasetPaths.in_folder(str(tmp_path), spec)
    write_text(f"{tmp_path}/{spec.data_file}", "series_id\tyear\tperiod\tvalue\tfootnote_codes\n")
    r = load_dataset(spark, spec, paths, str(tmp_path / "o"))
    assert r.status == "failed" and "empty fact" in r.message
    make_files(str(tmp_path), spec)
    with open(f"{tmp_path}/{spec.series_file}", "a") as fh:
        fh.write("EMU00000\t01\t01\t01\tU\n")
    r = load_dataset(spark, spec, paths, str(tmp_path / "o"))
    assert r.status == "failed" and "duplicate series_id" in r.message


def test_strict_load_rejects_key_and_length_violations(spark, tmp_path):
    spec = DATASETS["state_metro"]
    src = str(tmp_path / "src")
    make_files(src, spec)
    paths = DatasetPaths.in_folder(src, spec)
    fact = f"{src}/{spec.data_file}"
    lines = open(fact).read().splitlines()
    write_text(fact, "\n".join(lines + [lines[1]]) + "\n")          # a repeated observation
    r = load_dataset(spark, spec, paths, str(tmp_path / "o"))
    assert r.status == "failed" and "duplicate primary key" in r.message
    r2 = load_dataset(spark, spec, paths, str(tmp_path / "o2"), mode="tolerant")
    assert r2.status == "success" and r2.violations["duplicate_keys"] == 1
    write_text(fact, "\n".join(lines + ["STU00000\t2024\tM01\t1\tTOO_LONG_FOOTNOTE"]) + "\n")
    r3 = load_dataset(spark, spec, paths, str(tmp_path / "o3"))
    assert r3.status == "failed" and "long_footnote_codes" in r3.message


def test_dimension_columns_per_spec(spark, tmp_path):
    import dataclasses
    spec = dataclasses.replace(DATASETS["productivity"], dim_columns={"sector": (1, 2)})
    src = str(tmp_path / "src")
    make_files(src, spec)
    # a sector file whose code is the second column
    write_text(f"{src}/{spec.dimension_files['sector']}", "sort\tcode\ttext\n9\t00\tSector zero\n")
    f, s, d = read_inputs(spark, spec, DatasetPaths.in_folder(src, spec))
    got = {r["sector_code"]: r["sector_name"] for r in wide_table(f, s, d, spec).collect()}
    assert got["00"] == "Sector zero" and got.get("01") is None


def test_year_range_load(spark, tmp_path):
    spec = DATASETS["jolts"]
    make_files(str(tmp_path), spec)
    f, s, d = read_inputs(spark, spec, DatasetPaths.in_folder(str(tmp_path), spec))
    got = wide_table(f, s, d, spec, years=(2020, 2021))
    assert sorted({r["year"] for r in got.collect()}) == [2020, 2021]
    assert got.count() == 4 * 2 * len(PERIODS)


def test_load_moves_codes_not_names(spark, tmp_path, monkeypatch):
    """Rows are dealt, sorted and numbered before they get the names of counted code lists; files stay sorted."""
    import glob

    import pyarrow.parquet as pq
    from seriesmart.plans import wide
    for key in ("cpi", "unemployment"):
        spec = DATASETS[key]
        src, out = str(tmp_path / key), str(tmp_path / f"{key}_out")
        series, facts, dims = make_files(src, spec)
        with open(f"{src}/{spec.data_file}") as fh:
            head, *lines = fh.read().splitlines()
        write_text(f"{src}/{spec.data_file}", "\n".join([head, *sorted(lines, key=lambda x: x[::-1])]) + "\n")
        numbered, of = [], wide.with_surrogate_id
        monkeypatch.setattr(wide, "with_surrogate_id", lambda df, *a: numbered.append(df.columns) or of(df, *a))
        placed, denormalize_of = [], wide.denormalize
        monkeypatch.setattr(wide, "denormalize", lambda *a, place=None, **kw: denormalize_of(
            *a, place=lambda rows: placed.append(rows.columns) or place(rows), **kw))
        res = load_dataset(spark, spec, DatasetPaths.in_folder(src, spec), out)
        monkeypatch.undo()
        assert res.status == "success"
        assert not [c for c in placed[0] if c.endswith("_name") or c.endswith("_text")]
        assert len(numbered) == (1 if spec.surrogate_id else 0) and all("area_name" not in c for c in numbered)
        got = spark.read.parquet(res.location).select(*spec.output_names)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_rows(spec, series, facts, dims)
        if not spec.surrogate_id:
            for f in glob.glob(f"{res.location}/year=*/*.parquet"):
                keys = [tuple(r.values()) for r in pq.ParquetFile(f).read(["series_id", "period"]).to_pylist()]
                assert keys == sorted(keys)


def test_repeated_keys_by_hash(spark, monkeypatch):
    from seriesmart.operators import has_duplicates, quality
    compared, of = [], quality.check_unique
    monkeypatch.setattr(quality, "check_unique", lambda df, keys, *a: compared.append(list(keys)) or of(df, keys, *a))
    rows = [("a", None), (None, "a"), ("b", "c")]      # the hash passes nulls over: the first two share theirs
    assert not has_duplicates(spark.createDataFrame(rows, "x string, y string"), ["x", "y"])
    assert has_duplicates(spark.createDataFrame([*rows, (None, "a")], "x string, y string"), ["x", "y"])
    compared.clear()
    assert not has_duplicates(spark.createDataFrame([("a", "b"), ("b", "a")], "x string, y string"), ["x", "y"])
    assert compared == [["_h"]]


def test_fields_are_counted_by_tabs(spark):
    from seriesmart.sources import count_skipped, parse_lines
    lines = spark.createDataFrame([(x,) for x in ("a\tb\tc", " a \tb\t", "a\tb", "", " \t \t ", "\ta\t b \t", None, "é\té \t-")], "value string")
    assert tuple(count_skipped(lines, 3).first()) == (4, 1)
    assert tuple(count_skipped(lines, 1).first()) == (5, 0)
    got = sorted((tuple(r) for r in parse_lines(lines, ["x", "y", "z"]).collect()), key=repr)
    assert got == sorted([("a", "b", "c"), ("a", "b", None), (None, "a", "b"), ("é", "é", None)], key=repr)
