import datetime as dt

from rawfiles import write_text

from seriesmart.operators.loadlog import HEADS_SCHEMA, read_log
from seriesmart.plans import LegacySpec, load_legacy_dataset, part_keys, yearly_files
from seriesmart.plans.legacy import read_parts_delimited, rows_per_part
from seriesmart.sinks import read_current

SPEC = LegacySpec("la", "unemployment_narrow",
                  (("series_id", "string"), ("year", "int"), ("period", "string"),
                   ("value", "decimal(18,4)"), ("footnote_codes", "string")))


def test_parts_logged_with_their_own_counts(spark, tmp_path):
    p1 = write_text(tmp_path / "la_data_1.tsv", "Series_ID\tYEAR\tperiod\tvalue\n"
                                                "LA1\t2020\tM01\t1.5\nLA1\t2020\tM02\tNA\n")
    p2 = write_text(tmp_path / "la_data_2.csv", '"series_id","year","period","value","footnote_codes"\n'
                                                'LA2,2021,M01,2.25,P\n')
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    r = load_legacy_dataset(spark, SPEC, [p1, p2], out, log)
    assert r["rows"] == 3 and r["parts"] == {"part1": 2, "part2": 1}
    t = read_current(spark, f"{out}/unemployment_narrow")
    assert t.columns == ["series_id", "year", "period", "value", "footnote_codes", "loaded_at"]
    rows = sorted((x["series_id"], x["year"], x["period"], x["value"] and float(x["value"]),
                   x["footnote_codes"]) for x in t.collect())
    assert rows == [("LA1", 2020, "M01", 1.5, None), ("LA1", 2020, "M02", None, None),
                    ("LA2", 2021, "M01", 2.25, "P")]
    got = {x["data_key"]: x["rows_loaded"] for x in read_log(spark, log).collect()}
    assert got == {"part1": 2, "part2": 1}


def test_per_part_download_decision(spark, tmp_path):
    p1 = write_text(tmp_path / "x_data_1.tsv", "series_id\tyear\nA\t2020\n")
    p2 = write_text(tmp_path / "x_data_2.tsv", "series_id\tyear\nB\t2020\nC\t2021\n")
    spec = LegacySpec("x", "x_table", (("series_id", "string"), ("year", "int")), stamp=False)
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    heads = spark.createDataFrame([("x", "part1", "e1", None, None), ("x", "part2", "e1", None, None)],
                                  HEADS_SCHEMA)
    load_legacy_dataset(spark, spec, [p1, p2], out, log, heads)
    heads2 = spark.createDataFrame([("x", "part1", "e1", None, None), ("x", "part2", "e2", None, None)],
                                   HEADS_SCHEMA)
    r = load_legacy_dataset(spark, spec, [p1, p2], out, log, heads2)
    assert r["parts"] == {"part2": 2}
    r3 = load_legacy_dataset(spark, spec, [p1, p2], out, log, heads2)
    assert r3["status"] == "skipped"


def test_yearly_keys_and_listing(spark, tmp_path):
    for y in (2019, 2021):
        write_text(tmp_path / "q" / f"{y}.q1-q4.singlefile.csv", "area_fips,year\n01000,%d\n" % y)
    write_text(tmp_path / "q" / "2020_qtrly_singlefile.csv", "area_fips,year\n01000,2020\n")
    files = yearly_files(spark, str(tmp_path / "q"), range(2018, 2023),
                         ["{root}/{year}.q1-q4.singlefile.csv", "{root}/{year}_qtrly_singlefile.csv"])
    assert [f[-30:].split("/")[-1][:4] for f in files] == ["2019", "2020", "2021"]
    assert part_keys(files, year_keyed=True) == ["2019", "2020", "2021"]
    spec = LegacySpec("qcew", "census_narrow", (("area_fips", "string"), ("year", "int")))
    r = load_legacy_dataset(spark, spec, files, str(tmp_path / "o"), str(tmp_path / "log"), year_keyed=True)
    assert r["parts"] == {"2019": 1, "2020": 1, "2021": 1}
    assert {x["area_fips"] for x in read_current(spark, f"{tmp_path}/o/census_narrow").collect()} == {"01000"}


def test_a_changed_part_keeps_the_others(spark, tmp_path):
    from seriesmart.operators import read_log
    spec = LegacySpec("d", "t", (("id", "int"), ("price", "double")), stamp=False)
    parts = [write_text(tmp_path / "raw" / f"d_data_{i}", "id,price\n" + "".join(f"{i}{k},1\n" for k in range(n))) for i, n in ((1, 60), (2, 40))]
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    heads = lambda e: spark.createDataFrame([("d", "part1", e), ("d", "part2", "b")], "dataset string, data_key string, etag string") \
        .selectExpr("*", "cast(null as timestamp) last_modified", "'u' source_url")
    first = load_legacy_dataset(spark, spec, parts, out, log, heads("a"))
    assert first["parts"] == {"part1": 60, "part2": 40}
    write_text(tmp_path / "raw" / "d_data_1", "price,id\n" + "".join(f"2,1{k}\n" for k in range(50)))
    second = load_legacy_dataset(spark, spec, parts, out, log, heads("a2"))
    assert second["status"] == "warning" and second["parts"] == {"part1": 50}
    got = {(r.id, r.price) for r in spark.read.parquet(second["location"]).collect()}
    assert got == {(int(f"1{k}"), 2.0) for k in range(50)} | {(int(f"2{k}"), 1.0) for k in range(40)}
    # a missing file leaves a failed row
    bad = load_legacy_dataset(spark, spec, [parts[0], str(tmp_path / "none")], out, log, None)
    assert bad["status"] == "failed" and read_log(spark, log).filter("status = 'failed'").count() == 2


def test_headers_and_quotes_by_file(spark, tmp_path):
    from seriesmart.sources.delimited import read_delimited
    a = write_text(tmp_path / "p" / "a b.csv", 'id,"Price",note\n1,30,"a ""b"", c"\n2,40,"C:\\"\n')
    b = write_text(tmp_path / "p" / "b.csv", "PRICE\tid\n3\t30\n")
    got = read_delimited(spark, [a, b], ["id", "price", "note"], {"id": "int", "price": "double"})
    assert {tuple(r) for r in got.collect()} == {(1, 30.0, 'a "b", c'), (2, 40.0, "C:\\"), (30, 3.0, None)}
    c = write_text(tmp_path / "c.csv", 'id,note\n1,"two\nlines"\n')
    assert [r.note for r in read_delimited(spark, c, ["note"], multi_line=True).collect()] == ["two\nlines"]


def test_counts_of_many_parts(spark, tmp_path):
    """500 parts: each counted by its own file, in a plan that doesn't grow with them."""
    parts = [write_text(tmp_path / "in" / f"x_{i} +%.csv", "series_id,year\n" + "".join(f"s{i},{2000 + j}\n" for j in range(i % 5 + 1))) for i in range(500)]
    spec = LegacySpec("x", "x", (("series_id", "string"), ("year", "int")))
    staged = read_parts_delimited(spark, parts, spec)
    small = read_parts_delimited(spark, parts[:5], spec)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString().count("\n")
    assert plan(staged) == plan(small)
    named = list(zip(parts, part_keys(parts)))
    assert rows_per_part(spark, staged, named) == {f"part{i + 1}": i % 5 + 1 for i in range(500)}


def test_counts_of_folders_and_patterns(spark, tmp_path):
    for folder, n in (("a", 3), ("b", 4), ("ab", 5)):
        write_text(tmp_path / folder / "f.csv", "series_id,year\n" + "s,1\n" * n)
    spec = LegacySpec("x", "x", (("series_id", "string"), ("year", "int")))
    named = [(f"file://{tmp_path}/a/", "one"), (f"{tmp_path}/b", "two"), (f"{tmp_path}/a[b]/*.csv", "three")]
    staged = read_parts_delimited(spark, [p for p, _ in named], spec)
    assert rows_per_part(spark, staged, named) == {"one": 3, "two": 4, "three": 5}
