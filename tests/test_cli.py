from test_wide_tables import make_files

from seriesmart.__main__ import main
from seriesmart.plans import DATASETS


def test_cli_load_and_status(spark, tmp_path, capsys):
    spec = DATASETS["productivity"]
    make_files(str(tmp_path / "raw" / spec.key), spec)
    out, log = str(tmp_path / "mart"), str(tmp_path / "mart" / "_log")
    heads = tmp_path / "heads.csv"
    heads.write_text("dataset,data_key,etag,last_modified,source_url\nproductivity,all,e1,,\n")
    args = ["load", "--datasets", "productivity", "--landing", str(tmp_path / "raw"), "--out", out,
            "--log", log, "--heads", str(heads)]
    assert main(args) == 0
    assert "productivity       success  rows=60" in capsys.readouterr().out
    assert main(args) == 0
    assert "skipped" in capsys.readouterr().out
    assert main(["status", "--out", out, "--log", log]) == 0
    text = capsys.readouterr().out
    assert "mp_data" in text and "productivity" in text


def test_cli_other_shapes(spark, tmp_path, capsys):
    from rawfiles import write_text
    from seriesmart.sinks import read_current
    raw, out, log = str(tmp_path / "raw"), str(tmp_path / "mart"), str(tmp_path / "mart" / "_log")
    head = "series_id\tyear\tperiod\tvalue\tfootnote_codes\n"
    write_text(tmp_path / "raw" / "la" / "la_data_1", head + "A\t2020\tM01\t1.5\t\n")
    write_text(tmp_path / "raw" / "la" / "la_data_2", head + "B\t2020\tM01\t2.5\tP\nC\t2021\tM01\tNA\t\n")
    write_text(tmp_path / "raw" / "qcew" / "2001.csv", '"area_fips","year","qtr","qtrly_estabs"\n"01000",2001,1,5\n')
    write_text(tmp_path / "raw" / "qcew" / "2002.csv", '"year","area_fips"\n2002,"02000"\n')
    base = ["load", "--landing", raw, "--out", out, "--log", log]
    assert main([*base, "--shape", "legacy", "--datasets", "la,qcew"]) == 0
    assert "rows=3" in capsys.readouterr().out
    assert {(r.series_id, r.year) for r in read_current(spark, f"{out}/unemployment_narrow").collect()} == {("A", 2020), ("B", 2020), ("C", 2021)}
    assert {(r.area_fips, r.year, r.qtrly_estabs) for r in read_current(spark, f"{out}/qcew_narrow").collect()} == {("01000", 2001, 5), ("02000", 2002, None)}
    assert main([*base, "--shape", "legacy", "--datasets", "wp"]) == 1  # no files
    spec = DATASETS["cpi"]
    make_files(f"{raw}/cpi", spec)
    assert main([*base, "--shape", "bulk", "--datasets", "cpi"]) == 0
    for k, f in spec.dimension_files.items():
        write_text(tmp_path / "raw" / "cpi" / f, f"{k}_code\t{k}_name\n1\tOne\n")
    assert main([*base, "--shape", "star", "--datasets", "cpi"]) == 0
    assert "cpi_fact" in capsys.readouterr().out


def test_legacy_catalog():
    from seriesmart.plans.legacy_specs import LEGACY_DATASETS, select_legacy
    assert len(LEGACY_DATASETS) == 13 and len(select_legacy("all")) == 13
    assert len(LEGACY_DATASETS["qcew"].spec.columns) == 53
    assert [e.key for e in select_legacy("mp, cu,none")] == ["cu", "mp"]
