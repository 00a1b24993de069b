import datetime as dt

from rawfiles import write_text

from seriesmart.operators.loadlog import HEADS_SCHEMA, read_log
from seriesmart.plans import StarDim, StarSpec, load_bulk_dataset, load_star_dataset
from seriesmart.sinks import read_current

SPEC = StarSpec(key="cu", data_file="cu.data", fact_table="cu_fact",
                dims=(StarDim("area", "cu.area", "cu_area"),
                      StarDim("item", "cu.item", "cu_item", ("item_code", "item_name"))),
                series_file="cu.series")


def _files(root):
    write_text(f"{root}/cu.area", "area_code\tarea_name\nA1\tNorth\nA2\t-\n")
    write_text(f"{root}/cu.item", "item_code\titem_name\textra\nI1\tFood\tx\n")
    write_text(f"{root}/cu.series", "series_id\tarea_code\titem_code\tseasonal\n"
                                    "S1\tA1\tI1\tS\nS2\tA2\tI1\nS3\t\tI1\tU\n")
    write_text(f"{root}/cu.data", "series_id\tyear\tperiod\tvalue\n"
                                  "S1\t2020\tM01\t1.5\nS1\t2020\tM02\t-\nS2\t\tM01\t2\n"
                                  "S3\t2020\tM01\t3\nS9\t2020\tM01\t4\nshort\t2020\n")


def heads(spark, tag):
    rows = [(k, "all", tag, dt.datetime(2024, 1, 1), None) for k in ("cu_area", "cu_item", "cu_fact")]
    return spark.createDataFrame(rows, HEADS_SCHEMA)


def test_star_load(spark, tmp_path):
    src, out, log = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "log")
    _files(src)
    r = load_star_dataset(spark, SPEC, src, out, log, heads(spark, "e1"))
    assert r["cu_area"].rows == 2 and r["cu_item"].rows == 1
    fact = r["cu_fact"]
    # S3 has an empty area code -> not mapped; S9 has no series; the short line is skipped
    assert fact.rows == 3 and fact.metrics["unmapped"] == 2
    got = sorted(tuple(x) for x in read_current(spark, f"{out}/cu_fact").collect())
    assert got == [("S1", "A1", "I1", "S", 2020, "M01", 1.5), ("S1", "A1", "I1", "S", 2020, "M02", None),
                   ("S2", "A2", "I1", None, None, "M01", 2.0)]
    area = sorted(tuple(x) for x in read_current(spark, f"{out}/cu_area").collect())
    assert area == [("A1", "North"), ("A2", None)]
    assert read_current(spark, f"{out}/cu_item").columns == ["item_code", "item_name"]
    # unchanged etags: everything skipped
    r2 = load_star_dataset(spark, SPEC, src, out, log, heads(spark, "e1"))
    assert r2 == {"cu_area": "skipped", "cu_item": "skipped", "cu_fact": "skipped"}
    assert read_log(spark, log).count() == 3


def test_bulk_load(spark, tmp_path):
    p = write_text(tmp_path / "data.tsv", "series_id\tyear\tvalue\nB1\t2020\t1\nB2\t2021\t-\nB3\nB4\t2022\t4\nB5\t2023\t5\n")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    r = load_bulk_dataset(spark, "bulk", str(p), ["series_id", "year", "value"], out, "bulk_data", log)
    assert r.status == "success" and r.rows == 4
    assert sorted(tuple(x) for x in read_current(spark, f"{out}/bulk_data").collect()) == [
        ("B1", "2020", "1"), ("B2", "2021", None), ("B4", "2022", "4"), ("B5", "2023", "5")]
    write_text(tmp_path / "data.tsv", "B1\t2020\t1\n")
    r2 = load_bulk_dataset(spark, "bulk", str(p), ["series_id", "year", "value"], out, "bulk_data", log)
    assert r2.status == "failed" and read_current(spark, f"{out}/bulk_data").count() == 4
