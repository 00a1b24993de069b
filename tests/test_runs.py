import datetime as dt

from pyspark.sql import functions as F
from test_wide_tables import make_files

from seriesmart.functions import cast_value
from seriesmart.operators import failed_loads, full_log, log_rows
from seriesmart.plans import DATASETS, DatasetPaths, load_all, read_inputs, select_datasets, status_report
from seriesmart.plans.wide import wide_table
from seriesmart.streaming import freeze_static, stream_ingest


def test_select_datasets():
    assert len(select_datasets("all")) == 10 and len(select_datasets(None)) == 10
    assert [s.key for s in select_datasets(" CPI, ppi ,nope")] == ["cpi", "ppi"]
    assert [s.key for s in select_datasets(["jolts", "ALL"])] == list(DATASETS)


def test_one_failure_does_not_stop_the_others(spark, tmp_path):
    good, bad = DATASETS["productivity"], DATASETS["jolts"]
    make_files(str(tmp_path / "good"), good)
    make_files(str(tmp_path / "bad"), bad)
    series_path = f"{tmp_path}/bad/{bad.series_file}"
    first_row = open(series_path).read().splitlines()[1]
    with open(series_path, "a") as fh:
        fh.write(first_row + "\n")                # duplicate series id: the load fails
    log = str(tmp_path / "log")
    res = load_all(spark, [bad, good], {"jolts": str(tmp_path / "bad"), "productivity": str(tmp_path / "good")},
                   str(tmp_path / "out"), log, workers=2)
    assert [(r.dataset, r.status) for r in res] == [("jolts", "failed"), ("productivity", "success")]
    # productivity is chunked by 10 years: 2019-2021 form one chunk of 60 rows
    assert res[1].chunks == [(2019, 2021, 60, 60)]
    from seriesmart.operators.loadlog import read_log
    lg = read_log(spark, log)
    assert [r["dataset"] for r in failed_loads(lg).collect()] == ["jolts"]
    counts, recent = status_report({"mp_data": spark.read.parquet(res[1].location)}, lg)
    assert counts.collect()[0]["rows"] == 60
    assert sorted(r["dataset"] for r in recent.collect()) == ["jolts", "productivity"]
    assert full_log(lg).count() == 2


def test_stream_into_wide_rows(spark, tmp_path):
    """Fact files landing one by one become wide rows, joined to the series
    and code lists through the same plan as the batch load."""
    spec = DATASETS["unemployment"]
    src = str(tmp_path / "src")
    make_files(src, spec)
    _, series, dims = read_inputs(spark, spec, DatasetPaths.in_folder(src, spec))
    names = list(dims)
    series, *frozen = freeze_static(series, *[dims[k] for k in names])
    dims = dict(zip(names, frozen))
    land, out, ck = (str(tmp_path / x) for x in ("land", "out", "ck"))
    lines = open(f"{src}/{spec.data_file}").read().splitlines()
    import os
    os.makedirs(land)
    open(f"{land}/a.txt", "w").write("\n".join(lines[:31]) + "\n")

    def shape(facts):
        facts = facts.withColumn("year", cast_value("year", "int"))
        return wide_table(facts, series, dims, spec, with_id=False)

    stream_ingest(spark, land, spec.fact_columns, out, ck, transform=shape)
    first = spark.read.parquet(out).count()
    open(f"{land}/b.txt", "w").write("\n".join(lines[31:]) + "\n")
    stream_ingest(spark, land, spec.fact_columns, out, ck, transform=shape)
    got = spark.read.parquet(out)
    assert got.count() == 60 and 0 < first < 60
    assert got.filter(F.col("area_name").isNotNull()).count() > 0
