"""Decision tables, enumerated completely (FIXTURES.md section 4)."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from seriesmart.operators import (log_rows, row_count_verdict, should_download, should_reload,
                                  validate_row_count)
from seriesmart.operators.loadlog import HEADS_SCHEMA, already_loaded, recent_log, run_summary

STATES = ["absent", "success", "failed", "pending"]
ETAGS = [None, "", "same", "different"]


def expected_reload(state, etag):
    if state == "absent" or state == "failed":
        return True
    if not etag:
        return False
    return etag != "same"


def expected_download(state, etag):
    if not etag:
        return True
    if state in ("absent", "failed"):
        return True
    return etag != "same"


def _fixture(spark):
    log, heads = [], []
    for i, (state, etag) in enumerate(itertools.product(STATES, ETAGS)):
        key = f"{state}|{etag}"
        if state != "absent":
            # an older row with another status first: the latest row decides
            log.append(dict(dataset="d", data_key=key, etag="old", status="success",
                            load_timestamp=dt.datetime(2024, 1, 1), seq=1))
            log.append(dict(dataset="d", data_key=key, etag="same", status=state,
                            load_timestamp=dt.datetime(2024, 1, 2), seq=2))
        heads.append(("d", key, etag, None, None))
    return log_rows(spark, log), spark.createDataFrame(heads, HEADS_SCHEMA)


def test_reload_and_download_tables(spark):
    log, heads = _fixture(spark)
    r = {x["data_key"]: x["reload"] for x in should_reload(heads, log).collect()}
    d = {x["data_key"]: x["download"] for x in should_download(heads, log).collect()}
    assert len(r) == len(d) == 16
    for state, etag in itertools.product(STATES, ETAGS):
        k = f"{state}|{etag}"
        assert r[k] == expected_reload(state, etag), k
        assert d[k] == expected_download(state, etag), k


def test_row_count_grid(spark):
    prevs = {"absent": (None, None), "failed": ("failed", 100), "null": ("success", None),
             "zero": ("success", 0), "hundred": ("success", 100)}
    news = [0, 49, 50, 89, 90, 100]
    rows = [(p, n, st, pr) for p, (st, pr) in prevs.items() for n in news]
    df = spark.createDataFrame(rows, "p string, n long, st string, prev long")
    got = {(r["p"], r["n"]): r["v"] for r in
           df.select("p", "n", row_count_verdict("n", "prev", "st").alias("v")).collect()}
    for (p, n), v in got.items():
        if p != "hundred":
            assert v == "success", (p, n)
    assert [got[("hundred", n)] for n in news] == ["failed", "failed", "warning", "warning",
                                                   "success", "success"]


def test_validate_against_last_success(spark):
    # a failed load with a low count must not lower the bar (compare with the last success)
    log = log_rows(spark, [
        dict(dataset="d", data_key="all", rows_loaded=100, status="success",
             load_timestamp=dt.datetime(2024, 1, 1), seq=1),
        dict(dataset="d", data_key="all", rows_loaded=10, status="failed",
             load_timestamp=dt.datetime(2024, 1, 2), seq=2)])
    new = spark.createDataFrame([("d", "all", 40), ("e", "all", 5)],
                                "dataset string, data_key string, rows_loaded long")
    got = {r["dataset"]: (r["verdict"], r["pct_of_prev"]) for r in validate_row_count(new, log).collect()}
    assert got == {"d": ("failed", 40.0), "e": ("success", None)}


def test_log_views(spark):
    log = log_rows(spark, [
        dict(dataset="a", data_key="all", status="success", etag="", seq=1,
             load_timestamp=dt.datetime(2024, 1, 1)),
        dict(dataset="b", data_key="all", status="failed", etag="x", seq=2,
             load_timestamp=dt.datetime(2024, 1, 2))])
    top = recent_log(log, 1).collect()
    assert [(r["dataset"], r["etag"]) for r in top] == [("b", "x")]
    assert recent_log(log, 5).collect()[1]["etag"] == "N/A"
    assert sorted(tuple(r) for r in run_summary(log).collect()) == [("failed", 1), ("success", 1)]
    ds = log.sparkSession.createDataFrame([("a",), ("b",), ("c",)], "dataset string")
    skip = {r["dataset"]: r["skip"] for r in already_loaded(ds, log).collect()}
    assert skip == {"a": True, "b": False, "c": False}
    assert not any(r["skip"] for r in already_loaded(ds, log, force=True).collect())



def test_alerts(spark):
    from pyspark.sql import functions as F
    from seriesmart.operators import alerts
    d = dt.datetime
    log = log_rows(spark, [
        dict(dataset="a", data_key="all", status="success", rows_loaded=100, load_timestamp=d(2024, 1, 1), seq=1),
        dict(dataset="a", data_key="all", status="success", rows_loaded=80, load_timestamp=d(2024, 1, 9), seq=2),
        dict(dataset="b", data_key="all", status="success", rows_loaded=100, load_timestamp=d(2024, 1, 2), seq=3),
        dict(dataset="b", data_key="all", status="success", rows_loaded=95, load_timestamp=d(2024, 1, 3), seq=4),
        dict(dataset="c", data_key="all", status="success", rows_loaded=10, load_timestamp=d(2024, 1, 9), seq=5),
        dict(dataset="c", data_key="all", status="failed", rows_loaded=0, load_timestamp=d(2024, 1, 10), seq=6,
             error_message="boom")])
    got = sorted((r["dataset"], r["alert"], r["detail"]) for r in
                 alerts(log, "2 days", 0.1, now=F.lit(d(2024, 1, 10)).cast("timestamp")).collect())
    assert got == [("a", "row_deviation", "100 -> 80"), ("b", "stale", "2024-01-03 00:00:00"),
                   ("c", "failed", "boom")]
