import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seriesmart.functions import (PERIOD_LABELS, cast_columns, cast_value, date_guard, http_date,
                                  null_if_token, period_label, seasonal_from_id, seasonal_label,
                                  url_segment)
from seriesmart.functions.casts import bad_value_counts


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first()["o"]


def test_period_labels(spark):
    codes = [*PERIOD_LABELS, "M14", "X99", None]
    df = spark.createDataFrame([(c,) for c in codes], "p string")
    got = {r["p"]: r["l"] for r in df.select("p", period_label("p").alias("l")).collect()}
    for c, lab in PERIOD_LABELS.items():
        assert got[c] == lab
    assert got["M14"] == "M14" and got["X99"] == "X99" and got[None] is None
    assert len(PERIOD_LABELS) == 21 and got["M13"] == got["S03"] == got["A01"] == "AN AV"


def test_seasonal(spark):
    df = spark.createDataFrame([("S",), ("U",), ("X",), (None,)], "s string")
    got = [r[0] for r in df.select(seasonal_label("s")).collect()]
    assert got == ["Seasonally Adjusted", "Not Seasonally Adjusted", None, None]
    assert one(spark, seasonal_from_id(F.col("v")), "MPS00000") == "S"


def test_decimal_rounding_half_up(spark):
    df = spark.createDataFrame([("2.345",), ("-2.345",), ("2.344",), (None,)], "v string")
    got = [r[0] for r in df.select(cast_value("v", "decimal(14,2)")).collect()]
    assert got == [Decimal("2.35"), Decimal("-2.35"), Decimal("2.34"), None]


def test_strict_and_tolerant(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("1e20",)], "v string")
    with pytest.raises(Exception, match="cannot cast"):
        df.select(cast_value("v", "decimal(14,2)", "strict")).collect()
    got = [r[0] for r in df.select(cast_value("v", "decimal(14,2)", "tolerant")).collect()]
    assert got == [Decimal("1.50"), None, None]
    assert bad_value_counts(df, {"v": "decimal(14,2)"}).first()["bad_v"] == 2


def test_cast_columns_keeps_codes(spark):
    df = spark.createDataFrame([("007", "12")], "code string, n string")
    r = cast_columns(df, {"code": "string", "n": "int"}).first()
    assert r["code"] == "007" and r["n"] == 12


def test_null_tokens(spark):
    df = spark.createDataFrame([("",), ("-",), ("NA",), ("x",)], "v string")
    assert [r[0] for r in df.select(null_if_token("v")).collect()] == [None, None, "NA", "x"]
    assert [r[0] for r in df.select(null_if_token("v", ("", "NA", "NaN"))).collect()] == [None, "-", None, "x"]


def test_http_date(spark):
    vals = ["Sun, 06 Nov 1994 08:49:37 GMT", "06 Nov 1994 09:49:37 +0100", "6 Nov 1994 08:49:37",
            "Sun, 06 Nov 1994 08:49:37 UT", "06 Nov 1994 08:49:37 UTC", "06 Nov 1994 08:49:37 Z",
            "06 Nov 1994 03:49:37 -0500", " Sun,  06 Nov 1994 08:49:37 GMT ", "garbage"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(http_date("v")).collect()]
    t = dt.datetime(1994, 11, 6, 8, 49, 37)
    assert got == [t] * 8 + [None]


def test_url_segment_and_date_guard(spark):
    assert one(spark, url_segment(F.col("v")), "https://h/x/y/2024/file.zip") == "2024"
    assert one(spark, url_segment(F.col("v")), "nothing") is None
    assert one(spark, date_guard(F.col("v")), "2024-01-31") == dt.date(2024, 1, 31)
    assert one(spark, date_guard(F.col("v")), "20240131") is None


def test_dates_ignore_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("Sun, 10 Mar 2024 02:30:00 GMT", "2024-03-10")], "h string, d string")
        r = df.select(http_date("h").alias("h"), date_guard("d").alias("d")).first()
        assert r["h"] == dt.datetime(2024, 3, 10, 2, 30) and r["d"] == dt.date(2024, 3, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
