"""Plan shapes the design depends on (checked on the physical plans)."""

from contextlib import contextmanager

from pyspark.sql import functions as F

import __spark_entry__ as se
from seriesmart.operators import map_join, orphans, skip_counts, Lookup, denormalize, latest_per_key, year_range

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_fact_side_is_never_broadcast(spark):
    # a counted series over the broadcast bound becomes the hash-build side
    li, o = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders"))
    p = plan(denormalize(li, o, {}, [], fact_key="l_orderkey", series_key="o_orderkey", max_rows=10, series_rows=1500))
    assert "ShuffledHashJoin" in p and "BuildRight" in p and "BroadcastExchange" not in p
    # without counts Spark's byte sizes decide; the facts are larger than what may be broadcast
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "64k"}):
        p = plan(se.queries()["star_denormalize"](spark, SF))
    for part in p.split("BroadcastExchange")[1:]:
        assert "lineitem" not in part.split("Exchange")[0].split("Scan")[0]


def test_joins_start_no_job_beforehand(spark):
    """Nothing is counted to choose a join: plans have no limit through one task."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("choose", "choose")
    try:
        li, o = spark.range(1000).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
        p = plan(map_join(li, o, "k", "k")) + plan(skip_counts(li, o, "k", "k")) + plan(orphans(li, o, "k", "k"))
        assert "GlobalLimit" not in p
        assert not tracker.getJobIdsForGroup("choose")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_small_code_lists_are_broadcast(spark):
    p = plan(se.queries()["star_denormalize"](spark, SF))
    assert p.count("BroadcastHashJoin") >= 3


def test_year_range_reaches_the_scan(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(year_range(o, 1996, 1997, "o_orderdate").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_latest_per_key_combines_before_the_shuffle(spark):
    e = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "event_id")
    p = plan(latest_per_key(e, ["user_id"], ["ts", "event_id"]))
    assert "partial_max_by" in p


def test_hot_series_is_split_by_aqe(spark):
    """One series holds a third of all facts and the series is too big to
    broadcast: AQE splits the hot partition of the streamed fact side."""
    n = 600_000
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20000).alias("series_id"),
        F.col("id").alias("v"))
    series = spark.range(20000).select(F.col("id").alias("series_id"), (F.col("id") % 10).alias("c"))
    dims = {"d": spark.range(10).select(F.col("id").alias("code"), F.col("id").cast("string").alias("name"))}
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        df = denormalize(facts, series, dims, [Lookup("d", "cname", key="c")], max_rows=1000, series_rows=20000)
        agg = df.groupBy().agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
        r = agg.collect()[0]
        final = plan(agg)
    assert r["n"] == n and r["s"] == n * (n - 1) // 2
    assert "ShuffledHashJoin(skew=true)" in final


def test_counted_orphans_keep_the_fact_side_streamed(spark):
    from pyspark.sql import Observation
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    o = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderstatus = 'F'")
    obs = Observation("orphans")
    df = denormalize(li, o, {}, [], fact_key="l_orderkey", series_key="o_orderkey", max_rows=10,
                     series_rows=1500, observation=obs).select("l_orderkey")
    p = plan(df)
    assert "ShuffledHashJoin" in p and "LeftOuter, BuildRight" in p
    n = df.count()
    assert n + obs.get["orphan_facts"] == li.count()


def test_hot_series_is_split_in_the_counted_left_join(spark):
    from pyspark.sql import Observation
    n = 600_000
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20000).alias("series_id"),
        F.col("id").alias("v"))
    series = spark.range(19000).select(F.col("id").alias("series_id"))
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        obs = Observation("orphans_skew")
        df = denormalize(facts, series, {}, [], max_rows=1000, series_rows=19000, observation=obs)
        agg = df.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
        r = agg.collect()[0]
        final = plan(agg)
    orphans = n - sum(1 for i in range(n) if i % 3 != 0 and i % 20000 < 19000) - n // 3
    assert r["n"] + obs.get["orphan_facts"] == n
    assert obs.get["orphan_facts"] == orphans
    assert "ShuffledHashJoin(skew=true)" in final and "LeftOuter" in final



def test_huge_build_side_sorts_and_merges_instead(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    with conf(spark, **{"seriesmart.shuffleHash.maxRowsPerPartition": "1"}):
        p = plan(denormalize(li, o, {}, [], fact_key="l_orderkey", series_key="o_orderkey",
                             max_rows=10, series_rows=1500).select("l_orderkey"))
    assert "SortMergeJoin" in p and "ShuffledHashJoin" not in p


def test_hot_year_is_split_across_files_by_rebalance(spark, tmp_path):
    import os
    from seriesmart.sinks import publish_full_refresh
    n = 400_000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 < 9, F.lit(2020)).otherwise(F.lit(2021)).alias("year"),
        F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        res = publish_full_refresh(df.hint("rebalance", "year"), str(tmp_path / "t"), partition_by=["year"])
    hot = [f for f in os.listdir(res.location.replace("file:", "") + "/year=2020") if f.endswith(".parquet")]
    assert res.rows == n and len(hot) > 2
