import os

import pytest
from rawfiles import write_bytes, write_text
from pyspark.sql import functions as F

from seriesmart.operators import with_surrogate_id, year_chunks
from seriesmart.sinks import (append, create_table, current_location, export_csv,
                              publish_full_refresh, read_current, replace_partitions, table_exists)
from seriesmart.sources import manifest, read_delimited
from seriesmart.streaming import stream_ingest


def test_publish_keeps_previous_on_failure(spark, tmp_path):
    root = str(tmp_path / "t")
    a = spark.range(10).withColumnRenamed("id", "x")
    r1 = publish_full_refresh(a, root)
    assert r1.rows == 10 and current_location(spark, root) == r1.location
    r2 = publish_full_refresh(spark.range(3).withColumnRenamed("id", "x"), root,
                              validate=lambda n: ("failed", "too few") if n < 5 else ("success", None))
    assert r2.status == "failed"
    assert read_current(spark, root).count() == 10


def test_append_and_partition_replace(spark, tmp_path):
    p = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 2020), (2, 2020), (3, 2021)], "k int, year int")
    append(df, p, partition_by=["year"])
    append(df.filter("year = 2021"), p, partition_by=["year"])
    assert spark.read.parquet(p).count() == 4
    replace_partitions(spark.createDataFrame([(9, 2021)], "k int, year int"), p, "year")
    got = sorted(tuple(r) for r in spark.read.parquet(p).select("k", "year").collect())
    assert got == [(1, 2020), (2, 2020), (9, 2021)]


def test_stream_ingest_is_idempotent(spark, tmp_path):
    land, out, ck = (str(tmp_path / x) for x in ("land", "out", "ck"))
    write_text(f"{land}/a.txt", "series_id\tyear\nS1\t2020\nS2\t2021\nshort\n")
    cols = ["series_id", "year"]
    stream_ingest(spark, land, cols, out, ck)
    assert spark.read.parquet(out).count() == 2
    stream_ingest(spark, land, cols, out, ck)          # same files: nothing new
    assert spark.read.parquet(out).count() == 2
    write_text(f"{land}/b.txt", "S3\t2022\n")
    stream_ingest(spark, land, cols, out, ck)          # only the new file
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == ["S1", "S2", "S3"]


def test_stream_foreach_batch(spark, tmp_path):
    land, ck = str(tmp_path / "land"), str(tmp_path / "ck")
    write_text(f"{land}/a.txt", "A\t1\nB\t2\n")
    seen = []
    stream_ingest(spark, land, ["k", "v"], None, ck, on_batch=lambda df, i: seen.append(df.count()))
    assert sum(seen) == 2


def test_surrogate_id_with_hot_key(spark):
    # one key holds a third of the rows; ids stay 1..n, contiguous, in key order
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id"))).alias("k"),
                                  F.col("id").alias("v"))
    got = with_surrogate_id(df, ["k"], partitions=6).collect()
    ids = sorted(r["id"] for r in got)
    assert ids == list(range(1, 3001))
    by_id = sorted(got, key=lambda r: r["id"])
    assert [r["k"] for r in by_id] == sorted(r["k"] for r in got)


def test_year_chunks(spark):
    df = spark.createDataFrame([(y,) for y in [2001, 2001, 2002, 2003, 2006, None]], "year int")
    got = [tuple(r) for r in year_chunks(df, 2).orderBy("chunk_start").collect()]
    assert got == [(2001, 2002, 3, 3), (2003, 2004, 1, 4), (2005, 2006, 1, 5)]


def test_csv_roundtrip_header_mapping(spark, tmp_path):
    p = str(tmp_path / "c")
    df = spark.createDataFrame([("0100", "NA", "2024-01-02"), ("0200", "x", "20240102")],
                               "Code string, Label string, Day string")
    export_csv(df, p)
    got = read_delimited(spark, p, ["code", "label", "day", "missing"],
                         {"code": "string", "day": "date", "missing": "int"})
    rows = sorted(tuple(r) for r in got.collect())
    import datetime as dt
    assert rows == [("0100", None, dt.date(2024, 1, 2), None), ("0200", "x", None, None)]


def test_manifest_and_create_table(spark, tmp_path):
    p = str(tmp_path / "m")
    os.makedirs(p)
    write_text(f"{p}/a.txt", "hello")
    m = manifest(spark, p, with_md5=True).collect()
    assert m[0]["length"] == 5 and m[0]["md5"] == "5d41402abc4b2a76b9719d911017c592"
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("year", T.IntegerType())])
    name = "sm_test_tbl"
    assert create_table(spark, name, schema, str(tmp_path / "tbl"), ["year"])
    assert table_exists(spark, name)
    assert not create_table(spark, name, schema)
    spark.sql(f"DROP TABLE {name}")


def test_register_table_switches_versions(spark, tmp_path):
    from seriesmart.sinks import register_table
    root = str(tmp_path / "t")
    df1 = spark.createDataFrame([(1, 2020), (2, 2021)], "k int, year int")
    r1 = publish_full_refresh(df1, root, partition_by=["year"])
    register_table(spark, "sm_versions_t", r1.location, ["year"])
    assert spark.table("sm_versions_t").count() == 2
    r2 = publish_full_refresh(df1.union(spark.createDataFrame([(3, 2022)], "k int, year int")), root,
                              partition_by=["year"])
    register_table(spark, "sm_versions_t", r2.location, ["year"])
    assert spark.table("sm_versions_t").count() == 3
    assert spark.table("sm_versions_t").filter("year = 2022").count() == 1
    spark.sql("DROP TABLE sm_versions_t")


def test_spec_schema(spark):
    from seriesmart.plans import DATASETS
    cpi = DATASETS["cpi"].struct_type()
    assert cpi.fieldNames()[0] == "id" and cpi["value"].dataType.simpleString() == "decimal(15,4)"
    ce = DATASETS["employment"].struct_type()
    assert not ce["series_id"].nullable and ce["value"].dataType.simpleString() == "decimal(14,2)"


def test_stream_backlog_in_bounded_batches(spark, tmp_path):
    land, out, ck = (str(tmp_path / x) for x in ("land", "out", "ck"))
    for i in range(3):
        write_text(f"{land}/f{i}.txt", "".join(f"S{i}_{j}\t{2000 + j}\n" for j in range(5)))
    batches = stream_ingest(spark, land, ["series_id", "year"], out, ck, max_files_per_trigger=1)
    assert batches >= 3
    assert spark.read.parquet(out).count() == 15


def test_stream_counts_more_batches_than_progress_reports(spark, tmp_path):
    land, out, ck = (str(tmp_path / x) for x in ("land", "out", "ck"))
    for i in range(5):
        write_text(f"{land}/f{i}.txt", f"S{i}\t{2000 + i}\n")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        assert stream_ingest(spark, land, ["series_id", "year"], out, ck, max_files_per_trigger=1) == 5
        assert stream_ingest(spark, land, ["series_id", "year"], out, ck) == 0
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_checksum_of_a_file_larger_than_a_block(spark, tmp_path):
    import hashlib
    from seriesmart.sources.files import BLOCK, digest_of
    data = os.urandom(1 << 16) * ((2 * BLOCK >> 16) + 1)
    write_bytes(tmp_path / "m" / "big +%41.bin", data)
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.md5) for r in manifest(spark, str(tmp_path / "m"), with_md5=True).collect()}
    assert got == {"big +%41.bin": (len(data), hashlib.md5(data).hexdigest())}

    class Counted:
        """Never more than a block is asked for."""
        left, most = 10 * 7, 0

        def read(self, n):
            self.most = max(self.most, n)
            self.left, n = self.left - min(n, self.left), min(n, self.left)
            return b"x" * n
    stream = Counted()
    assert digest_of(stream, 7) == hashlib.md5(b"x" * 70).hexdigest() and stream.most == 7


def test_partitions_are_replaced_whole_or_not_at_all(spark, tmp_path):
    from seriesmart.operators.quality import not_null
    from seriesmart.sinks import manifest_of, publish_partitions, read_partitions
    root = str(tmp_path / "t")
    rows = [(i, y) for y in ("2020", "2021", None, "a/b=c %") for i in range(10)]
    first = publish_partitions(spark.createDataFrame(rows, "k int, p string"), root, "p")
    assert sorted((r.part or "", r.rows, r.prev_rows, r.verdict) for r in first.collect()) == [
        ("", 10, None, "success"), ("2020", 10, None, "success"), ("2021", 10, None, "success"), ("a/b=c %", 10, None, "success")]
    assert sorted(read_partitions(spark, root).collect(), key=str) == sorted(spark.createDataFrame(rows, "k int, p string").collect(), key=str)
    # a good one, one with too few rows, one that breaks a rule
    new = [(100 + i, "2020") for i in range(8)] + [(200, "2021")] + [(None if i == 5 else i, "a/b=c %") for i in range(10)]
    got = publish_partitions(spark.createDataFrame(new, "k int, p string"), root, "p", rules={"k": not_null("k")})
    assert sorted((r.part, r.rows, r.prev_rows, r.violations, r.verdict) for r in got.collect()) == [
        ("2020", 8, 10, 0, "warning"), ("2021", 1, 10, 0, "failed"), ("a/b=c %", 10, 10, 1, "failed")]
    want = [(100 + i, "2020") for i in range(8)] + [r for r in rows if r[1] != "2020"]
    assert sorted(map(str, map(tuple, read_partitions(spark, root).collect()))) == sorted(map(str, want))
    assert read_partitions(spark, root, ["2020", None]).count() == 18 and read_partitions(spark, root, ["none"]).count() == 0
    publish_partitions(spark.createDataFrame([(1, "2021")], "k int, p string"), root, "p", force=True)
    assert {r.part: r.rows for r in manifest_of(spark, root).collect()}["2021"] == 1
    with pytest.raises(FileNotFoundError):
        read_partitions(spark, str(tmp_path / "nothing"))


def test_a_failing_replacement_leaves_the_table_as_it_is(spark, tmp_path):
    from pyspark.sql import functions as F
    from seriesmart.sinks import publish_partitions, read_partitions
    root = str(tmp_path / "t")
    df = spark.range(10).withColumn("p", F.lit(1))
    publish_partitions(df, root, "p")
    with pytest.raises(Exception):
        publish_partitions(df.withColumn("id", F.raise_error(F.lit("bad row")).cast("long")), root, "p")
    assert read_partitions(spark, root).count() == 10


def test_revised_files(spark, tmp_path):
    from seriesmart.streaming import ingest_revised, read_ingested
    land, out = tmp_path / "land", str(tmp_path / "out")
    rows = lambda: sorted(tuple(r) for r in read_ingested(spark, out).select("series_id", "v").collect())
    write_text(land / "a +.txt", "series_id\tv\nA\t1\nB\t2\n")
    write_text(land / "b", "series_id\tv\nC\t3\n")
    assert ingest_revised(spark, str(land), ["series_id", "v"], out) == 2
    assert rows() == [("A", "1"), ("B", "2"), ("C", "3")]
    assert ingest_revised(spark, str(land), ["series_id", "v"], out) == 0
    write_text(land / "a +.txt", "series_id\tv\nA\t10\nD\t4\nE\t5\n")
    write_text(land / "c", "F\t6\n")
    assert ingest_revised(spark, str(land), ["series_id", "v"], out) == 2
    assert rows() == [("A", "10"), ("C", "3"), ("D", "4"), ("E", "5"), ("F", "6")]
    write_text(land / "b", "series_id\tv\n")
    os.remove(land / "c")
    assert ingest_revised(spark, str(land), ["series_id", "v"], out) == 1
    assert rows() == [("A", "10"), ("D", "4"), ("E", "5"), ("F", "6")]


def test_compacted_log(spark, tmp_path):
    import datetime as dt
    from pathlib import Path
    from seriesmart.operators import append_log, compact_log, latest_log, log_rows, read_log
    path = str(tmp_path / "log")
    at = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
    assert compact_log(spark, path) == 1 and read_log(spark, path).count() == 0
    for i in range(9):
        status = "failed" if i % 3 == 2 else "success"
        append_log(log_rows(spark, [{"dataset": d, "data_key": "all", "rows_loaded": i, "status": status, "load_timestamp": at(i), "seq": i} for d in "xy"]), path)
        if i % 3 == 2:
            compact_log(spark, path)
            kept = sorted((r.dataset, r.rows_loaded, r.status) for r in read_log(spark, path).collect())
            assert kept == [(d, n, s) for d in "xy" for n, s in ((i - 1, "success"), (i, "failed"))]
    assert {r.dataset: r.rows_loaded for r in latest_log(read_log(spark, path)).collect()} == {"x": 8, "y": 8}
    files = [f for f in (Path(path) / "_generation" / "4").rglob("part-*.parquet")]
    assert len(files) <= 2


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    from seriesmart.operators import check_unique
    from seriesmart.sinks import write_bucketed
    from pyspark.sql import functions as F
    facts = write_bucketed(spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("m")), "sm_b_facts", "k", 4, str(tmp_path / "f"))
    series = write_bucketed(spark.range(50).select(F.col("id").alias("s"), F.lit("n").alias("name")), "sm_b_series", "s", 4, str(tmp_path / "s"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    keys = check_unique(facts, ["k", "m"])
    both = facts.join(series.hint("merge"), F.col("k") == F.col("s"))
    assert "Exchange" not in plan(keys) and "Exchange" not in plan(both)
    assert keys.count() == 0 and both.count() == 1000
    for t in ("sm_b_facts", "sm_b_series"):
        spark.sql(f"DROP TABLE {t}")


def test_chunk_counts_read_no_column(spark, tmp_path):
    """Rows per year chunk come from the files' footers and folder names."""
    from pyspark.sql import functions as F
    from seriesmart.operators import year_chunks
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") % 5 + 2000).cast("int").alias("year")).write.partitionBy("year").parquet(path)
    got = year_chunks(spark.read.parquet(path).select("year"), 2)
    assert "ReadSchema: struct<>" in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.orderBy("chunk_start").collect()] == [(2000, 2001, 40, 40), (2002, 2003, 40, 80), (2004, 2004, 20, 100)]


def test_landed_files_are_written_in_blocks(spark, tmp_path, monkeypatch):
    """No task builds a file as one value, and a status with many orders lands several files."""
    import gzip

    from seriesmart import registry_tables
    path = str(tmp_path / "sf")
    spark.range(50).selectExpr("if(id % 10 = 0, null, id) AS o_orderkey", "id % 4 AS o_custkey", "substr('FOP', cast(id % 3 AS int) + 1, 1) AS o_orderstatus",
                               "concat('p', id) AS o_orderpriority").write.parquet(f"{path}/orders.parquet")
    monkeypatch.setattr(registry_tables, "FILE_LINES", 5)
    blocks, taken, of = [], [], registry_tables._write_files
    monkeypatch.setattr(registry_tables, "_write_files", lambda lines, *a: (blocks.append((lines.select(F.max(F.length("line"))).first()[0] or 0)), of(lines, *a)))
    ingest = registry_tables.ingest_revised
    monkeypatch.setattr(registry_tables, "ingest_revised", lambda *a: taken.append(ingest(*a)) or taken[-1])
    got = sorted(tuple(r) for r in registry_tables.stream_revised_files(spark, path).collect())
    want = sorted((str(i), "revised" if i % 3 == 2 else f"p{i}") for i in range(50) if i % 10 and i % 3 != 1)
    assert got == want and taken == [12, 0, 8] and max(blocks) < 20

    lines = spark.createDataFrame([("a.txt", True, "x"), ("b.gz", False, "y"), ("a.txt", True, "z"), ("c.txt", False, None)], "name string, packed boolean, line string")
    of(lines, str(tmp_path / "files"), "head", 2)
    read = {f: open(tmp_path / "files" / f, "rb").read() for f in os.listdir(tmp_path / "files")}
    assert sorted(gzip.decompress(read["a.txt"]).split()) == [b"head", b"x", b"z"]
    assert read["b.gz"] == b"head\ny\n" and read["c.txt"] == b"head\n"
