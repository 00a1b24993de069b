"""Edge rows of the raw text files (FIXTURES.md section 2)."""

import gzip

from pyspark.sql import functions as F
from rawfiles import write_bytes, write_text

from seriesmart.sources import (count_skipped, parse_lines, read_dimension, read_dimension_table,
                                read_facts, read_lines, read_parts, read_series,
                                read_series_mapping, starts_with)

FACT = ("series_id", "year", "period", "value", "footnote_codes")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_fact_edges(spark, tmp_path):
    text = ("series_id\tyear\tperiod\tvalue\tfootnote_codes\r\n"
            "  A1 \t2020\tM01\t 1.5 \t-\r\n"          # padded, '-' -> NULL, CRLF
            "A2\t2021\tM02\t2.0\t\textra\tmore\n"     # long row: cut
            "A3\t2022\tM03\n"                          # short row: skipped
            "   \n"                                    # blank line
            "\n"
            "A4\t2023\tM04\t\t\n"                      # empty value -> NULL
            "A5\t2024\tM05\t3.25\tP\n")
    p = write_text(tmp_path / "f.txt", text)
    df = read_facts(spark, p, FACT)
    assert rows(df) == [("A1", 2020, "M01", "1.5", None), ("A2", 2021, "M02", "2.0", None),
                        ("A4", 2023, "M04", None, None), ("A5", 2024, "M05", "3.25", "P")]
    c = count_skipped(read_lines(spark, p, header=starts_with("series_id")), FACT).first()
    assert (c["kept"], c["skipped"]) == (4, 1)


def test_no_header_keeps_first_row(spark, tmp_path):
    p = write_text(tmp_path / "f.txt", "B1\t2020\tM01\t1\t\nB2\t2020\tM02\t2\t\n")
    assert [r[0] for r in rows(read_facts(spark, p, FACT), "series_id")] == ["B1", "B2"]


def test_nul_and_bad_utf8(spark, tmp_path):
    p = write_bytes(tmp_path / "f.txt", b"C\x001\t2020\tM01\t1\tx\xff\n")
    r = read_facts(spark, p, FACT).first()
    assert r["series_id"] == "C1"
    assert r["footnote_codes"] == "x�"


def test_unicode_trim(spark, tmp_path):
    p = write_text(tmp_path / "f.txt", " D1　\t 2020\t\tM01 \t7\t\n")
    df = parse_lines(read_lines(spark, p), ["series_id", "year", "x", "period"])
    assert rows(df) == [("D1", "2020", None, "M01")]


def test_gzip_file(spark, tmp_path):
    p = write_bytes(tmp_path / "f.txt.gz", gzip.compress(b"E1\t2020\tM01\t1.0\t\n"))
    assert rows(read_facts(spark, p, FACT), "series_id") == [("E1",)]


def test_dimension_edges(spark, tmp_path):
    text = ("code\tname\textra\r\n"
            "01\tFirst\r\n"
            "02\t-\n"                  # '-' name -> NULL
            "03\n"                     # one field -> NULL name
            "\t\tno code\n"            # empty code: ignored
            "0\x004\tNul\x00Name\n"    # NUL bytes removed
            "01\tFirst again\n")       # duplicate: last wins
    p = write_text(tmp_path / "dim.txt", text)
    d = read_dimension(spark, p)
    assert rows(d) == [("01", "First again"), ("02", None), ("03", None), ("04", "NulName")]


def test_dimension_without_tab_header_keeps_first_line(spark, tmp_path):
    p = write_text(tmp_path / "dim.txt", "codes only\nA\tAlpha\n")
    assert rows(read_dimension(spark, p)) == [("A", "Alpha"), ("codes only", None)]


def test_dimension_key_and_name_columns(spark, tmp_path):
    p = write_text(tmp_path / "dim.txt", "abbr\tcode\tname\nJAN\tM01\tJanuary\n")
    assert rows(read_dimension(spark, p, key_col=1, name_col=2)) == [("M01", "January")]


def test_dimension_last_wins_across_files(spark, tmp_path):
    write_text(tmp_path / "d" / "part-0.txt", "code\tname\nX\tfirst\n")
    write_text(tmp_path / "d" / "part-1.txt", "code\tname\nX\tsecond\n")
    assert rows(read_dimension(spark, str(tmp_path / "d"))) == [("X", "second")]


def test_dimension_table(spark, tmp_path):
    p = write_text(tmp_path / "t.txt", "item_code\titem_name\tlevel\nSA0\tAll items\t0\nSA1\t-\n")
    d = read_dimension_table(spark, p, pk_column="item_code")
    assert d.columns == ["item_code", "item_name", "level"]
    assert rows(d) == [("SA0", "All items", "0"), ("SA1", None, None)]
    d2 = read_dimension_table(spark, p, pk_column="item_code", columns=["c", "n"])
    assert rows(d2) == [("SA0", "All items"), ("SA1", None)]


def test_series_mapping(spark, tmp_path):
    p = write_text(tmp_path / "s.txt",
                   "series_id\tarea\titem\tseasonal\nS1\tA\tI\tS\nS2\t\tI\tU\nS3\tA\nS1\tB\tJ\n")
    m = read_series_mapping(spark, p)
    assert rows(m) == [("S1", "B", "J", None)]


def test_series_keeps_leading_zeros(spark, tmp_path):
    p = write_text(tmp_path / "s.txt", "series_id\tcode\nS1\t0100\n")
    assert rows(read_series(spark, p, ["series_id", "code"])) == [("S1", "0100")]


def test_read_parts(spark, tmp_path):
    write_text(tmp_path / "x_data_1", "a\n")
    write_text(tmp_path / "x_data_2", "b\n")
    write_text(tmp_path / "y", "c\n")
    assert rows(read_parts(spark, str(tmp_path), "x")) == [("a",), ("b",)]
    assert rows(read_parts(spark, str(tmp_path), "y")) == [("c",)]


def test_last_line_keeps_its_trailing_empty_fields(spark, tmp_path):
    # a whole-text strip would eat the trailing tab of the last row and drop it
    p = write_text(tmp_path / "f.txt", "A1\t2020\tM01\t1\t\nA2\t2020\tM02\t2\t")
    assert rows(read_facts(spark, p, FACT), "series_id") == [("A1",), ("A2",)]


def test_header_is_a_files_first_line_only(spark, tmp_path):
    """Lines further down that start like a header are data; each file has its own first line."""
    a = write_text(tmp_path / "in" / "a.txt", "series_id\tyear\nseries_id_x\t2\nA\t1\n")
    b = write_text(tmp_path / "in" / "b.txt", "B\t3\nseries_idle\t4\n")
    write_text(tmp_path / "in" / "c d.txt", "  series_id \tother\nC\t5\n")
    lines = read_lines(spark, str(tmp_path / "in"), header=starts_with("series_id"))
    assert rows(parse_lines(lines, ["k", "v"])) == [("A", "1"), ("B", "3"), ("C", "5"), ("series_id_x", "2"), ("series_idle", "4")]
    assert rows(read_series(spark, [a, b], ["series_id", "year"])) == [("A", "1"), ("B", "3"), ("series_id_x", "2"), ("series_idle", "4")]
    p = write_text(tmp_path / "d.txt", "area_code\tarea_name\narea9\tNine\narea_code2\tTwo\n")
    assert rows(read_dimension_table(spark, p, "area")) == [("area9", "Nine"), ("area_code2", "Two")]


# --- first lines and codecs -----------------------------------------------------------------

def test_gzip_by_its_bytes(spark, tmp_path):
    """Gzip without .gz, plain text named .gz, several gzip members, all beside plain files."""
    d = tmp_path / "in"
    write_bytes(d / "a", gzip.compress(b"series_id\tv\r\nA\t1\r\n\r\nB\t\xff2\n"))
    write_bytes(d / "b.gz", b"series_id\tv\nC\t3")
    write_bytes(d / "c.gz", gzip.compress(b"series_id\tv\nD\t4\n"))
    write_bytes(d / "d +%41.txt", b"\xef\xbb\xbfseries_id\tv\nE\t5\nseries_id_2\t6\n")
    write_bytes(d / "e", gzip.compress(b"series") + gzip.compress(b"_id\tv\nF\t7"))
    write_bytes(d / "f", b"")
    write_bytes(d / "g", gzip.compress(b""))
    got = rows(read_series(spark, str(d), ["series_id", "v"]))
    assert sorted(got) == [("A", "1"), ("B", "�2"), ("C", "3"), ("D", "4"), ("E", "5"), ("F", "7"), ("series_id_2", "6")]
    last = read_dimension(spark, str(d)).filter("code = 'D'").collect()
    assert [tuple(r) for r in last] == [("D", "4")]


def test_delimited_gzip_by_its_bytes(spark, tmp_path):
    from seriesmart.sources import read_delimited
    d = tmp_path / "in"
    write_bytes(d / "a.csv", gzip.compress(b'k,"v"\n1,"x, ""y"""\n2,\n'))
    write_bytes(d / "b.csv", b"v\tk\nz\t3\n")
    write_bytes(d / "c.csv.gz", gzip.compress(b"K,v\n4,w\n"))
    write_bytes(d / "d.csv.gz", b'k,v\n5,"line\nbreak"\n')
    got = read_delimited(spark, str(d), ["k", "v"], {"k": "int"}, with_file=True, multi_line=True).collect()
    assert sorted((r.k, r.v, r._file.rsplit("/", 1)[1]) for r in got) == [
        (1, 'x, "y"', "a.csv"), (2, None, "a.csv"), (3, "z", "b.csv"), (4, "w", "c.csv.gz"), (5, "line\nbreak", "d.csv.gz")]


def test_lines_of_a_stream():
    """Line ends across block borders, whatever the block size; a first line longer than a block."""
    import io
    from seriesmart.sources.heads import first_line, lines_in
    text = b"\xef\xbb\xbfa\r\nb\rc\n\nlonger line\r\n\r\nend"
    want = [b"a", b"b", b"c", b"", b"longer line", b"", b"end"]
    for block in (3, 4, 5, 7, 1000):
        assert list(lines_in(io.BytesIO(text), False, block)) == want
        assert list(lines_in(io.BytesIO(gzip.compress(text)), True, block)) == want
    line = b"x" * 5000
    assert first_line(io.BytesIO(line + b"\ny"), 16) == (False, line)
    assert first_line(io.BytesIO(gzip.compress(line[:2000]) + gzip.compress(line[2000:] + b"\r\nz")), 16) == (True, line)
    assert first_line(io.BytesIO(b"")) == (False, None) and first_line(io.BytesIO(gzip.compress(b""))) == (True, None)


def test_headers_of_many_files_in_a_constant_number_of_jobs(spark, tmp_path):
    """As many jobs for 1,000 files as for 10, and a plan that doesn't grow with them."""
    def load(n):
        d = tmp_path / f"in{n}"
        for i in range(n):
            write_text(d / f"f{i}", f"series_id\tv{i % 7}\ns{i}\t{i}\n")
        group = f"heads-{n}"
        spark.sparkContext.setJobGroup(group, group)
        df = read_series(spark, str(d), ["series_id", "v"])
        size = len(df._jdf.queryExecution().analyzed().toString())
        got = df.count()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("", "")
        assert got == n
        return jobs, size

    (few, small), (many, large) = load(10), load(1000)
    assert many <= few + 1 and large < 1.2 * small


def test_headers_beyond_a_broadcast(spark, tmp_path, monkeypatch):
    from seriesmart.sources import heads
    monkeypatch.setattr(heads, "BROADCAST_FILES", 1)
    for i in range(4):
        write_text(tmp_path / "in" / f"f{i}", f"series_id\tv\ns{i}\t{i}\nseries_id_x\t9\n")
    got = rows(read_series(spark, str(tmp_path / "in"), ["series_id", "v"]))
    assert sorted(got) == sorted([(f"s{i}", str(i)) for i in range(4)] + [("series_id_x", "9")] * 4)


def test_first_lines_where_files_cannot_be_opened(spark, tmp_path, monkeypatch):
    """Without a file system for the URI, one scan finds the first lines."""
    from seriesmart.sources import heads
    for i in range(3):
        write_text(tmp_path / "in" / f"f{i}", "\n".join(f"line {i} {j}" for j in range(500)))
    unread = heads.file_heads(spark, str(tmp_path / "in")).withColumn("packed", F.lit(None).cast("boolean"))
    monkeypatch.setattr(heads, "_opened", lambda *_: unread)
    got = heads.file_heads(spark, str(tmp_path / "in")).collect()
    assert sorted((r.line, r.packed) for r in got) == [(f"line {i} 0", False) for i in range(3)]


def test_filters_stay_above_parsed_fields(spark, tmp_path):
    """What a join asks of a field (that it is not null) isn't pushed below the step that takes the line apart."""
    from seriesmart.sources import read_dimension, read_series
    write = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    series = read_series(spark, write("s", "series_id\ta\n A \t1\nB\t-\n \t2\n\x00\n"), ["series_id", "a"])
    dim = read_dimension(spark, write("d", "code\tname\n1\tone\n 2\t two \n-\t-\n"))
    for read, key, want in ((series, "series_id", [("A", "1"), ("B", None)]), (dim, "code", [("-", None), ("1", "one"), ("2", "two")])):
        got = read.filter(F.col(key).isNotNull())
        assert sorted(tuple(r) for r in got.collect()) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1
        assert not [x for x in plan.splitlines() if "Filter" in x and "split(" in x]


def test_series_scan_is_compiled(spark, tmp_path):
    """The generated code of a series file's scan stays below the length (8,000 bytes) beyond which the JVM interprets it."""
    import contextlib
    import io
    import re

    from seriesmart.plans.specs import DATASETS
    from seriesmart.sources import read_series
    for spec in DATASETS.values():
        columns = list(spec.series_columns)
        path = tmp_path / spec.key
        path.write_text("\t".join(columns) + "\n" + "\t".join("x" for _ in columns) + "\n")
        rows = read_series(spark, str(path), columns).filter(F.col("series_id").isNotNull())
        shown = io.StringIO()
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            with contextlib.redirect_stdout(shown):
                rows.explain("codegen")
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
        assert sizes and max(sizes) < 8000, (spec.key, sizes)


def test_visible_ends_are_told_by_bytes(spark):
    from seriesmart.functions.text import clean_text, is_blank
    texts = ["", " ", "!", "~", " ~", "\x7f", "\x7fa", "a\x7f", "\x1fa\x1f", "\x20a", "a\xa0", "　a", "é", "aé", "éa", "\U0001f600", "a\x85", "\ta\r", "\xa0", None]
    got = spark.createDataFrame([(x,) for x in texts], "v string").select("v", clean_text("v").alias("c"), is_blank("v").alias("b")).collect()
    for r in got:
        assert r["c"] == (None if r["v"] is None else r["v"].strip())
        assert r["b"] == (None if r["v"] is None else not r["v"].strip())
