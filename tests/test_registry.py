"""Every registered query against its DuckDB oracle on the smallest tables."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as se
from seriesmart.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events pages".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr), sorted(cols)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "c_name",
                          "l_partkey", "p_name", "l_suppkey", "s_name"]


def test_every_query_has_an_oracle_or_reason():
    assert set(QUERIES) - set(ORACLE_SQL) == {"file_manifest"}
    assert len(QUERIES) >= 50
    assert set(QUERIES) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(se.oracle_sql()[name])
    want = _rows([d[0] for d in res.description], res.fetchall())
    assert got[1] == want[1]
    assert got[0] == want[0]
