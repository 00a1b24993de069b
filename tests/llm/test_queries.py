"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from brute_force import brute_components
from seriesmart.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": "page_id payload_bytes payload_digest record_type refers_to", "op2_": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op4_": "doc_id n_shingles component_id kept",
    "op5_": "doc_id item_id score", "op6_": "doc_id n_tokens ids_sha256 decoded_sha256", "op7_": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op8_": "doc_id held_out score predicted", "op9_": "page_id url text n_chars", "op10_": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_": "vec_id code error label_error codebooks_sha256", "op12_": "doc_id n_shingles component_id",
    "op13_": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    df = QUERIES[name](spark, SF)
    want = next(v for k, v in COLUMNS.items() if name.startswith(k)).split()
    assert set(want) <= set(df.columns)
    table = "pages" if name.startswith(("op1_", "op9_")) else "embeddings" if name.startswith("op11_") else "documents"
    if not name.startswith(("op5_", "op13_")):
        key = want[0]
        assert Counter(r[0] for r in df.select(key).collect()) == Counter(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    assert Counter(map(tuple, QUERIES[name](spark, SF).select(cols).collect())) == Counter(want.fetchall())


def test_pipeline_stage_by_stage(spark):
    from seriesmart.llm import secret_scan, toxicity
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in toxicity.rate(docs, labels).collect()}
            want = {i: t for i, t in rows.items() if scores[i] < 0.7}
        elif name == "near_duplicates":
            first = {c for d, _, c in brute_components(list(rows.items()), 5)}
            want = {i: t for i, t in rows.items() if i in first}
        elif name == "benchmark_leaks":
            words = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
            items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            want = {i: t for i, t in rows.items() if not any(x in words(t) for x in items)}
        elif name == "secrets":
            want = {r.doc_id: r.text for r in got}
            assert set(want) == set(rows)
            assert all((want[i] == t) == (not secret_scan.find(t)) and not secret_scan.find(want[i]) for i, t in rows.items())
            assert all(r.n_chars == len(r.text) for r in got)
        else:
            assert all(r.lossless for r in got) and {r.doc_id for r in got} == set(rows)
            break
        assert out.columns == docs.columns
        assert {r.doc_id: r.text for r in got} == want, name
        rows, docs = want, spark.createDataFrame(got, docs.schema)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)
