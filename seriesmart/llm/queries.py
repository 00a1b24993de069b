"""The registered queries of the operators, each over its whole tables.

A query applies one operator with production parameters and derives its digest
columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, decontaminate, hard_negatives, html_main, near_dup, ngram_join, pii, quality_llr, secret_scan, shards, toxicity, vector_codes, warc_index
from .common import id_text, n_of, sha256, span_text, table
from .graph import stored


def _span_digest(found: DataFrame, base: list[str]) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    own = F.filter(spans, lambda s: s["kind"].isin(base))
    return found.select("doc_id", *[n_of(spans, k).alias(f"n_{k}") for k in base],
                        sha256(span_text(own)).alias("base_sha256"), span_text(spans).alias("spans"))


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written, looked up by its URL in the index and read back."""
    pages = table(spark, sf_dir, "pages")
    places, idx = warc_index.archive(pages, spark)
    found = warc_index.lookup(places.select("url_key", "page_id"), idx)
    got = stored(warc_index.read(found, payloads=False).select("page_id", "n", "digest", "kind", "refers_to"), spark, "records")
    # A revisit has no payload: its length is that of the response which it refers to.
    sizes = got.filter("kind = 'response' AND n >= 1000").groupBy("page_id", "digest").agg(F.max("n").alias("size"))
    return (got.join(sizes.withColumnRenamed("page_id", "refers_to"), ["refers_to", "digest"], "left")
            .select("page_id", F.coalesce("n", "size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                    F.col("kind").alias("record_type"), F.col("refers_to")))


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return _span_digest(pii.scan(id_text(table(spark, sf_dir, "documents"))), pii.BASE)


def op3_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, score and verdict of every document."""
    return quality_llr.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on four-word shingles."""
    return near_dup.kept(near_dup.classes(table(spark, sf_dir, "documents"), spark, words=4, percent=80))


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, edited copies included."""
    found = decontaminate.leaks(id_text(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")


def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.round_trip(id_text(table(spark, sf_dir, "documents")), vocabulary)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
                       sha256(F.col("decoded")).alias("decoded_sha256"))


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return _span_digest(secret_scan.scan(id_text(table(spark, sf_dir, "documents"))), secret_scan.BASE)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return html_main.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, copies together, counts at most one apart."""
    placed = shards.assign(table(spark, sf_dir, "documents"), spark)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code, errors and the codebooks' digest of every vector."""
    rows, books = vector_codes.compress(table(spark, sf_dir, "embeddings"), spark)
    return rows.select(F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                       F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of five-word shingle sets, similarity 0.8."""
    return ngram_join.classes(table(spark, sf_dir, "documents"), spark, words=5, percent=80)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has its label moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), spark, F.col("id") % 100 == 0, k=5, percent=80)


QUERIES = {f.__name__: f for f in (op1_warc_index, op2_pii_spans, op3_quality_llr, op4_near_duplicates, op5_benchmark_leaks, op6_bpe_roundtrip, op7_secret_spans, op8_toxicity, op9_main_text, op10_balanced_shards,
                                  op11_vector_codes, op12_ngram_join, op13_hard_negatives)}

#: Vectors with all components finite, as integers.
_KEPT = """SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _assigned(book: str) -> str:
    """The nearest entry of a codebook ``(p, e, c)`` for every part ``x (vec_id, label, p, v)``."""
    return f"""SELECT vec_id, label, p, v, min(d * 64 + e) // 64 AS d, min(d * 64 + e) % 64 AS e FROM (
        SELECT x.vec_id, x.label, x.p, x.v, b.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.c[i]) * (x.v[i] - b.c[i])))::BIGINT AS d
        FROM x JOIN {book} b USING (p)) GROUP BY vec_id, label, p, v"""


def _moved(book: str, parts: str) -> str:
    """The codebook after a round: the floors of the assigned parts' means, unused entries as they are."""
    return f"""SELECT p, e, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
        SELECT p, e, list(c ORDER BY i) AS c FROM (
            SELECT p, e, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS c FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM {parts}) GROUP BY p, e, i)
        GROUP BY p, e) m USING (p, e)"""


#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op1_warc_index": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
             f AS (SELECT d, max(page_id) AS first, count(*) AS k FROM p WHERE n >= 1000 GROUP BY d)
        SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
               CASE WHEN f.k > 1 AND p.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.k > 1 AND p.page_id <> f.first THEN f.first END AS refers_to
        FROM p LEFT JOIN f USING (d)""",
    "op11_vector_codes": f"""
        WITH k AS ({_KEPT}),
             x AS (SELECT vec_id, label, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS v FROM (SELECT *, unnest(range(16)) AS p FROM k)),
             b0 AS (SELECT p, e, v AS c FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT 64) USING (vec_id)),
             a0 AS ({_assigned("b0")}), b1 AS ({_moved("b0", "a0")}), a1 AS ({_assigned("b1")}), b2 AS ({_moved("b1", "a1")}), a2 AS ({_assigned("b2")}),
             r AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id, label)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
        FROM r""",
    "op13_hard_negatives": f"""
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM ({_KEPT}) WHERE label IS NOT NULL),
             s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score
                   FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
             p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5""",
}
