"""The corpus pipeline: five operators of ``seriesmart.llm`` in a row over documents.

Each stage works on all that the stage before kept, as written and read again.
Stages drop whole documents (toxic ones, all but one of near duplicates, those
that hold a benchmark item), mask secrets, and at last turn the texts into
token ids, which are decoded again to see that nothing was lost.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart.llm import bpe, decontaminate, near_dup, secret_scan, toxicity
from seriesmart.llm.common import table
from seriesmart.llm.graph import stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each group of near duplicates: five-word shingles, similarity 0.8."""
    return near_dup.distinct(docs, spark, words=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edited copies included."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; ``n_chars`` follows the text."""
    out = secret_scan.redact(docs)
    return out.select(*[F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in out.dtypes])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    plain = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    both = bpe.round_trip(plain, public_tokenizers.path("byte_bpe_50k.json"), keep=True)
    return both.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       (F.col("decoded") == F.col("text")).alias("lossless"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("tokens", tokens),
]

#: SQL can't express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), spark, name)
    return STAGES[-1][1](spark, docs, sf_dir)
