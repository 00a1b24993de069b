"""Quality by a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and runs of signs, in lower case, are hashed alone and in pairs into
``BUCKETS`` buckets.  Two multinomials are counted: of the trusted documents
and of the whole raw corpus.  A document's score is the mean, over its n-grams,
of log(p_trusted / p_raw); a document is kept if the base rules hold and the
score reaches ``THRESHOLD``.  The counts of the corpus cover all documents;
trusted are up to ``TRUSTED`` documents labelled good (those whose ids hash
lowest), so that their ids may be broadcast.

Every count within a document is made inside its row, by array functions, so
that no text and no word is shuffled; only bucket counts are.

Defined results: a null or empty text has no words and fails the base rules; a
text without n-grams scores 0; null ids are never trusted; an id with
contradicting labels isn't trusted; without labels every score is 0 (but for rounding); repeated
rows give repeated results; an empty table gives an empty result; further
columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, id_text, let

BUCKETS = 10_000
TRUSTED = 20_000
THRESHOLD = -0.1
SYMBOLS = "#*$%&|<>"
#: Base rules: least words, length of a repeated window, largest percentage of words in such windows.
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeated_words(word: Column, size: int = WINDOW) -> Column:
    """Words in windows of ``size`` words that the text has twice or more."""
    windows = F.when(F.size(word) > size, F.transform(
        F.sequence(F.lit(1), F.size(word) - size + 1), lambda i: F.xxhash64(F.slice(word, i, size)))).otherwise(F.array().cast("array<long>"))

    def covered(h: Column) -> Column:
        # (hash, place) in order: equal neighbours are the repeated windows.
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = let(by_hash, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])), lambda x: x["i"])))
        # A window adds what lies before the next one, at most itself.
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size)))),
            F.lit(0), lambda a, x: a + x))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))).cast("long")


def _signs(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def base(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with the counts of the base rules and base_failed."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        "doc_id", "text",
        let(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated"))).alias("word"),
        (F.length("text") - _signs(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        _signs(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    n, repeated = F.col("word.n"), F.col("word.repeated")
    return counted.select("doc_id", "text", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"),
                          ((n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)).alias("base_failed"))


def ngrams(text: Column) -> Column:
    """Buckets of the words and sign runs of a text, and of their neighbouring
    pairs; all pairs of a word with itself are one n-gram."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"), F.lit(0))
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(BUCKETS)).cast("int")
    return let(tokens, lambda t: F.concat(
        F.transform(t, lambda x: bucket(x)),
        F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda x, i: F.when(
            x == F.get(t, i), bucket(F.lit(" twice"))).otherwise(bucket(F.get(t, i), x)))))


def weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row: log(p_trusted / p_raw) of every bucket, in an array."""
    good = F.broadcast(trusted.select(F.col("doc_id"), F.lit(1).alias("good")))
    counts = (docs.join(good, "doc_id", "left").select(F.coalesce("good", F.lit(0)).alias("good"), F.explode(ngrams(F.col("text"))).alias("b"))
              .groupBy("b").agg(F.count("*").alias("raw"), F.sum("good").alias("own")))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left")
    listed = every.agg(F.array_sort(F.collect_list(F.struct("b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("own", F.lit(0)).alias("own")))).alias("s"),
                       F.coalesce(F.sum("raw"), F.lit(0)).alias("raws"), F.coalesce(F.sum("own"), F.lit(0)).alias("owns"))
    raw = lambda x: (x["raw"] + 1) / (F.col("raws") + BUCKETS)
    # The trusted counts are smoothed with the raw shares, so few trusted documents say little.
    return listed.select(F.transform("s", lambda x: F.log((x["own"] + BUCKETS * raw(x)) / (F.col("owns") + BUCKETS) / raw(x))).alias("w"))


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """Up to ``most`` ids whose labels all say good, those that hash lowest."""
    good = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q"), F.max("quality").alias("r"))
    return good.filter("q = 1 AND r = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id")


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base rules, base_failed, llr and kept of every row."""
    plain = id_text(docs, id_col, text_col)
    w = weights(plain, trusted_ids(labels)).scalar()
    rated = base(plain).withColumn("__w", w).withColumn("llr", let(ngrams(F.col("text")), lambda g: F.when(
        F.size(g) > 0, F.aggregate(g, F.lit(0.0), lambda a, b: a + F.get("__w", b)) / F.size(g)).otherwise(F.lit(0.0))))
    return rated.drop("text", "__w").withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
