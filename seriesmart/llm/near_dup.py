"""Near-duplicate classes: MinHash bands, sequential Bayesian verification, exact check.

1. *Sketch* (one pass over the texts): the set of word shingles as 64-bit
   hashes, a digest of the set, a MinHash signature and its band keys.  Texts
   with equal sets form a class; from here on a class is one vertex.
2. *Candidates*: vertices that share a band key.  In a bucket every vertex is
   compared with the bucket's hub only, the vertex with the fewest shingles that
   no other candidate has, i.e. the one closest to the common text.
3. *Verification*: signatures are compared batch by batch.  With a uniform
   prior, a pair is dropped once the posterior probability that its similarity
   reaches the threshold is below ``MISS``.  Survivors are verified exactly on
   the full shingle sets of both texts.
4. *Rest*: components of these links are taken; then what a bucket still holds
   in different components is compared in the same way, block against block
   within a task, unless the shingles that nobody shares rule it out exactly.
   Only links come out, no more than join the components; pairs never become
   rows.  So no link between components is lost to the hubs.

With 32 bands of 5 hashes, a pair of similarity 0.8 has no common band with
probability (1 - 0.8^5)^32 = 3e-6; the Bayesian batches add at most 5 x MISS.

Defined results: null and empty texts, and texts of white space, have no
shingles, are linked with nothing and are their own component; a text with
fewer words than a shingle has its whole sequence as the one shingle; repeated
rows fall into the same class; a null id never is the least one (a class of null
ids only has a null component); an empty table gives an empty result; further
columns are left out.  Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import bounded, id_text, map_column, named, unused
from .graph import components, stored

BANDS, ROWS = 32, 5
#: Signature values that are compared at once, and the chosen miss probability of each comparison.
BATCH, MISS = 32, 1e-6
#: Shingles that are hashed at once, and of a block of vertices that are compared in one task.
STEP, BLOCK = 2048, 250_000


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case (both are what bytes do)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k))))


def hashed(words: list[bytes], k: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        if len(words) < k:
            got = h[:1]
            for x in h[1:]:
                got = _mix(got * np.uint64(0x9E3779B97F4A7C15) + x)
            return got + np.uint64(len(words))
        n = len(h) - k + 1
        got = h[:n].copy()
        for i in range(1, k):
            got = _mix(got * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(got)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    a = rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64)[:, None]


def minhash(h: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the shingles (32 bits)."""
    a, b = _functions()
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), STEP):
        part = ((h[at:at + STEP] * a + b) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, part.min(axis=1), out=least)
    return least


def sketch(df: DataFrame, k: int) -> DataFrame:
    """Replace ``text`` by n (shingles), set_id and sig (16 bits a value)."""
    def run(texts: list) -> dict:
        out: dict[str, list] = {"n": [], "set_id": [], "sig": []}
        for text in texts:
            h = hashed(words_of(text), k)
            out["n"].append(len(h))
            out["set_id"].append(_set_id(h) if len(h) else None)
            out["sig"].append(minhash(h).astype(np.uint16).tobytes() if len(h) else None)
        return out

    return map_column(df, "text", "n long, set_id binary, sig binary", run)


def _set_id(h: np.ndarray) -> bytes:
    return blake2b(h.tobytes(), digest_size=16).digest()


def _band_keys(sig: str) -> Column:
    """One hash of the signature values of each band."""
    size = 2 * ROWS
    return F.array(*[F.xxhash64(F.substring(sig, 1 + size * b, size)) for b in range(BANDS)])


@lru_cache(maxsize=8)
def least_matches(percent: int) -> list[tuple[int, int]]:
    """(values compared, matches needed): with fewer matches m of n, the posterior
    P(similarity >= t) = P(Binomial(n + 1, t) <= m) of a uniform prior is below MISS."""
    t, out = percent / 100, []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        total, m = 0.0, -1
        while total < MISS:
            m += 1
            total += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _likely(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b, sig_a, sig_b)`` that no batch of signature values rules out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = BANDS * ROWS
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, size) for c in (2, 3))
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, np.int64)
            for n, least in least_matches(percent):
                matches[alive] += (x[alive, n - BATCH:n] == y[alive, n - BATCH:n]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield batch.select([0, 1]).take(pa.array(alive))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b, text_a, text_b)`` whose shingle sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lru_cache(maxsize=16)(lambda text: shingles(words_of(text), k))
        for batch in batches:
            good = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = of(s), of(t)
                both = len(x & y)
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _own(texts: DataFrame, k: int) -> DataFrame:
    """``(v, own)``: how many shingles of each candidate no other candidate has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = hashed(words_of(text), k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), v)), pa.array(h.view(np.int64))], ["v", "h"])

    every = texts.select("v", "text").mapInArrow(run, "v long, h long")
    return (every.groupBy("h").agg(F.count("*").alias("n"), F.min("v").alias("v")).filter("n = 1")
            .groupBy("v").agg(F.count("*").alias("own")))


def classes(docs: DataFrame, spark: SparkSession, words: int = 5, percent: int = 80,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    Rows are linked whose sets of ``words``-word shingles have at least
    ``percent`` per cent in common; component_id is the least id reachable.
    """
    found = _found(docs, spark, words, percent, id_col, text_col)
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _found(docs: DataFrame, spark: SparkSession, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, key, n, component_id, component_key)`` of every row, the last two of the row that stands
    for its component: that of the least id, and of these that of the least key."""
    plain = id_text(docs, id_col, text_col)
    rows = stored(sketch(plain.withColumn("key", _key("text")), words).withColumn("v", F.monotonically_increasing_id()), spark, "sketch")
    # The row that stands for its class: that of the least id, and of these that of the least key.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "v"))
    stand = stored(rows.filter("n > 0").groupBy("set_id").agg(first.alias("x")).select("set_id", F.col("x.doc_id").alias("first"), "x.key", "x.v"), spark, "classes")
    vertices = stored(rows.select("v", "n", "sig").join(stand.select("v"), "v", "left_semi"), spark, "vertices")

    member = vertices.select("v", "n", F.posexplode(_band_keys("sig")).alias("band", "key"))
    full = member.groupBy("band", "key").agg(F.count("*").alias("m")).filter("m > 1")
    member = stored(member.join(full, ["band", "key"]).select("v", "n", "band", "key"), spark, "members")
    candidates = stored(member.select("v").distinct().join(stand, "v"), spark, "candidates")
    texts = stored(_texts(plain, candidates, words), spark, "texts")
    if texts.count() > texts.select("v").distinct().count():  # repeated rows, with the same id and text
        texts = stored(texts.dropDuplicates(["v"]), spark, "texts")
    own = texts.select("v").join(_own(texts, words), "v", "left").select("v", F.coalesce("own", F.lit(0)).alias("own"))
    member = stored(member.join(own, "v").withColumn("shared", F.col("n") - F.col("own")), spark, "members")

    reach = f"100 * least(x.shared, y.shared) >= {percent} * (x.n + y.n - least(x.shared, y.shared))"
    hubs = member.groupBy("band", "key").agg(F.min(F.struct("own", "v", "n", "shared")).alias("y"))
    pairs = (member.alias("x").join(hubs, ["band", "key"]).filter("x.v != y.v AND " + reach)
             .select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b")).distinct())
    links = _verified(pairs, vertices, texts, words, percent, spark)
    of = components(links, spark)

    # What is still apart: a vertex stays if some vertex of its bucket's sizes could be close enough.
    member = member.join(of, "v", "left").withColumn("c", F.coalesce("c", "v"))
    apart = member.groupBy("band", "key").agg(F.min("n").alias("least_n"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 != c1")
    close = (member.join(apart.select("band", "key", "least_n"), ["band", "key"])
             .filter(f"100 * shared >= {percent} * (n + greatest(least_n, shared) - shared)"))
    close = stored(close.select("v", "n", "shared", "c", "band", "key"), spark, "close")
    links = links.union(stored(_rest(close, vertices, texts, words, percent), spark, "rest"))

    of = components(links, spark)
    least = (stand.join(of, "v", "left").withColumn("c", F.coalesce("c", "v")))
    first = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "key")).alias("x")
    least = least.join(least.groupBy("c").agg(first), "c").select("set_id", F.col("x.first").alias("component_id"), F.col("x.key").alias("component_key"))
    return rows.select("doc_id", "key", "n", "set_id").join(least, "set_id", "left").drop("set_id")


def _key(text: str | Column) -> Column:
    """With the id, what a row is known by wherever its table is read again."""
    return F.xxhash64(text)


def _texts(plain: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``(v, text)``: the text of the row that stands for each candidate class, once for each repetition of that row."""
    # By the id and the text's key: rows that share an id (or have none) only meet the class that is theirs.
    own = (F.col("key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("id"))
    candidates = bounded(candidates.select(F.col("first").alias("id"), F.col("key").alias("own_key"), "v", "set_id"))
    wanted = plain.withColumn("key", _key("text")).join(candidates, own)
    # Texts whose keys collide: only those with the class's own set.
    checked = map_column(wanted.select("v", "set_id", "text"), "text", "got binary, text string", lambda texts: {
        "got": [_set_id(hashed(words_of(t), k)) for t in texts], "text": texts})
    return checked.filter("got = set_id").select("v", "text")


def _verified(pairs: DataFrame, vertices: DataFrame, texts: DataFrame, k: int, percent: int, spark: SparkSession) -> DataFrame:
    sig = vertices.select("v", "sig")
    both = (pairs.join(sig.toDF("b", "sig_b"), "b").join(sig.toDF("a", "sig_a"), "a"))
    likely = stored(_likely(both, percent), spark, "likely")
    both = likely.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    return stored(_linked(both, k, percent), spark, "linked")


def _rest(close: DataFrame, vertices: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between the components that vertices ``(v, n, shared, c, band, key)`` of a bucket are in.

    A bucket is cut into blocks of about ``BLOCK`` shingles; every two of them
    (and each with itself) make a unit of work, in which pairs are compared
    without ever being rows of a table, and only links come out, no more than
    join the unit's components.
    """
    size = close.groupBy("band", "key").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    units = (close.join(size, ["band", "key"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("v", "n", "shared", "c", "band", "key", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    full = units.join(vertices.select("v", "sig"), "v").join(texts, "v")

    def run(unit: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("v")
        v, n, shared, own = (rows[c].to_numpy() for c in ("v", "n", "shared", "own"))
        comp = np.unique(rows["c"], return_inverse=True)[1]
        sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(-1, BANDS * ROWS)
        sets = lru_cache(maxsize=None)(lambda i: shingles(words_of(rows["text"].iat[i]), k))
        band, out = int(unit[0]), []
        for i in range(len(v) - 1):
            near = np.minimum(shared[i], shared[i + 1:])
            apart = (comp[i + 1:] != comp[i]) & (100 * near >= percent * (n[i] + n[i + 1:] - near))
            if unit[2] != unit[3]:
                apart &= own[i + 1:] != own[i]
            others = np.flatnonzero(apart) + i + 1
            matches = np.zeros(len(others), np.int64)
            for m, least in least_matches(percent):
                matches += (sig[others, m - BATCH:m] == sig[i, m - BATCH:m]).sum(axis=1)
                alive = matches >= least
                others, matches = others[alive], matches[alive]
            # a pair belongs to the first band that it has in common
            same = (sig[others].reshape(-1, BANDS, ROWS) == sig[i].reshape(BANDS, ROWS)).all(axis=2)
            for j in others[same.argmax(axis=1) == band] if len(others) else ():
                if comp[i] != comp[j]:
                    both = len(sets(i) & sets(int(j)))
                    if 100 * both >= percent * (n[i] + n[j] - both):
                        out.append((v[i], v[j]))
                        comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return full.groupBy("band", "key", "i", "j").applyInPandas(run, "a long, b long")


def kept(df: DataFrame) -> DataFrame:
    """Adds ``kept``: true for the document that stands for its component."""
    return df.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct(docs: DataFrame, spark: SparkSession, words: int = 5, percent: int = 80,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns: that of the least id (of its texts, that of the least key).

    Decided row by row: rows of one id with different texts may be in different
    components.  Rows without an id stay, and rows without shingles.  Of
    repeated rows with the same id and text, one stays.
    """
    found = stored(_found(docs, spark, words, percent, id_col, text_col).filter("doc_id IS NOT NULL"), spark, "found")
    own_id, own_key = (unused(x, [*docs.columns, "doc_id", "key"]) for x in ("id", "own_key"))
    same = (named(id_col).cast("long") == F.col(own_id)) & (_key(F.coalesce(named(text_col), F.lit(""))) == F.col(own_key))

    def rows(of: DataFrame, name: str) -> DataFrame:
        return bounded(stored(of.select(F.col("doc_id").alias(own_id), F.col("key").alias(own_key)).distinct(), spark, name))

    gone = rows(found.filter("n > 0 AND (doc_id != component_id OR key != component_key)"), "gone")
    out = docs.join(gone, same, "left_anti")
    again = rows(found.groupBy("doc_id", "key").count().filter("count > 1"), "again")
    if again.limit(1).count():  # only rows that repeat are shuffled with their texts
        out = out.join(again, same, "left_anti").union(out.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))
    return out
