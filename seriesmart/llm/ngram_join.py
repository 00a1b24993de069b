"""N-gram Jaccard join by prefixes of token combinations.

A text's set holds its distinct word shingles, as 64-bit hashes (tokens).  Texts
with equal sets form a class, one vertex from here on.  A set of n tokens
differs from a linked one in at most D = n - ceil(t n) of its own tokens.

1. *Extended prefixes*: of all sets, the first D + 1 tokens in the order of
   their hash and a quarter more.  The one of two linked sets whose prefix ends
   first has all but D of its prefix in the other's.  So a set is linked with
   nothing if fewer of its prefix are in other prefixes than its smallest
   possible partner would have in common with it.
2. *Classes of tokens*: of the sets left, all tokens are counted and put in the
   order of their frequency.  Tokens that one set alone holds need no index,
   rare tokens (up to ``RARE`` sets) are indexed one by one, and frequent tokens
   in combinations of two: those of one part, parts dealt by hash.  A set is
   indexed at its level, the power of two of its size, and at that of its
   largest possible partner, as the number of parts depends on the level.
3. *Prefixes by combinations*: D lost tokens break up every pair of a part only
   if they are all but one of its tokens.  So a prefix ends where its rare
   tokens, and its frequent tokens less one a part, come to D + 1; linked sets
   then share a rare token or a pair.  (Let P be the prefix that ends first.
   What it shares with the other set lies in the other prefix too; were this no
   rare token and at most one token a part, more than D would be lost.)
4. *Verification*: in a bucket of the index, every vertex is compared with the
   bucket's hub, the one with the fewest tokens of its own, on the whole sets.
   Buckets that then still hold several components go, put together by their
   main component, block against block; only links come out, no more than join
   the components, and pairs never become rows.

Nothing but tokens held by very many sets is broadcast (at most ``HOT_TOKENS``,
as each has that share of all tokens), and the list of texts to be read again up
to ``common.BROADCAST_ROWS``; beyond it they are joined by a shuffle.

Defined results: null and empty texts, and texts of white space, have no
tokens, are linked with nothing and are their own component; a text with fewer
words than a shingle has its whole sequence as the one token; repeated rows fall
into the same class; a null id never is the least one (a class of null ids only
has a null component); an empty table gives an empty result; further columns are
left out.  Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import bounded, id_text, let, map_column
from .graph import components, stored
from .near_dup import hashed, words_of

#: Sets that hold a rare token at most, and tokens of a part that a prefix needs on average.
RARE, PART = 16, 2
#: Tokens that are broadcast at most (each with more than this share of all tokens), and the least sets such a token has.
HOT_TOKENS, HOT_SETS = 100_000, 5_000
#: Tokens of a block of vertices that are compared in one task.
BLOCK = 1_000_000


def spare(n, percent: int):
    """D, the tokens of a set of n that a linked set may lack."""
    return n - (percent * n + 99) // 100


def screened(n, percent: int):
    """Length of the extended prefix of the first step."""
    first = spare(n, percent) + 1
    return min(n, first + (first + 3) // 4)


def _sketch(plain: DataFrame, k: int, percent: int) -> DataFrame:
    """Replace ``text`` by n, set_id and the extended prefix in the order of the hashes."""
    def run(texts: list) -> dict:
        out: dict[str, list] = {"n": [], "set_id": [], "prefix": []}
        for text in texts:
            h = hashed(words_of(text), k)
            out["n"].append(len(h))
            out["set_id"].append(_set_id(h) if len(h) else None)
            out["prefix"].append(h[:screened(len(h), percent) if len(h) > 1 else 0].view(np.int64))
        return out

    return map_column(plain, "text", "n long, set_id binary, prefix array<long>", run)


def _set_id(h: np.ndarray) -> bytes:
    return blake2b(h.tobytes(), digest_size=16).digest()


def _tokens(sets: DataFrame, col: str) -> DataFrame:
    """``(v, h)``: a row for every token of the array column."""
    return sets.select("v", F.explode(col).alias("h"))


def _joined(run, rows: int = 50_000):
    """``run`` with its small batches put together."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return whole


def _shared(tokens: DataFrame, spark: SparkSession) -> DataFrame:
    """``(h, f)`` of the tokens that several sets hold."""
    return stored(tokens.groupBy("h").agg(F.count("*").alias("f")).filter("f > 1"), spark, "shared")


def _with_frequency(tokens: DataFrame, shared: DataFrame) -> DataFrame:
    """``(v, h, f)`` of the tokens that several sets hold; very frequent ones are joined without a shuffle of their rows."""
    total = shared.agg(F.sum("f")).first()[0] or 0
    many = max(HOT_SETS, total // HOT_TOKENS)
    hot = F.broadcast(shared.filter(F.col("f") > many).withColumnRenamed("f", "hot_f"))
    both = tokens.join(hot, "h", "left")
    rest = both.filter("hot_f IS NULL").select("v", "h").join(shared.filter(F.col("f") <= many).hint("merge"), "h")
    return both.filter("hot_f IS NOT NULL").select("v", "h", F.col("hot_f").alias("f")).union(rest.select("v", "h", "f"))


def levels(n: int, percent: int) -> list[int]:
    """The levels of a set's size and of the size of its largest possible partner."""
    return sorted({n.bit_length(), (100 * n // percent).bit_length()})


def parts_of(level: int, percent: int) -> int:
    return max(1, (100 - percent) * (1 << level - 1) // (100 * PART))


def index_keys(h: np.ndarray, f: np.ndarray, n: int, percent: int) -> np.ndarray:
    """The index keys of a set of n tokens, those of them that other sets hold given with their frequencies."""
    alone, need = n - len(h), spare(n, percent) + 1
    if n < 2 or alone >= need:
        return np.empty(0, np.uint64)
    order = np.lexsort((h, f))
    h, rare, keys = h[order], f[order] <= RARE, []
    for level in levels(n, percent):
        # a frequent token counts where its part has had one already
        part = np.where(rare, -1, (h % np.uint64(parts_of(level, percent))).astype(np.int64))
        first = np.zeros(len(h), bool)
        first[np.unique(part, return_index=True)[1]] = True
        end = int(np.searchsorted(np.cumsum(rare | ~first), need - alone)) + 1
        level = np.uint64(level)
        keys.append(_mix(h[:end][rare[:end]] + level))
        frequent = np.flatnonzero(~rare[:end])
        frequent = frequent[np.argsort(part[frequent], kind="stable")]
        for own in np.split(h[frequent], np.flatnonzero(np.diff(part[frequent])) + 1):
            a, b = _two_of(len(own))
            keys.append(_mix(_mix(own[a] + level) + own[b]))
    return np.unique(np.concatenate(keys))


@lru_cache(maxsize=256)
def _two_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _index(sets: DataFrame, percent: int) -> DataFrame:
    """``(key, v, n, s)`` of sets ``(v, n, tokens)``, s the tokens that other sets hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(2)
            ends = np.concatenate([[0], np.cumsum(np.array(tokens.value_lengths()))])
            f, h = (np.array(x) for x in tokens.flatten().flatten())
            for i, (v, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                own = slice(ends[i], ends[i + 1])
                keys = index_keys(h[own].view(np.uint64), f[own], n, percent)
                made = [keys.view(np.int64), *(np.full(len(keys), x) for x in (v, n, ends[i + 1] - ends[i]))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["key", "v", "n", "s"])

    return sets.select("v", "n", "tokens").mapInArrow(_joined(run), "key long, v long, n long, s long")


def _reach(x: str, y: str, percent: int) -> Column:
    """Whether two sets can be linked, by their sizes and the tokens that other sets hold."""
    both = f"least({x}.s, {y}.s)"
    return F.expr(f"100 * {both} >= {percent} * ({x}.n + {y}.n - {both})")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the similarity (row by row within Spark, as two long
    sets of every row would make large batches for a Python worker)."""
    own = sets.select("v", "n", "set")
    both = pairs.join(own.toDF("b", "n_b", "set_b"), "b").join(own.toDF("a", "n_a", "set_a"), "a")
    common = let(F.size(F.array_intersect("set_a", "set_b")), lambda k: 100 * k >= percent * (F.col("n_a") + F.col("n_b") - k))
    return both.filter(common).select("a", "b")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets reach the similarity."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _left(member: DataFrame, percent: int, spark: SparkSession) -> DataFrame:
    """``(main, v, n, s, c)``: vertices of the buckets that still hold several components, by the bucket's main one.

    A bucket's main component is that of the most of its vertices.  Vertices that
    meet in many buckets of one main component come once, so whole sets are sent
    about once a vertex instead of once an index key.
    """
    smallest = member.groupBy("key").agg(F.min("n").alias("least_n"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 != c1")
    # by the sizes of its bucket, a vertex can be linked with some vertex there
    able = (member.join(smallest.select("key", "least_n"), "key")
            .filter(f"100 * s >= {percent} * (n + greatest(least_n, s) - s)").select("key", "v", "n", "s", "c"))
    able = stored(able, spark, "able")
    per = able.groupBy("key", "c").agg(F.count("*").alias("m"))
    main = per.groupBy("key").agg(F.max_by("c", F.struct("m", -F.col("c"))).alias("main"), F.count("*").alias("comps")).filter("comps > 1")
    return stored(able.join(main.select("key", "main"), "key").select("main", "v", "n", "s", "c").distinct(), spark, "left")


def _rest(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of vertices ``(main, v, n, s, c)``, no more than join them.

    The vertices of a main component are cut into blocks of about ``BLOCK``
    tokens; every two blocks, and each with itself, are a unit of work.
    """
    size = left.groupBy("main").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    units = (left.join(size, "main").withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("main", "v", "n", "s", "c", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))

    def run(unit: pa.Table) -> pa.Table:
        unit = unit.sort_by("n")
        v, n, s, own = (unit.column(x).to_numpy() for x in ("v", "n", "s", "own"))
        comp = np.unique(unit.column("c").to_numpy(), return_inverse=True)[1]
        crossing = unit.column("i")[0].as_py() != unit.column("j")[0].as_py()
        lists = unit.column("set").combine_chunks()
        ends, flat = np.concatenate([[0], np.cumsum(np.array(lists.value_lengths()))]), np.array(lists.flatten())
        held = [flat[x:y] for x, y in zip(ends, ends[1:])]
        out = []
        for i in range(len(v) - 1):
            end = np.searchsorted(n, 100 * n[i] // percent, side="right")  # larger ones can't be linked
            both = np.minimum(s[i], s[i + 1:end])
            open_ = (comp[i + 1:end] != comp[i]) & (100 * both >= percent * (n[i] + n[i + 1:end] - both))
            if crossing:
                open_ &= own[i + 1:end] != own[i]
            for j in (np.flatnonzero(open_) + i + 1).tolist():
                if comp[i] != comp[j] and linked(held[i], held[j], percent):
                    out.append((v[i], v[j]))
                    comp[comp == comp[j]] = comp[i]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return units.join(sets.select("v", "set"), "v").groupBy("main", "i", "j").applyInArrow(run, "a long, b long")


def _whole_sets(plain: DataFrame, asked: DataFrame, k: int, spark: SparkSession) -> DataFrame:
    """``(v, n, set)`` of the asked classes, from the text of the row that stands for each.

    Rows are found by id and text key; texts whose keys collide are told apart by the set.
    """
    wanted = asked.select(F.col("first").alias("id"), F.col("key").alias("own_key"), "v", "set_id")
    wanted = bounded(wanted)
    found = plain.withColumn("key", F.xxhash64("text")).join(wanted, (F.col("key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("id")))

    def run(texts: list) -> dict:
        sets = [hashed(words_of(t), k) for t in texts]
        return {"n": [len(h) for h in sets], "got": [_set_id(h) for h in sets], "set": [h.view(np.int64) for h in sets]}

    sets = map_column(found.select("v", "set_id", "text"), "text", "n long, got binary, set array<long>", run)
    sets = stored(sets.filter("got = set_id").select("v", "n", "set"), spark, "sets")
    if sets.count() > sets.select("v").distinct().count():  # repeated rows, with the same id and text
        sets = stored(sets.dropDuplicates(["v"]), spark, "sets")
    return sets


def classes(docs: DataFrame, spark: SparkSession, words: int = 5, percent: int = 80,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    Rows are linked whose sets of ``words``-word shingles have at least
    ``percent`` per cent in common; component_id is the least id reachable.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent: over 50 (prefixes of pairs need two common tokens), 100 at most")
    plain = id_text(docs, id_col, text_col)
    rows = stored(_sketch(plain.withColumn("key", F.xxhash64("text")), words, percent).withColumn("v", F.monotonically_increasing_id()), spark, "sketch")
    # The row that stands for its class: that of the least id, and of these that of the least key.  Its prefix
    # comes with it, so prefixes are shuffled once.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "v", "n", "prefix")).alias("x")
    stand = stored(rows.filter("n > 0").groupBy("set_id").agg(first).select("set_id", F.col("x.doc_id").alias("first"), "x.key", "x.v", "x.n", "x.prefix"), spark, "classes")

    # 1: sets that share enough of their extended prefix with others
    prefixes, stand = _tokens(stand, "prefix"), stand.drop("prefix")
    held = _with_frequency(prefixes, _shared(prefixes, spark)).groupBy("v").agg(F.count("*").alias("held"))
    small = stand.select("v", F.expr(f"({percent} * n + 99) div 100").alias("n"))  # the smallest partner's size, and its D
    bound = small.withColumn("d", F.expr(f"n - ({percent} * n + 99) div 100")).selectExpr("v", "least(n, d + 1 + (d + 4) div 4) - d AS least")
    some = stored(held.join(bound, "v").filter("held >= least").select("v"), spark, "screened")
    asked = stored(stand.join(some, "v"), spark, "asked")

    # 2, 3: index keys by classes of tokens
    sets = _whole_sets(plain, asked, words, spark)
    tokens = _tokens(sets, "set")
    known = (_with_frequency(tokens, _shared(tokens, spark)).groupBy("v").agg(F.collect_list(F.struct("f", "h")).alias("tokens"))
             .join(sets.select("v", "n"), "v"))
    index = stored(_index(known, percent), spark, "index")
    member = stored(index.join(index.groupBy("key").count().filter("count > 1"), "key", "left_semi"), spark, "index")

    # 4: hubs, then the rest
    hubs = member.groupBy("key").agg(F.min(F.struct((F.col("n") - F.col("s")).alias("own"), "v", "n", "s")).alias("y"))
    pairs = (member.alias("x").join(hubs, "key").filter("x.v != y.v").filter(_reach("x", "y", percent))
             .select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b")).distinct())
    pairs = stored(pairs, spark, "pairs")  # of known size: few are joined to the sets without moving these
    links = stored(_verified(pairs, sets, percent), spark, "linked")
    member = member.join(components(links, spark), "v", "left").withColumn("c", F.coalesce("c", "v"))
    links = links.union(stored(_rest(_left(member, percent, spark), sets, percent), spark, "rest"))

    of = stand.join(components(links, spark), "v", "left").withColumn("c", F.coalesce("c", "v"))
    least_id = of.groupBy("c").agg(F.min("first").alias("component_id"))
    of = of.join(least_id, "c").select("set_id", "component_id")
    return (rows.select("doc_id", "n", "set_id").join(of, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
