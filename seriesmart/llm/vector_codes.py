"""Vector code compression: product codes, each part coded by slice-and-intersect bitmasks.

A vector is cut into equal consecutive parts; every part is coded by the index
of the nearest entry of its position's codebook (at most 64 entries, so that a
set of entries is one uint64).  Per dimension the entries' coordinates are
sorted once and carry *prefix masks*: the set of entries up to each place.  To
find the nearest entries of many parts at once:

1. *Initial radius*: the distance to a near guess, the best of the entries
   that are next to the part in each single dimension.
2. *Slice*: in every dimension, two binary searches of the sorted coordinates
   give the range within the radius, two prefix masks its entries.
3. *Intersect*: the masks of all dimensions are ANDed.  Every entry that is no
   farther than the guess is in all of them, so the candidates hold all nearest
   entries; their distances are compared exactly, in the order of their index.

Codebooks are learned in rounds: all parts are assigned, every task adds up its
parts by (position, entry), and only these sums (positions x entries rows a
task) are shuffled.  What the driver holds is the codebooks.

Defined results: rows whose vector is null, empty, or holds null or non-finite
components are dropped, also those of another length than the most frequent one
that the number of parts divides and those with components too large for exact
sums in a long (over 2^30/sqrt(length) after scaling).  Of equally near entries
the one of the lower index counts.  The codebooks start from the rows of least
id (rows without an id last; of equal ids, the least vector first); with fewer
rows than entries, there are as many entries as rows.  Repeated rows count as
often as they occur.  An empty table gives an empty result.  Further columns are
left out, whatever their names.  A sum of errors beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .graph import stored
from .vectors import common_length, integer_rows, matrix

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Rows that are coded at once.
SLICE = 4096
#: Labels up to which their sums are broadcast; beyond it, they are joined by a shuffle with this many salts.
BROADCAST_LABELS, SALTS = 100_000, 32


class Codebook:
    """The entries of one part position, ready for slice-and-intersect searches."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        none = np.zeros((1, entries.shape[1]), np.uint64)
        self.prefix = np.concatenate([none, np.bitwise_or.accumulate(bits, axis=0)])

    def distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((x - self.entries[entry]) ** 2).sum(axis=1)

    def near_guess(self, x: np.ndarray) -> np.ndarray:
        """The least squared distance to the entries next to the part in a single dimension."""
        best, last = None, len(self.entries) - 1
        for d in range(x.shape[1]):
            at = np.searchsorted(self.sorted[:, d], x[:, d])
            for place in (np.maximum(at - 1, 0), np.minimum(at, last)):
                got = self.distance(x, self.order[place, d])
                best = got if best is None else np.minimum(best, got)
        return best

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each part, the mask of the entries within the radius in every dimension."""
        mask = np.full(len(x), ~np.uint64(0))
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, side="right")
            mask &= self.prefix[high, d] & ~self.prefix[low, d]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each part's nearest entry, the lower index of equally near ones."""
        best = self.near_guess(x)
        radius = np.sqrt(best.astype(np.float64)).astype(np.int64) + 1  # at least the root, whatever its rounding
        mask = self.candidates(x, radius)
        found, best = np.zeros(len(x), np.int64), best + 1
        rows = np.arange(len(x))
        while len(rows):
            left = mask[rows]
            entry = _lowest(left)
            got = self.distance(x[rows], entry)
            better = got < best[rows]
            found[rows[better]], best[rows[better]] = entry[better], got[better]
            mask[rows] = left & (left - np.uint64(1))
            rows = rows[mask[rows] != 0]
        return found, best


def _lowest(mask: np.ndarray) -> np.ndarray:
    """Index of the lowest set bit (a power of two is exact as a double)."""
    bit = mask & (~mask + np.uint64(1))
    return np.frexp(bit.astype(np.float64))[1] - 1


def first_entries(rows: DataFrame, length: int, parts: int, entries: int) -> np.ndarray:
    """``[part, entry, component]`` of the rows with the least ids."""
    first = rows.orderBy(F.col("id").isNull(), "id", "code").select("code").limit(entries).collect()
    x = np.frombuffer(b"".join(bytes(r.code) for r in first), "<i8").reshape(-1, parts, length // parts)
    return x.transpose(1, 0, 2).copy()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE))


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: each entry the floor of its parts' mean, unused ones as they are."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books]
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in _slices(batches):
            x = matrix(batch.column(0), parts * width)
            for p, book in enumerate(search):
                part = x[:, p * width:(p + 1) * width]
                entry, _ = book.nearest(part)
                np.add.at(count[p], entry, 1)
                np.add.at(total[p], entry, part)
        p, e, c = (a.ravel() for a in np.meshgrid(np.arange(parts), np.arange(entries), np.arange(width), indexing="ij"))
        used = count[p, e] > 0
        yield pa.RecordBatch.from_arrays([pa.array(a[used].astype(np.int64)) for a in (p, e, c, count[p, e], total[p, e, c])], ["p", "e", "c", "n", "s"])

    sums = rows.select("code").mapInArrow(run, "p long, e long, c long, n long, s long")
    out = books.copy()
    # sums over very many rows may not fit a long: they are added up as decimals
    for r in sums.groupBy("p", "e", "c").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        out[r.p, r.e, r.c] = int(r.s) // r.n
    return out


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``(id, label, codes, error)`` of every row: the entries' indexes, a byte a part, and the summed distances."""
    parts, _, width = books.shape
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books]
        for batch in _slices(batches):
            x = matrix(batch.column(2), parts * width)
            codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, book in enumerate(search):
                codes[:, p], distance = book.nearest(x[:, p * width:(p + 1) * width])
                error += distance
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                                             ["id", "label", "codes", "error"])

    return rows.select("id", "label", "code").mapInArrow(run, f"id long, label {label}, codes binary, error long")


def _with_label_error(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Adds the error summed over equal labels, rows without a label together."""
    sums = stored(rows.groupBy("label").agg(F.try_sum("error").alias("label_error")), spark, "label_error")
    sums = sums.withColumnRenamed("label", "of")
    if sums.count() <= BROADCAST_LABELS:
        return rows.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    salt = F.pmod(F.xxhash64("id", "codes"), F.lit(SALTS)).cast("int")
    sums = sums.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("part"))
    return rows.withColumn("salt", salt).join(sums, same).drop("of", "salt", "part")


def compress(vectors: DataFrame, spark: SparkSession, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``(id, label, codes, error, label_error)`` of every kept row, and the codebooks ``[part, entry, component]``."""
    if not 1 <= entries <= 64:
        raise ValueError("a set of entries is one uint64: 1 to 64 entries")
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    length = common_length(plain, parts)
    rows = integer_rows(plain, spark, length)
    books = first_entries(rows, length, parts, entries) if length else np.zeros((parts, 0, 0), np.int64)
    if not books.shape[1]:
        empty = rows.filter("false").select("id", "label", F.col("code").alias("codes"), F.lit(0).cast("long").alias("error"))
        return empty.withColumn("label_error", F.col("error")), books
    for _ in range(rounds):
        books = refined(rows, books)
    return _with_label_error(stored(coded(rows, books), spark, "codes"), spark), books


def decoded(codes: bytes, books: np.ndarray) -> np.ndarray:
    """The integer components that a code stands for."""
    return np.concatenate([books[p, c] for p, c in enumerate(codes)])


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimals, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
