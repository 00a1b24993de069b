"""Hard-negative mining by a vertical scan of columnar blocks (BOND).

For every anchor, its *positives* are the ``k`` best other rows of its label, and
the *hard negatives* of a positive the first rows of other labels whose score
is at most the positive's and at least ``percent`` per cent of it.  A score is
the inner product of integer components.

Rows are cut into blocks, turned so that a dimension is a column, and sorted by
label.  Anchors are cut into blocks too; every pair of blocks is a unit of work
of bounded size, and only the best few rows of an anchor come out.  In a unit,
an anchor reads the dimensions in the order of its own descending magnitude, a
few at a time.  What the dimensions not yet read can add lies between the sums
of the columns' least and greatest contributions; so every candidate has a
lower and an upper bound, and the bitmap of candidates shrinks:

* positives: to the rows whose upper bound reaches the k-th best lower bound;
* negatives: to the rows whose bounds meet the windows of the positives' scores.

What is left when all dimensions are read has its exact score.

Defined results: rows without an id, a label or a vector take no part, nor those
with null or non-finite components, with another length than the most frequent
one, or with components too large for exact sums in a long (over
2^30/sqrt(length) after scaling).  Equal scores come by smaller id.  An anchor's
other rows are those of other ids; repeated rows count as often as they occur,
and repeated anchors are mined each.  A positive without a row in its window has
no result.  An empty table gives an empty result.  Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .graph import stored
from .vectors import common_length, integer_rows, matrix

#: Rows and anchors of a unit of work at most (before the hash's unevenness), and dimensions read at once.
ROWS, ANCHORS, STEP = 8192, 4096, 8


class Block:
    """Some rows as columns, sorted by label."""

    def __init__(self, table: pa.Table, length: int):
        label = table.column("label").to_pylist()
        self.labels = {x: i for i, x in enumerate(dict.fromkeys(label))}
        of = np.array([self.labels[x] for x in label], np.int64)
        order = np.argsort(of, kind="stable")
        self.ids = np.array(table.column("id"))[order]
        rows = matrix(table.column("code"), length)[order]
        # sums of products below 2^53 are exact as doubles, and faster
        self.exact = float(np.abs(rows).max(initial=0)) ** 2 * length >= 2 ** 53
        self.columns = np.ascontiguousarray(rows.T.astype(np.int64 if self.exact else np.float64))
        self.start = np.searchsorted(of[order], np.arange(len(self.labels) + 1))
        self.bounds: dict = {}

    def of_label(self, label) -> slice:
        at = self.labels.get(label)
        return slice(0, 0) if at is None else slice(int(self.start[at]), int(self.start[at + 1]))

    def least_and_greatest(self, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Of each column, within some rows."""
        key = (part.start, part.stop)
        if key not in self.bounds:
            own = self.columns[:, part]
            self.bounds[key] = own.min(axis=1), own.max(axis=1)
        return self.bounds[key]

    def scan(self, anchor: np.ndarray, part: slice, alive: np.ndarray, low: float, high: float, best: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the rows of a part whose score is from ``low`` to ``high``.

        ``alive`` is the bitmap of the part's candidates.  With ``best``, ``low``
        rises to the score that this many rows reach.
        """
        if not alive.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        least, greatest = self.least_and_greatest(part)
        order = np.argsort(-np.abs(anchor), kind="stable")
        q = anchor[order].astype(self.columns.dtype)
        ends = np.stack([q * least[order], q * greatest[order]])
        more = np.zeros((2, len(q) + 1), self.columns.dtype)  # what the dimensions from here on add, at least and at most
        more[0, :-1] = ends.min(axis=0)[::-1].cumsum()[::-1]
        more[1, :-1] = ends.max(axis=0)[::-1].cumsum()[::-1]
        rows, own = np.flatnonzero(alive), self.columns[:, part]
        sums, dense = np.zeros(own.shape[1], self.columns.dtype), True
        for at in range(0, len(q), STEP):
            dims = order[at:at + STEP]
            if dense:
                sums = sums + q[at:at + STEP] @ own[dims]
                now = sums[rows]
            else:
                now = now + q[at:at + STEP] @ own[np.ix_(dims, rows)]
            done = min(at + STEP, len(q))
            if len(rows) > best > 0:
                low = max(low, np.partition(now, len(now) - best)[len(now) - best] + more[0, done])
            keep = (now + more[1, done] >= low) & (now + more[0, done] <= high)
            rows, now = rows[keep], now[keep]
            if not len(rows):
                break
            dense = dense and 8 * len(rows) > own.shape[1]
        return rows + part.start, now.astype(np.int64)

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the best k, equal scores by smaller id."""
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return list(zip(scores[order].tolist(), self.ids[rows[order]].tolist()))


def _units(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int):
    """Rows and anchors, grouped so that every block of rows meets every block of anchors."""
    r, a = -(-n_rows // ROWS), -(-n_anchors // ANCHORS)
    place = lambda n: F.pmod(F.col("place"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("r", place(r)).withColumn("a", every(a))
    right = anchors.withColumn("a", place(a)).withColumn("r", every(r))
    return left.groupBy("r", "a").cogroup(right.groupBy("r", "a"))


def _best(found: DataFrame, by: list[str], k: int, as_rank: str) -> DataFrame:
    """The best k rows ``(.., score, id)`` of each group; Spark cuts each task's share to k before it is shuffled."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn(as_rank, F.row_number().over(order)).filter(F.col(as_rank) <= k)


def _positives(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], length: int, k: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, out = Block(left, length), []
        for place, id_, label, q in zip(right.column("place").to_pylist(), right.column("id").to_pylist(),
                                        right.column("label").to_pylist(), matrix(right.column("code"), length)):
            part = block.of_label(label)
            got = block.scan(q, part, block.ids[part] != id_, -np.inf, np.inf, k)
            out += [(place, *x) for x in block.first(*got, k)]
        return _table(out, ["place", "score", "id"])

    return _units(rows, anchors, *sizes).applyInArrow(run, "place long, score long, id long")


def _negatives(rows: DataFrame, anchors: DataFrame, sizes: tuple[int, int], length: int, k: int, percent: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, out = Block(left, length), []
        every = slice(0, len(block.ids))
        for place, label, scores, q in zip(right.column("place").to_pylist(), right.column("label").to_pylist(),
                                           right.column("scores").to_pylist(), matrix(right.column("code"), length)):
            windows = [(-(-percent * p // 100), p) for p in sorted(set(scores)) if percent * p <= 100 * p]
            if not windows:
                continue
            alive = np.ones(len(block.ids), bool)
            alive[block.of_label(label)] = False
            found, score = block.scan(q, every, alive, windows[0][0], windows[-1][1])
            for low, high in windows:
                inside = (score >= low) & (score <= high)
                out += [(place, high, *x) for x in block.first(found[inside], score[inside], k)]
        return _table(out, ["place", "window", "score", "id"])

    return _units(rows, anchors, *sizes).applyInArrow(run, "place long, window long, score long, id long")


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def mine(vectors: DataFrame, spark: SparkSession, is_anchor: Column, k: int = 5, percent: int = 80,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the column ``id``.
    """
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    plain = plain.filter("id IS NOT NULL AND label IS NOT NULL").withColumn("place", F.monotonically_increasing_id())
    length = common_length(plain)
    rows = integer_rows(plain, spark, length)
    anchors = rows.filter(is_anchor)
    sizes = rows.count(), anchors.count()
    if not all(sizes):
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    positives = stored(_best(_positives(rows, anchors, sizes, length, k), ["place"], k, "nth"), spark, "positives")
    scores = positives.groupBy("place").agg(F.collect_set("score").alias("scores"))  # at most k of an anchor
    asked = stored(anchors.join(scores, "place"), spark, "anchors")
    found = _negatives(rows, asked, sizes, length, k, percent)
    best = _best(found, ["place", "window"], k, "rank").select("place", F.col("window").alias("positive_score"), "rank",
                                                               F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    own = positives.select("place", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    named = own.join(anchors.select("place", F.col("id").alias("anchor_id")), "place")
    return named.join(best, ["place", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
