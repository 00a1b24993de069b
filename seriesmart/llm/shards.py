"""Balanced label propagation: linked documents move to their neighbours' shards.

Documents with equal texts are linked.  Every document starts in a shard by
hash.  In a round, the members of each group are counted by shard; the group's
targets are the shards where most of it could be, with what is there and what
there is room for (as many as its size needs), and every linked document outside
them asks to move to one.  A shard
takes as many as its quota leaves room for: where more ask, a hash of document
and round decides, so no numbering is needed.  Rounds end when hardly any
document moves.  Documents without links give way: at the end what lies beyond
a shard's exact quota, unlinked documents first, fills the shards below theirs.

Law ``rows``: the shards' counts differ by at most one; slots are gapless.

Only narrow rows (ids, sizes, group keys, shards) are ever shuffled.  A group
is never gathered: its members are counted by partial aggregates and joined to
its one row of targets.  Numbers within a shard come from counts of small parts.

Defined results: a null text counts as empty (size 8, CRC 0, and linked with
other empty ones); null ids and repeated rows are rows like any other; an empty
table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import id_text
from .graph import stored

SHARDS, ROUNDS = 24, 10
#: Rows of a part that is numbered at once; share of linked documents that ends the rounds.
PART, SETTLED = 50_000, 0.002


def _unit(*seed: Column) -> Column:
    """A number in [0, 1) by hash."""
    return F.pmod(F.xxhash64(*seed), F.lit(1 << 30)) / float(1 << 30)


def _by_shard(values: dict[int, float], shards: int) -> Column:
    return F.array(*[F.lit(float(values.get(s, 0.0))) for s in range(shards)])


def propagate(rows: DataFrame, total: int, shards: int, spark: SparkSession) -> DataFrame:
    """``(r, shard)`` of the linked ``rows (r, g, shard)`` after the rounds."""
    quota = total / shards
    rows = stored(rows.select("r", "g", "shard"), spark, "shards")
    linked = rows.count()
    for turn in range(ROUNDS if linked else 0):
        cells = rows.groupBy("g", "shard").agg(F.count("*").alias("n"))
        load = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = {s: max(0.0, quota - load.get(s, 0)) for s in range(shards)}
        # Where most of the group could be: what is there and what there is room for.
        size = F.sum("n").over(Window.partitionBy("g"))
        free = F.element_at(_by_shard(room, shards), F.col("shard") + 1)
        order = Window.partitionBy("g").orderBy(F.desc(F.least("size", F.col("n") + F.col("free"))), F.desc("n"), F.xxhash64("g", "shard"))
        before = F.sum(F.col("n") + F.col("free")).over(order.rowsBetween(Window.unboundedPreceding, -1))
        target = (cells.withColumn("size", size).withColumn("free", free).withColumn("before", F.coalesce(before, F.lit(0.0)))
                  .filter("before < size").groupBy("g").agg(F.array_sort(F.collect_list("shard")).alias("targets")))
        asked = rows.join(target, "g").withColumn("to", F.when(F.array_contains("targets", F.col("shard")), F.col("shard")).otherwise(
            F.element_at("targets", (F.pmod(F.xxhash64("r", F.lit(turn)), F.size("targets")) + 1).cast("int"))))
        asked = stored(asked.select("r", "g", "shard", "to"), spark, "asked")
        wishes = {r.to: r.n for r in asked.filter("shard != to").groupBy("to").agg(F.count("*").alias("n")).collect()}
        share = {s: min(1.0, room[s] / n) for s, n in wishes.items()}
        taken = _unit(F.col("r"), F.lit(-1 - turn)) < F.element_at(_by_shard(share, shards), F.col("to") + 1)
        rows = stored(asked.select("r", "g", F.when(taken, F.col("to")).otherwise(F.col("shard")).alias("shard")), spark, "shards")
        if sum(n * share[s] for s, n in wishes.items()) <= SETTLED * linked:
            break
    return rows.select("r", "shard")


def balanced(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """``(r, shard, slot)`` of ``rows (r, shard, linked)``: counts at most one apart, slots gapless."""
    parts = 8 * (1 + total // (shards * PART * 8))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("r", F.lit("part")), F.lit(parts)) + F.when(F.col("linked"), 0).otherwise(parts))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("r")) - 1
    numbered = rows.withColumn("k", number).join(before, ["shard", "part"]).withColumn("k", F.col("k") + F.col("before"))

    have = {r.shard: r.n for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    most = sorted(range(shards), key=lambda s: (-have.get(s, 0), s))
    quota = {s: total // shards + (i < total % shards) for i, s in enumerate(most)}
    over, at = {}, 0  # number of the first surplus row of each shard among all of them
    for s in range(shards):
        over[s], at = at, at + max(0, have.get(s, 0) - quota[s])
    gaps, at = [], 0  # (first surplus number, shard, first free slot)
    for s in range(shards):
        if have.get(s, 0) < quota[s]:
            gaps.append((at, s, have.get(s, 0)))
            at += quota[s] - have.get(s, 0)
    of = lambda values: F.element_at(F.array(*[F.lit(int(values.get(s, 0))) for s in range(shards)]), F.col("shard") + 1).cast("long")
    spare = F.col("k") - of(quota)
    new, slot = F.col("shard"), F.col("k")
    surplus = spare + of(over)
    for first, s, free in gaps:  # the last gap that begins at or before the number wins
        inside = (spare >= 0) & (surplus >= first)
        new, slot = F.when(inside, F.lit(s)).otherwise(new), F.when(inside, surplus - first + free).otherwise(slot)
    return numbered.select("r", new.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def assign(docs: DataFrame, spark: SparkSession, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of every row."""
    plain = id_text(docs, id_col, text_col)
    rows = stored(plain.select(
        F.monotonically_increasing_id().alias("r"), "doc_id", (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.unhex(F.md5("text")).alias("g"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard")), spark, "rows")
    total = rows.count()
    groups = rows.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g")
    moved = propagate(rows.join(groups, "g"), total, shards, spark).select("r", F.col("shard").alias("moved"))
    placed = rows.select("r", "shard").join(moved, "r", "left").select(
        "r", F.coalesce("moved", "shard").alias("shard"), F.col("moved").isNotNull().alias("linked"))
    final = balanced(stored(placed, spark, "placed"), total, shards)
    return rows.select("r", "doc_id", "size", "text_crc32").join(final, "r").drop("r")
