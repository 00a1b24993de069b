"""Benchmark leaks: rare word n-grams join passages to items, Smith-Waterman alignment scores them.

1. Words are counted over all documents, by hash in ``CELLS`` cells (words that
   share a cell only look more frequent).
2. *Seeds* are an item's word triples, neighbouring or with one word between
   passed over, that chance would put at fewer than ``RARE`` of all places (the
   product of the words' shares; this doesn't depend on the size of the corpus,
   nor on how often an item has leaked), and besides at least the ``FALLBACK``
   rarest of each pattern and half of the neighbouring ones.  An item of one or
   two words has itself as the seed, if that is so rare.
3. A pass over the documents hashes their triples in the same patterns (so
   words put in, left out or replaced leave some of them whole) and keeps those
   texts that hold one whose hash is in a bitmap of all seeds, ``BITS`` bits.
   Their grams are joined to the seeds by hash.
4. Of every text and item that a gram joins, the item's words are aligned
   locally with the words around the grams; windows whose words could not reach
   the threshold even in the best order are passed over.  The score is the
   alignment's score as a share of that of an exact copy.

Documents are read twice and not shuffled: what goes to the tasks is the cells of
the items' words and the bitmap, both of fixed size, so a benchmark of any size
takes the same two passes.  Texts that hold a seed are shuffled, once a text
however often it is repeated.  An alignment keeps every ``ROWS``-th row of its
table and works out the others again where it traces back.

Defined results: null and empty documents have no leaks, and null and empty
items are never found; items of one or two words only where chance would put
them at fewer than ``RARE`` places; repeated rows give repeated results, items
with the same id are found each; of equally good places the first counts;
documents are read whole; an empty table on either side gives no leaks; further
columns pass through, one of the result's name is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, map_column, named, slices, text_batches, unused
from .graph import stored

THRESHOLD, RARE, FALLBACK = 0.5, 1e-9, 12
MATCH, MISMATCH, GAP = 2, -1, -1
CELLS, BITS, ROWS = 1 << 20, 1 << 24, 64
#: Places of the three words of a triple.
PATTERNS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
LEAK = "struct<item_id:bigint,score:double,matched:int,start:int,end:int>"
_WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each character belongs to words (what the pattern says)."""
    return np.fromiter((chr(c).isalnum() or c == 95 for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.full(4096, np.uint64(0x9FB21C651E98DF25)))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of a text in lower case: a polynomial of its characters, mixed."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(c) + 2, bool)
    inside[1:-1] = _letters()[c]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    c = c[inside[1:-1]].astype(np.uint64)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(c)) - np.repeat(first, sizes)
    return _mix(np.add.reduceat(c * _powers()[place & 4095], first) + sizes.astype(np.uint64) * _ODD)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def grams(h: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """A hash of the words at the pattern's places from each place on."""
    n = max(0, len(h) - pattern[-1])
    out = np.full(n, len(pattern), np.uint64)
    for at in pattern:
        out = _mix(out * _ODD + h[at:at + n])
    return out


def _patterns(n: int) -> tuple[tuple[int, ...], ...]:
    """The patterns of an item of n words: one or two words are a gram of their own."""
    return PATTERNS if n > 2 else ((0, 1),) if n == 2 else ((0,),) if n else ()


# --- words and seeds ------------------------------------------------------------------------

def _cell_counts(texts: DataFrame) -> DataFrame:
    """``(cell, n)``: how often words of each cell occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(CELLS, np.int64), [], 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                held.append(word_hashes(text) & np.uint64(CELLS - 1))
                n += len(held[-1])
                if n > 1_000_000:
                    total += np.bincount(np.concatenate(held).view(np.int64), minlength=CELLS)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held).view(np.int64), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    return text_batches(texts).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _chances(docs: DataFrame, items: DataFrame, spark) -> tuple[dict[int, float], float]:
    """Log of the share of each cell of the items' words, and of a cell that no document has."""
    counts = stored(_cell_counts(docs), spark, "cells")
    total = counts.agg(F.sum("n")).first()[0] or 1
    wanted = _cell_counts(items.select("text")).select("cell")
    got = counts.join(wanted, "cell", "left_semi").collect()  # CELLS rows at most
    return {r.cell: float(np.log((r.n + 0.5) / total)) for r in got}, float(np.log(0.5 / total))


def _seeds(items: DataFrame, shares: dict[int, float], none: float) -> DataFrame:
    """``(h, item)``: the seeds of the items ``(item, item_id, text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = word_hashes(text)
                share = np.array([shares.get(int(c), none) for c in h & np.uint64(CELLS - 1)])
                chosen = [seeds_of(h, share, p) for p in _patterns(len(h))]
                got = np.unique(np.concatenate(chosen)) if chosen else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64)), pa.array(np.full(len(got), item, np.int64))], ["h", "item"])

    return items.select("item", "text").mapInArrow(run, "h long, item long")


def seeds_of(h: np.ndarray, share: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """The grams of one pattern that are rare by chance, and the rarest."""
    own = grams(h, pattern)
    chance = sum((share[at:at + len(own)] for at in pattern), np.zeros(len(own)))
    least = 0 if len(pattern) < 3 else max(FALLBACK, len(own) // 2) if pattern == PATTERNS[0] else FALLBACK
    chosen = chance <= np.log(RARE)
    chosen[np.argsort(chance, kind="stable")[:least]] = True
    return own[chosen]


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The bits of all seeds, 64 to a number."""
    bit = F.pmod("h", F.lit(BITS))
    rows = seeds.groupBy((bit / 64).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(h, {BITS}) % 64 as int))")).alias("bits")).collect()
    out = np.zeros(BITS // 64, np.int64)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out.view(np.uint64)


# --- passages -------------------------------------------------------------------------------

def _passages(docs: DataFrame, bits: np.ndarray, short: tuple[int, ...]) -> DataFrame:
    """``(k, text, places, hs)`` of the texts that hold grams of the bitmap: their places and hashes.
    ``short`` has the lengths of the items of fewer than three words."""
    patterns = (*PATTERNS, *[tuple(range(n)) for n in short])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = {}
            for text in set(batch.column(0).to_pylist()):
                h = word_hashes(text)
                places, own = [], []
                for p in patterns:
                    g = grams(h, p)
                    # the hash is a signed long to Spark, whose remainder by a power of two is that of its low bits
                    low = g & np.uint64(BITS - 1)
                    at = np.flatnonzero(bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1))
                    places.append(at)
                    own.append(g[at])
                if sum(map(len, places)):
                    found[text] = (np.concatenate(places).astype(np.int32), np.concatenate(own).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array([hashlib.md5(t.encode("utf-8", "surrogatepass")).hexdigest() for t in found], pa.string()), pa.array(list(found), pa.string()),
                pa.array([p for p, _ in found.values()], pa.list_(pa.int32())), pa.array([g for _, g in found.values()], pa.list_(pa.int64()))],
                ["k", "text", "places", "hs"])

    return text_batches(docs).mapInArrow(run, "k string, text string, places array<int>, hs array<long>").dropDuplicates(["k"])


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman: score, matched words, first and last place (exclusive) in the text."""
    steps = np.arange(len(text) + 1, dtype=np.int32) * GAP

    def after(above: np.ndarray, word) -> np.ndarray:
        best = np.zeros(len(text) + 1, np.int32)
        best[1:] = np.maximum(np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] + GAP), 0)
        return np.maximum.accumulate(best - steps) + steps  # gaps along the text

    row, kept, score, i, j = np.zeros(len(text) + 1, np.int32), [], 0, 0, 0
    for at, word in enumerate(item):
        if at % ROWS == 0:
            kept.append(row)
        row = after(row, word)
        top = int(row.max())
        if top > score:
            score, i, j = top, at + 1, int(row.argmax())
    end, matched, rows, base = j, 0, [], None
    while i and j:
        if base is None or i <= base:  # the rows of this part of the item again
            base = (i - 1) // ROWS * ROWS
            rows = [kept[base // ROWS]]
            for word in item[base:i]:
                rows.append(after(rows[-1], word))
        now, above = rows[i - base], rows[i - base - 1]
        if not now[j]:
            break
        same = text[j - 1] == item[i - 1]
        if now[j] == above[j - 1] + (MATCH if same else MISMATCH):
            i, j, matched = i - 1, j - 1, matched + int(same)
        elif now[j] == above[j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, matched, int(j), end


def windows(places: list[int], size: int, n: int) -> list[tuple[int, int]]:
    """Stretches of n words around the places of an item's grams, wherever in the item they are, joined where they meet."""
    out: list[tuple[int, int]] = []
    reach = 8 + size + size // 4
    for place in sorted(places):
        start, end = max(0, place - reach), min(n, place + reach)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def best_place(text: np.ndarray, item: np.ndarray, places: list[int], threshold: float = THRESHOLD) -> tuple[int, int, int, int] | None:
    """The best alignment of an item around some places of a text, if it reaches the threshold."""
    need, best = threshold * MATCH * len(item), None
    for start, end in windows(places, len(item), len(text)):
        window = text[start:end]
        if MATCH * np.isin(item, window).sum() < need:
            continue
        score, matched, a, b = align(item, window)
        if score >= need and (best is None or score > best[0]):
            best = (score, matched, start + a, start + b)
    return best


def _aligned(pairs: DataFrame, threshold: float) -> DataFrame:
    """``(k, leaks)`` of texts with their joined items ``(k, text, near)``."""
    def run(texts: list) -> dict:
        out = []
        for row in texts:
            text, found, spans = row["text"], [], None
            words = word_hashes(text)
            for item in sorted(row["near"], key=lambda x: (x["item_id"] is None, x["item_id"] or 0, x["item"])):
                own = word_hashes(item["text"])
                best = best_place(words, own, item["places"], threshold)
                if best:
                    # lower() may lengthen some letters: places are those of the text as it is
                    spans = spans or [m.span() for m in _WORD.finditer(text)]
                    a, b = min(best[2], len(spans) - 1), min(best[3], len(spans))
                    found.append({"item_id": item["item_id"], "score": best[0] / (MATCH * len(own)), "matched": best[1],
                                  "start": spans[a][0], "end": spans[max(a, b - 1)][1]})
            out.append(found)
        return {"leaks": out}

    rows = pairs.select("k", F.struct("text", "near").alias("x"))
    return map_column(rows, "x", f"leaks array<{LEAK}>", run).filter(F.size("leaks") > 0)


def _found(docs: DataFrame, items: DataFrame, text_col: str, item_id_col: str, item_text_col: str, threshold: float) -> DataFrame:
    """``(k, leaks)``: what each text that leaks holds, by the MD5 of the text."""
    spark = docs.sparkSession
    texts = docs.select(named(text_col).alias("text")).filter("text <> ''")
    plain = items.select(F.monotonically_increasing_id().alias("item"), named(item_id_col).cast("long").alias("item_id"), named(item_text_col).alias("text"))
    plain = stored(plain.filter("text <> ''"), spark, "items")
    seeds = stored(_seeds(plain, *_chances(texts, plain, spark)), spark, "seeds")
    short = map_column(plain.select("text"), "text", "n int", lambda t: {"n": [len(word_hashes(x)) for x in t]})
    short = tuple(sorted(r.n for r in short.filter("n IN (1, 2)").distinct().collect()))
    passages = stored(_passages(texts, _bitmap(seeds), short), spark, "passages")
    hits = passages.select("k", F.explode(F.arrays_zip("hs", "places")).alias("x")).select("k", F.col("x.hs").alias("h"), F.col("x.places").alias("place"))
    near = hits.join(seeds, "h").groupBy("k", "item").agg(F.collect_set("place").alias("places"))
    near = near.join(plain, "item").groupBy("k").agg(F.collect_list(F.struct("item", "item_id", "text", "places")).alias("near"))
    return stored(_aligned(passages.select("k", "text").join(near, "k"), threshold), spark, "leaks")


def leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
          out_col: str = "leaks", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``out_col``: array of the items that a document holds (code points, end exclusive)."""
    rest = [c for c in docs.columns if c.lower() != out_col.lower()]
    key = unused("k", [*rest, out_col])
    found = bounded(_found(docs, items, text_col, item_id_col, item_text_col, threshold).select(F.col("k").alias(key), F.col("leaks").alias(out_col)))
    joined = docs.select(*map(named, rest)).join(found, F.md5(named(text_col)) == F.col(key), "left").drop(key)
    return joined.withColumn(out_col, F.coalesce(named(out_col), F.array().cast(f"array<{LEAK}>")))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of the documents that hold no item, with all their columns."""
    key = unused("k", docs.columns)
    found = _found(docs, items, text_col, "item_id", "text", THRESHOLD)
    return docs.join(bounded(found.select(F.col("k").alias(key))), F.md5(named(text_col)) == F.col(key), "left_anti")
