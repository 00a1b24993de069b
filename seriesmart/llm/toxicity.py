"""Toxicity: noisy-channel restoration of disguised words, then a learned score.

1. *Character language model*: counts of letter triples over all documents (a
   fixed table of 27^3 cells, letters without their accents).
2. *Restoration*: stretches that look disguised (digits or signs for letters,
   letters three times or more, three single letters with gaps, single letters
   beside a piece of a word, pieces with a sign between), of any length but for
   repeats, become a lattice: each character may be itself, a letter it often
   stands for, or nothing.  Viterbi
   decoding takes the likeliest path under channel and language model.  Restored
   words are added to the words of the text.
3. *Score*: words and their beginnings whose documents are toxic far more often
   than chance are the vocabulary; a logistic curve over a document's strongest,
   summed and counted evidence gives the score.

Labels are learned only from rows whose crc32(doc_id as text) mod 3 isn't 1, up
to ``TRAIN`` labelled documents (those whose ids hash lowest); of the
``CANDIDATES`` words and beginnings that most toxic ones of these have, up to
``VOCABULARY`` make the vocabulary.  So the model, which goes to every task, is of
bounded size.  The language model covers all documents.  Labels, language,
source and id never enter a score.

Defined results: null and empty texts have no evidence and get the score of
such texts; an id with contradicting labels isn't learned from, nor is a null
id; without any label to learn from every score is 0; repeated rows give
repeated results; an empty table gives an empty result; texts are read whole;
further columns are left out (``clean`` keeps them, whatever their names).

The logistic curve sees the evidence up to fixed bounds (strongest 6, sum 24,
words 8), beyond which a text is as toxic as can be told.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import id_text, map_column, named, slices, text_batches, unused
from .graph import stored

TRAIN, CANDIDATES, VOCABULARY = 20_000, 100_000, 4_096
#: Least toxic documents and G-squared of a vocabulary entry, lengths of word beginnings, least score of a toxic document.
LEAST_TOXIC, LEAST_G2, HEADS, THRESHOLD = 5, 24.0, (3, 4, 5, 6, 7), 0.7
#: Entries that a worker keeps.
MEMO = 50_000

#: Letters that digits and signs stand for in disguised words.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
_WORD = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(r"[\d@$!|+*(]")
_TOKEN = re.compile(r"[\w@$!|+*(]+")
_LONG = re.compile(r"([^\W\d_])\1\1")
_RUN = re.compile(r"(.)\1{3,}", re.S)
_GAP = re.compile(r"(?:[^\w@$!|+(]|_)+")
_GAPS = re.compile(r"(?<![\w@$!|+(])(?:[^\W_]|[@$!|+(])(?:(?:[^\w@$!|+(]|_)+(?:[^\W_]|[@$!|+(])){2,}(?![\w@$!|+(])")
#: A sign between letters, and single letters with gaps before or after a piece of a word.
_JOINT = re.compile(r"[-.\u00b7~_/](?=[^\W\d_])")
_JOINED = re.compile(r"[^\W\d_]+(?:[-.\u00b7~_/][^\W\d_]+)*")
_SINGLES = re.compile(r"(?<![^\W_])[^\W\d_](?:[ \t]+[^\W\d_])+(?![^\W_])")
_BEFORE, _AFTER = re.compile(r"(?<![^\W_])[^\W\d_]{2,}[ \t]+\Z"), re.compile(r"[ \t]+[^\W\d_]{2,}(?![^\W_])")
#: Least log of the likelihood, by character, of a word behind a stretch without any letter.
LEAST_LIKELY = -4.3


# --- language model -------------------------------------------------------------------------

@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Code of each character below U+0250: 1 to 26 for a letter whatever its case and accents, else 0."""
    out = np.zeros(0x251, np.int32)
    for c in range(0x250):
        base = unicodedata.normalize("NFD", chr(c).lower())[:1]
        out[c] = ord(base) - 96 if "a" <= base <= "z" else 0
    return out


def _code(text: str) -> np.ndarray:
    return _codes()[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0x250)]


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(letter | two before) as a 27 x 27 x 27 table, 0 standing for the end of a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27 ** 3, np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                c = _code(" " + (text or "") + " ")
                total += np.bincount(c[:-2] * 729 + c[1:-1] * 27 + c[2:], minlength=27 ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    counts = np.full(27 ** 3, 0.1)
    for cell, n in text_batches(docs.select("text")).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        counts[cell] += n
    counts = counts.reshape(27, 27, 27)
    two = counts.sum(axis=0)  # back off to one letter before where two are rare
    two = (two + 0.1) / (two + 0.1).sum(axis=1, keepdims=True)
    seen = counts.sum(axis=2, keepdims=True)
    return np.log((counts + 5 * two[None]) / (seen + 5))


# --- restoration ----------------------------------------------------------------------------

def _options(c: str, before: str, gaps: bool, end: bool, strict: bool, tail: bool) -> list[tuple[int, float]]:
    """(code of the letter or -1 for nothing or 0 for a border, log of the channel's probability)"""
    if gaps and c == " ":
        return [(-1, math.log(0.7)), (0, math.log(0.3))]
    again = math.log(0.6 if before[-2:] == c + c else 0.02)
    code = int(_code(c)[0])
    if code:
        out = [(code, math.log(0.97))]
        if before[-1:] == c:  # a letter twice is common in words, three times isn't
            out.append((-1, again))
        return out
    out = [(ord(x) - 96, math.log(0.6 / len(LEET[c]))) for x in LEET.get(c, "")]
    # A sign for nothing hardly stands within a word; around one it may be punctuation.
    nothing = 1e-6 if not end or strict else 1e-4 if c.isdigit() else 1e-2 if c in "$@" else 0.3
    return out + [(-1, max(math.log(nothing), again) if before[-1:] == c and not tail else math.log(nothing))]


def _decoded(span: str, model: np.ndarray, gaps: bool, strict: bool) -> tuple[str, float]:
    """The likeliest word (words, with gaps) behind a disguised stretch, and the log of its path's likelihood."""
    paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    before, span = "", span.lower()
    first, last = len(span) - len(span.lstrip("!|+*(@$_")), len(span.rstrip("!|+*(@$_"))
    for k, c in enumerate(span):
        end = k < max(first, 1) or k >= min(last, len(span) - 1)
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        options = _options(c, before, gaps, end, strict, strict and k >= last)  # strictly, all signs at the end are letters
        for (a, b), (p, letters) in paths.items():
            for code, q in options:
                if code < 0:
                    key, r, got = (a, b), p + q, letters
                else:
                    key, r, got = (b, code), p + q + model[a, b, code], (letters, code)
                if key not in after or after[key][0] < r:
                    after[key] = (r, got)
        paths, before = after, (before + c)[-2:]
    likely, letters = max((p + model[a, b, 0], got) for (a, b), (p, got) in paths.items())
    out = []
    while letters:
        letters, code = letters
        out.append(chr(96 + code) if code else " ")
    return "".join(reversed(out)), likely


#: Several signs at the end, a dollar or at sign among them.
_TAIL = re.compile(r"[@$][!|+*(@$]+\Z|[!|+*(@$]+[@$]\Z")


def decode(span: str, model: np.ndarray, gaps: bool = False) -> str:
    """The words behind a disguised stretch: the likeliest reading and, where it begins with
    signs or ends with several, also that in which they are letters.  Without any letter, a stretch is only
    read if that is likely; numbers and prices are not."""
    least = -math.inf if any(map(str.isalpha, span)) else LEAST_LIKELY * sum(not c.isspace() for c in span)
    out = []
    for strict in (False, True)[:1 + (span[0] in "!|+*(@$" or bool(_TAIL.search(span)))]:
        got, likely = _decoded(span, model, gaps, strict)
        if likely >= least:
            out.append(got)
    return " ".join(dict.fromkeys(out))


def _looks(text: str) -> tuple[bool, bool]:
    """Whether a text may have a letter three times in a row, and two single letters with gaps."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    same = c[1:] == c[:-1]
    other = (c > 0x24F) & ((c < 0x2000) | (c > 0x206F))  # may be letters; these are signs and spaces
    letter = np.r_[False, (_codes()[np.minimum(c, 0x250)] > 0) | (c >= 48) & (c < 58) | other | np.isin(c, _SIGNS), False]
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    one = edge[1::2] - edge[::2] == 1
    return bool((same[1:] & same[:-1] & letter[3:-1]).any()), bool((one[1:] & one[:-1]).any())


_SIGNS = np.array([ord(c) for c in "@$!|+("], np.uint32)


def _stretches(text: str) -> Iterator[tuple[str, bool]]:
    """(disguised stretch, whether with gaps) of a text in lower case."""
    long, gaps = _looks(text)
    if long or _SIGN.search(text):
        for m in _TOKEN.finditer(text):
            s = m[0].strip("_")
            if s.isalpha() and not (long and _LONG.search(s)):
                continue
            core = s.rstrip("!|+*(@$")
            # two signs or more at the end are noise, but with a dollar or at sign may be letters too
            for s in (s,) if len(s) <= len(core) + 1 else (s, core) if set(s[len(core):]) & set("@$") else (core,):
                if len(s) >= 3 and (_SIGN.search(s) or _LONG.search(s)):
                    yield _RUN.sub(r"\1\1\1", s), False
    if gaps:
        for m in _GAPS.finditer(text):
            yield _GAP.sub(" ", m[0]), True
        for m in _SINGLES.finditer(text):
            before, after = _BEFORE.search(text[max(0, m.start() - 64):m.start()]), _AFTER.match(text, m.end())
            for one in (before and before[0] + m[0], after and m[0] + after[0]):
                if one:
                    yield " ".join(one.split()), True
    done = 0
    for m in _JOINT.finditer(text):
        start = m.start()
        if start >= done and text[start - 1:start].isalpha():
            while start > done and text[start - 1].isalpha():
                start -= 1
            whole = _JOINED.match(text, start)
            done = whole.end()
            yield re.sub(r"[^\w]|_", " ", whole[0]), True


class Restorer:
    def __init__(self, model: np.ndarray):
        self.model = model
        self.decoded: dict[tuple[str, bool], list[str]] = {}
        self.found: dict[str, tuple] = {}
        self.begin: frozenset | None = None

    def heads(self, vocabulary: dict[str, float]) -> frozenset:
        """The first three letters of all entries (a restorer serves one vocabulary)."""
        if self.begin is None:
            self.begin = frozenset(f[:3].rstrip("-") for f in vocabulary)
        return self.begin

    def restored(self, lower: str) -> Iterator[str]:
        """The words behind the disguised stretches of a text in lower case."""
        for key in _stretches(lower):
            got = self.decoded.get(key)
            if got is None:
                got = decode(key[0], self.model, key[1]).split()
                if len(self.decoded) > MEMO:
                    self.decoded.clear()
                if len(key[0]) <= 80:
                    self.decoded[key] = got
            yield from got

    def words(self, text: str) -> set[str]:
        """The words of a text, in lower case, and the words restored from it."""
        lower = text.lower()
        return {*_WORD.findall(lower), *self.restored(lower)}

    def evidence(self, text: str, vocabulary: dict[str, float]) -> tuple[float, float, float]:
        """The strongest evidence, the sum and the number of the words that have any."""
        lower, hits = text.lower(), {}
        heads = self.heads(vocabulary)
        for token in {*lower.split(), *self.restored(lower)}:
            if token.isalpha() and token[:3] not in heads:
                continue
            got = self.found.get(token)
            if got is None:
                if len(self.found) > MEMO:
                    self.found.clear()
                got = self.found[token] = tuple((w, e) for w in _WORD.findall(token) if w[:3] in heads and (e := max(
                    (vocabulary.get(f, 0.0) for f in _features(w)), default=0.0)))
            if got:
                hits.update(got)
        e = hits.values()
        return min(max(e, default=0.0), 6.0), min(sum(e), 24.0), min(float(len(e)), 8.0)


# --- score ----------------------------------------------------------------------------------

class Model(NamedTuple):
    letters: np.ndarray
    #: Word or beginning (with a final "-") -> log odds of toxic.
    vocabulary: dict[str, float]
    weights: np.ndarray


def _features(word: str) -> list[str]:
    return [word, *(word[:k] + "-" for k in HEADS if len(word) >= k)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_ids(labels: DataFrame, most: int = TRAIN) -> DataFrame:
    """``(doc_id, toxic)`` of up to ``most`` labelled ids that aren't held out."""
    one = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).filter("toxic = other"))
    return one.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "toxic")


def _g2(toxic: int, other: int, all_toxic: float, all_other: float) -> float:
    """G-squared of a feature's toxic and other documents against the shares of all."""
    total, share = toxic + other, all_toxic / (all_toxic + all_other)
    part = lambda x, p: x * math.log(x / (total * p)) if x else 0.0
    return 2 * (part(toxic, share) + part(other, 1 - share))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the documents ``(doc_id, text)``."""
    letters = language_model(docs)
    some = stored(docs.join(F.broadcast(training_ids(labels)), "doc_id").select("toxic", "text"), docs.sparkSession, "training")
    size = {r.toxic: r.n for r in some.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n, t = float(size.get(0, 0)), float(size.get(1, 0))
    if not n or not t:
        return Model(letters, {}, np.zeros(4))

    def counted(rows: DataFrame, wanted: frozenset | None) -> DataFrame:
        """``(f, n)``: in how many texts each feature (each wanted one) occurs."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer, seen = Restorer(letters), Counter()
            for batch in slices(batches):
                for text in batch.column(0).to_pylist():
                    found = {f for w in restorer.words(text) for f in _features(w)}
                    seen.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["f", "n"])

        return rows.select("text").mapInArrow(run, "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))

    often = counted(some.filter("toxic = 1"), None).filter(F.col("n") >= LEAST_TOXIC).orderBy(F.desc("n"), "f").limit(CANDIDATES).collect()
    wanted = frozenset(r.f for r in often)
    other = {r.f: r.n for r in counted(some.filter("toxic = 0"), wanted).collect()}
    rated = sorted((-_g2(r.n, other.get(r.f, 0), t, n), r.f, math.log((r.n + t / (n + t)) / (other.get(r.f, 0) + n / (n + t)))) for r in often)
    vocabulary = {f: odds for g2, f, odds in rated if odds > 0 and -g2 >= LEAST_G2}
    vocabulary = dict(list(vocabulary.items())[:VOCABULARY])

    def rate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters)
        for batch in slices(batches):
            got = [restorer.evidence(x, vocabulary) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([g[i] for g in got], pa.float64()) for i in range(3))], ["toxic", "a", "b", "c"])

    rated = some.mapInArrow(rate_rows, "toxic int, a double, b double, c double").groupBy("a", "b", "c", "toxic").count().collect()
    return Model(letters, vocabulary, _logistic(np.array([r[:3] for r in rated]), np.array([r[3] for r in rated], float), np.array([r[4] for r in rated], float)))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression with intercept, by Newton's steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    ridge = np.diag([1e-3, 0.1, 0.1, 0.1])
    w = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (n * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep: bool = False) -> DataFrame:
    """Replace the text by its score; with ``keep``, add it."""
    def run(texts: list) -> dict:
        restorer = _restorer(model)
        got = np.array([(1.0, *restorer.evidence(t or "", model.vocabulary)) for t in texts]).reshape(-1, 4)
        out = 1 / (1 + np.exp(-np.clip(got @ model.weights, -30, 30))) if model.vocabulary or model.weights.any() else np.zeros(len(got))
        return {score_col: out}

    return map_column(docs, text_col, f"`{score_col}` double", run, keep)


_KEPT: list[tuple[Model, Restorer]] = []


def _restorer(model: Model) -> Restorer:
    """What a worker keeps between the slices of a task."""
    if not _KEPT or _KEPT[0][0] is not model:
        _KEPT[:] = [(model, Restorer(model.letters))]
    return _KEPT[0][1]


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    plain = id_text(docs, id_col, text_col)
    return (score(plain, train(plain, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the documents that aren't rejected, with all their columns."""
    model = train(id_text(docs, id_col, text_col), labels)
    rated = unused("score", docs.columns)
    kept = score(docs, model, text_col, rated, keep=True).filter(F.col(rated) < THRESHOLD)
    return kept.select(*map(named, docs.columns))
