"""Benchmark leaks against an alignment of every document with every item."""

import random
import re

import numpy as np
import pytest

SYLLABLES = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.choice((1, 2, 3)))) for _ in range(n)]


def edited(rng, w, kind):
    """A copy with a word put in, replaced or left out at every so many words."""
    what, every = kind
    out = []
    for i, x in enumerate(w):
        hit = i % every == every - 1
        out += [] if hit and what == "out" else [rng.choice(("zum", "zam"))] if hit and what == "other" else [x, "zim"] if hit and what == "in" else [x]
    return out


KINDS = [("in", 2), ("in", 3), ("other", 3), ("other", 4), ("out", 3), ("out", 4), ("in", 5), ("other", 10), ("out", 100)]


def brute(docs, items, threshold=0.5):
    from seriesmart.llm import decontaminate as d
    number = {}
    numbers = lambda t: np.array([number.setdefault(x, len(number)) for x in re.findall(r"\w+", (t or "").lower())], int)
    own = [(i, numbers(t)) for i, t in items]
    out = {}
    for doc, text in docs:
        h = numbers(text)
        for i, w in own:
            if len(w) > 2 and len(h):
                score, matched, _, _ = d.align(w, h)
                if score >= threshold * d.MATCH * len(w):
                    out[doc, i] = score / (d.MATCH * len(w))
    return out


def test_edited_copies_as_brute_force(spark):
    from seriesmart.llm import decontaminate as d
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, rng.choice((9, 24, 24, 40, 70))))) for i in range(25)]
    docs = []
    for i in range(120):
        _, text = rng.choice(items)
        copy = edited(rng, text.split(), KINDS[i % len(KINDS)])
        docs.append((i, " ".join(words(rng, rng.randrange(90)) + copy + words(rng, rng.randrange(60)))))
    docs += [(200 + i, " ".join(words(rng, 100))) for i in range(40)]
    docs += [(300, " ".join(t for _, t in items)), (301, docs[0][1]), (None, docs[1][1]), (302, None), (303, "")]
    got = {}
    for r in d.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect():
        got.update({(r.doc_id, x.item_id): x.score for x in r.leaks})
    want = brute(docs, items)
    assert len(want) > 110 and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_short_items_only_where_they_are_rare(spark):
    from seriesmart.llm import decontaminate as d
    rng = random.Random(12)
    docs = [(i, " ".join(words(rng, 20_000))) for i in range(12)]
    docs[3] = (3, docs[3][1] + " qwertyu uytrewq")
    bench = spark.createDataFrame([(1, "Qwertyu, uytrewq"), (2, "ba"), (3, "ba da"), (4, "uytrewq")], "item_id long, text string")
    got = {(r.doc_id, x.item_id): x.score for r in d.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect() for x in r.leaks}
    assert got == {(3, 1): 1.0}


@pytest.mark.parametrize("n,m", [(200, 500), (65, 64), (64, 700), (1, 5), (129, 3)])
def test_alignment_traced_back_in_parts(n, m):
    """Matched words and places are those of a table kept whole."""
    from seriesmart.llm import decontaminate as d
    rng = np.random.default_rng(n)
    item, text = rng.integers(0, 6, n), rng.integers(0, 6, m)
    text[m // 3:m // 3 + n // 2] = item[n // 4:n // 4 + len(text[m // 3:m // 3 + n // 2])]
    score, matched, start, end = d.align(item, text)
    old, d.ROWS = d.ROWS, 10 ** 9
    try:
        assert d.align(item, text) == (score, matched, start, end)
    finally:
        d.ROWS = old
    table = np.zeros((n + 1, m + 1), int)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (d.MATCH if item[i - 1] == text[j - 1] else d.MISMATCH), table[i - 1, j] + d.GAP, table[i, j - 1] + d.GAP)
    assert score == table.max() and (0 <= start < end <= m or not score) and matched <= min(n, end - start)


def test_memory_of_a_long_alignment():
    """An item of thousands of words against a long text keeps a small part of its table."""
    import tracemalloc
    from seriesmart.llm import decontaminate as d
    rng = np.random.default_rng(1)
    item = rng.integers(0, 10 ** 6, 2000)
    text = np.concatenate([rng.integers(0, 10 ** 6, 10_000), item, rng.integers(0, 10 ** 6, 10_000)])
    tracemalloc.start()
    assert d.align(item, text) == (4000, 2000, 10_000, 12_000)
    assert tracemalloc.get_traced_memory()[1] < 30e6
    tracemalloc.stop()


def test_repeated_texts_and_odd_items(spark):
    from seriesmart.llm import decontaminate as d
    rng = random.Random(13)
    text = " ".join(words(rng, 30))
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (2, text + " x", "b"), (3, None, "c")], "doc_id long, text string, k string")
    bench = spark.createDataFrame([(1, text), (1, text), (None, text), (4, None), (5, "")], "item_id long, text string")
    got = [(r.doc_id, r.k, [(x.item_id, x.score) for x in r.leaks]) for r in d.leaks(docs, bench).collect()]
    found = [(1, 1.0), (1, 1.0), (None, 1.0)]
    assert sorted(got) == [(1, "a", found), (1, "a", found), (2, "b", found), (3, "c", [])]
    assert [(r.doc_id, r.k) for r in d.clean(docs, bench).collect()] == [(3, "c")]
    assert d.leaks(docs, bench.limit(0)).count() == 4 and d.clean(docs.limit(0), bench).count() == 0


def test_word_hashes():
    """As many as words, equal exactly for equal words."""
    from seriesmart.llm import decontaminate as d
    rng = random.Random(14)
    letters = "abAB19_ .,-'\n\u00e9\u00df\u0130\u03a3\u4e2d\U0001F600\u2014\u00b2\u0660\u00a0"
    seen = {}
    for i in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        words, hashes = re.findall(r"\w+", text.lower()), d.word_hashes(text).tolist()
        assert len(words) == len(hashes), text
        for w, h in zip(words, hashes):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) > 1000
    assert len(d.word_hashes(None)) == 0 and len(d.word_hashes("x" * 10_000 + " y")) == 2
