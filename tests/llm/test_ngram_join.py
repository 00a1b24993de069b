"""The n-gram Jaccard join against brute force, and the promise of its index."""

import random
from collections import Counter

import numpy as np
import pytest
from brute_force import brute_components

COLUMNS = "doc_id long, text string, key string, v string, n int"


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        i = rng.randrange(len(out))
        out[i:i + 1] = rng.choice(([], [rng.choice("xyz")], [out[i], rng.choice("xyz")]))
    return out


def groups(seed):
    """Near copies around the threshold, texts that share long passages, few words, repeated rows."""
    rng = random.Random(seed)
    words = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    texts = []
    for size in (40, 25, 3, 3, 2, 2):
        base = [rng.choice(words) for _ in range(rng.choice((12, 60, 300)))]
        texts += [edited(rng, base, rng.randrange(1 + len(base) // 25)) for _ in range(size)]
    passage = [rng.choice(words) for _ in range(80)]
    texts += [passage + [rng.choice(words) for _ in range(rng.choice((10, 15, 20, 40, 300)))] for _ in range(60)]
    texts += [[rng.choice("ab") for _ in range(rng.randrange(9))] for _ in range(40)]
    texts += [[rng.choice(words) for _ in range(200)] for _ in range(30)] + texts[:10]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return rows + [(900, long), (901, long + " tail"), (902, None), (903, ""), (904, " \t\n"), (905, "One two"), (906, "one  TWO"),
                   (None, rows[0][1]), (None, "only here"), (None, "Only here"), (7, rows[3][1]), (7, rows[3][1]), (7, long)]


@pytest.mark.parametrize("seed,words,percent,hot,block", [(1, 5, 80, 5000, 1_000_000), (2, 3, 60, 5, 500), (3, 1, 90, 20, 2000), (4, 5, 51, 5000, 3000)])
def test_classes_as_brute_force(spark, monkeypatch, seed, words, percent, hot, block):
    from seriesmart.llm import common, ngram_join
    monkeypatch.setattr(ngram_join, "HOT_SETS", hot)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1_000_000 if seed % 2 else 0)
    rows = groups(seed)
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], COLUMNS)
    got = ngram_join.classes(docs, spark, words=words, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == Counter(brute_components(rows, words, percent))


def test_nothing_to_join(spark):
    from seriesmart.llm import ngram_join
    assert ngram_join.classes(spark.createDataFrame([], COLUMNS), spark).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, None), (None, None)], "doc_id long, text string")
    assert Counter(map(tuple, ngram_join.classes(nulls, spark).collect())) == Counter([(1, 0, 1), (2, 0, 2), (None, 0, None)])
    with pytest.raises(ValueError):
        ngram_join.classes(nulls, spark, percent=50)


@pytest.mark.parametrize("rare", [0, 1, 3, 16])
def test_linked_sets_share_an_index_key(monkeypatch, rare):
    """Whatever the frequencies, also with nothing but pairs; and pairs stay in proportion to the set."""
    from seriesmart.llm import ngram_join as j
    monkeypatch.setattr(j, "RARE", rare)
    rng = np.random.default_rng(rare)
    for percent in (51, 60, 80, 95):
        pool, sets = rng.integers(0, 1 << 63, 3000, np.uint64), []
        for n in (2, 3, 4, 5, 7, 9, 16, 31, 33, 60, 130, 500):
            base = rng.choice(pool, n, replace=False)
            for _ in range(6):
                lost = rng.integers(0, max(1, n * (100 - percent) // 100) + 1)
                sets.append(np.unique(np.concatenate([base[rng.permutation(n)[lost:]], rng.choice(pool, rng.integers(0, lost + 2))])))
        f = Counter(x for s in {s.tobytes(): s for s in sets}.values() for x in s.tolist())
        keys = []
        for s in sets:
            shared = np.array([x for x in s.tolist() if f[x] > 1], np.uint64)
            keys.append(set(j.index_keys(shared, np.array([f[x] for x in shared.tolist()], np.int64), len(s), percent).tolist()))
            assert len(keys[-1]) <= 40 + 3 * len(s)
        for a in range(len(sets)):
            for b in range(a):
                if len(sets[a]) > 1 and sets[a].tobytes() != sets[b].tobytes() and j.linked(sets[a], sets[b], percent):
                    assert keys[a] & keys[b], (percent, len(sets[a]), len(sets[b]))
