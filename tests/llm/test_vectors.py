"""The vector operators against brute-force versions, and their edge cases."""

import random
from collections import Counter, defaultdict
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

COLUMNS = "vec_id long, embedding array<float>, label int, code string, place string, id string"


def integers(v):
    return None if v is None or any(x is None or not isfinite(x) for x in v) else [floor(256 * float(np.float32(x))) for x in v]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Ties, repeated rows, nulls, non-finite and huge components, other lengths, clashing names."""
    rng = random.Random(5)
    rows = [(i, [rng.choice((-.5, -.25, -.01, 0., .26, .5, rng.uniform(-1, 1))) for _ in range(32)], rng.randrange(3)) for i in range(300)]
    rows += [(i, rows[i - 300][1], rows[i - 300][2]) for i in range(300, 340)] + rows[:20] + rows[100:101] * 3
    rows += [(400, None, 1), (401, [None] + [0.5] * 31, 1), (402, [float("nan")] * 32, 1), (403, [float("inf")] + [0.] * 31, 2),
             (404, [1e30] * 32, 2), (405, [], 1), (406, [0.5] * 16, 1), (407, rows[7][1], None), (408, rows[8][1], None), (None, rows[9][1], 1)]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], COLUMNS)


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], COLUMNS)


def usable(rows):
    return [(r.vec_id, integers(r.embedding), r.label) for r in rows
            if (v := integers(r.embedding)) and len(v) == 32 and max(map(abs, v)) < 2 ** 27]


def brute_codes(rows, parts, entries, rounds):
    width = 32 // parts
    cut = [(i, [tuple(v[p * width:(p + 1) * width]) for p in range(parts)], label) for i, v, label in rows]
    first = sorted(cut, key=lambda r: (r[0] is None, r[0] or 0))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = defaultdict(list)
            for _, v, _ in cut:
                own[nearest(book, v[p])[1]].append(v[p])
            for e, xs in own.items():
                book[e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out = [(i, label, [nearest(books[p], v[p]) for p in range(parts)]) for i, v, label in cut]
    total = Counter()
    for _, label, got in out:
        total[label] += sum(d for d, _ in got)
    return Counter((i, label, bytes(e for _, e in got), sum(d for d, _ in got), total[label]) for i, label, got in out), books


def test_codes_as_brute_force(spark, odd_vectors):
    from seriesmart.llm import vector_codes as vc
    rows = usable(odd_vectors.collect())
    # equal ids among the first would make the start ambiguous; these ids have equal vectors
    for parts, entries in ((8, 40), (16, 64), (32, 5)):
        got, books = vc.compress(odd_vectors, spark, parts=parts, entries=entries)
        want, wanted = brute_codes(rows, parts, entries, 2)
        assert [[tuple(e) for e in b] for b in books.tolist()] == wanted
        assert Counter((r.id, r.label, bytes(r.codes), r.error, r.label_error) for r in got.collect()) == want
        assert set(got.columns) == {"id", "label", "codes", "error", "label_error"}
    r = got.first()
    x = np.array(next(v for i, v, _ in rows if i == r.id))
    assert ((x - vc.decoded(bytes(r.codes), books)) ** 2).sum() == r.error


def test_nearest_by_masks():
    from seriesmart.llm.vector_codes import Codebook
    rng = np.random.default_rng(3)
    for spread, count, width in ((4, 64, 4), (1000, 64, 4), (2 ** 27, 17, 2), (3, 1, 8), (0, 64, 3)):
        book = rng.integers(-spread, spread + 1, (count, width))
        x = rng.integers(-2 * spread, 2 * spread + 1, (500, width))
        d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        index, distance = Codebook(book).nearest(x)
        assert (index == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()


def test_few_masked_candidates():
    """The masks leave few of the 64 entries to be compared."""
    from seriesmart.llm.vector_codes import Codebook
    rng = np.random.default_rng(4)
    book = Codebook(rng.integers(-128, 128, (64, 4)))
    x = rng.integers(-128, 128, (2000, 4))
    near = book.near_guess(x)
    left = book.candidates(x, np.sqrt(near).astype(np.int64) + 1)
    assert np.mean([int(m).bit_count() for m in left]) < 16  # a quarter of the entries


def test_labels_by_a_shuffle(spark, odd_vectors, monkeypatch):
    from seriesmart.llm import vector_codes as vc
    want = Counter(map(tuple, vc.compress(odd_vectors, spark)[0].collect()))
    monkeypatch.setattr(vc, "BROADCAST_LABELS", 0)
    assert Counter(map(tuple, vc.compress(odd_vectors, spark)[0].collect())) == want


def test_codes_of_nothing(spark, no_vectors):
    from seriesmart.llm import vector_codes as vc
    got, books = vc.compress(no_vectors, spark)
    assert got.collect() == [] and got.columns == ["id", "label", "codes", "error", "label_error"]
    nulls = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    assert vc.compress(nulls, spark)[0].collect() == []
    one = spark.createDataFrame([(1, [0.1] * 16, None)], "vec_id long, embedding array<float>, label int")
    assert [(bytes(r.codes), r.error, r.label_error) for r in vc.compress(one, spark)[0].collect()] == [(bytes(16), 0, 0)]


def brute_negatives(rows, every, k=5, percent=80):
    rows = [r for r in rows if r[0] is not None and r[2] is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = Counter()
    for i, v, label in rows:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, m) for j, w, m in rows if j != i)
        for s, j, m in [x for x in scored if x[2] == label][:k]:
            near = [x for x in scored if x[2] != label and percent * -s <= 100 * -x[0] <= 100 * -s][:k]
            out.update((i, j, rank, n, -s, -t) for rank, (t, n, _) in enumerate(near, 1))
    return out


@pytest.mark.parametrize("rows,anchors,every", [(8192, 4096, 10), (64, 8, 3)])
def test_negatives_as_brute_force(spark, odd_vectors, monkeypatch, rows, anchors, every):
    from seriesmart.llm import hard_negatives as h
    monkeypatch.setattr(h, "ROWS", rows)
    monkeypatch.setattr(h, "ANCHORS", anchors)
    got = h.mine(odd_vectors, spark, F.col("id") % every == 0)
    want = brute_negatives(usable(odd_vectors.collect()), every)
    assert len(want) > 100 and Counter(map(tuple, got.collect())) == want


def test_negatives_of_large_components(spark):
    """Sums over 2^53 are exact too."""
    from seriesmart.llm import hard_negatives as h
    rng = random.Random(6)
    rows = [(i, [float(np.float32(rng.uniform(-2e5, 2e5))) for _ in range(32)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute_negatives([(i, integers(v), m) for i, v, m in rows], 4, percent=10)
    assert want and Counter(map(tuple, h.mine(df, spark, F.col("id") % 4 == 0, percent=10).collect())) == want


def test_candidates_shrink_before_all_dimensions_are_read():
    """The bounds leave few rows to the last dimensions, and never a wrong result."""
    import pyarrow as pa
    from seriesmart.llm import hard_negatives as h
    rng = np.random.default_rng(7)
    x = np.floor(rng.normal(0, 60, (4000, 64)) * np.geomspace(4, .05, 64)).astype("<i8")
    block = h.Block(pa.table({"id": list(range(4000)), "label": [0] * 4000, "code": [r.tobytes() for r in x]}), 64)
    for q in x[:5]:
        rows, scores = block.scan(q, slice(0, 4000), np.ones(4000, bool), -np.inf, np.inf, 5)
        exact = x @ q
        assert len(rows) < 100 and (scores == exact[rows]).all()
        assert set(np.argsort(-exact, kind="stable")[:5]) <= set(rows.tolist())
        rows, scores = block.scan(q, slice(0, 4000), np.ones(4000, bool), 1000, 50_000)
        assert sorted(rows.tolist()) == np.flatnonzero((exact >= 1000) & (exact <= 50_000)).tolist()


def test_negatives_of_nothing(spark, no_vectors, odd_vectors):
    from seriesmart.llm import hard_negatives as h
    assert h.mine(no_vectors, spark, F.lit(True)).collect() == []
    assert h.mine(odd_vectors, spark, F.lit(False)).collect() == []
    one = spark.createDataFrame([(0, [0.1], 1)], "vec_id long, embedding array<float>, label int")
    assert h.mine(one, spark, F.lit(True)).collect() == []
