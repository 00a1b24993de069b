"""The operators against brute-force versions, and their edge cases."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from brute_force import brute_components

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, kept string, spans string, n int"


def sentence(rng, n, words=None):
    words = words or [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "")]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, columns with clashing names."""
    rng = random.Random(1)
    base = sentence(rng, 60)
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \t\n"), (None, base), (None, "one two"), (6, "word"),
            (7, sentence(rng, 30_000)), (8, base.replace(" ", "  ").upper()), (9, base + " tail"), (10, "É ſ İ K 𝒳 " + base[:50])]
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# --- 1: archives ----------------------------------------------------------------------------

def test_archives_and_index(spark):
    from seriesmart.llm import warc_index as w
    rng = random.Random(3)
    big = "<p>" + sentence(rng, 400) + "\r\n\r\nWARC/1.1\r\n é</p>"
    rows = [(i, f"http://h{i % 7}.example.org/p/{i % 50}?q={i}", big if i % 3 == 0 else f"small {i % 4}") for i in range(400)]
    rows += [(500, None, None), (501, "", ""), (None, "http://x.org/a\tb\nc", "odd"), (503, "not a url [", big), (503, "not a url [", big), (504, "http://a.b:99999/x", "é")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    places, idx = w.archive(pages, spark)
    got = w.read(w.lookup(places.select("url_key", "page_id"), idx)).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        if r.page_id is not None:
            html = next(h for i, _, h in rows if i == r.page_id) or ""
            assert r.digest == hashlib.sha1(html.encode()).hexdigest()
            assert (r.kind, r.refers_to) == (("revisit", 503) if html == big and r.page_id != 503 else ("response", None))
            assert r.kind == "revisit" or bytes(r.payload) == html.encode()
    # one key only, and a key that isn't there
    ask = spark.createDataFrame([(w.url_key(rows[5][1]), 5), ("org,example,none)/", 1)], "url_key string, page_id long")
    assert [r.page_id for r in w.read(w.lookup(ask, idx)).collect()] == [5]
    places, idx = w.archive(pages.limit(0), spark)
    assert w.lookup(places.select("url_key", "page_id"), idx).count() == 0


def test_url_key():
    from seriesmart.llm.warc_index import url_key
    assert url_key("https://M.Example.NET/en/25#top") == "net,example,m)/en/25#top"
    assert url_key("http://a.org:8080/x?y=1") == "org,a:8080)/x?y=1"
    assert url_key(None) == url_key("") == ""


# --- 2 and 7: spans -------------------------------------------------------------------------

def brute_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def brute_secrets(t):
    out = [("assign", *m.span()) for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t, re.I | re.A) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    return sorted(out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16])


def test_spans_against_plain_patterns():
    from seriesmart.llm import pii, secret_scan
    rng = random.Random(2)
    pii_parts = ["0123456789 -+().", "1.2.3 ", "a@b.c-@.1", "ab@.% +1(2)3 45-6", "4 2-"]
    key_parts = [["token", "=", ":", " ", "'", '"', "abcdefghijkl", "api_", "key", "secret", "İ", "ſ", "K"], ["AKIA", "A", "I", "0Z", "akia", "ABCDEFGHIJKLMNOPQ"], list("0123456789abcdefg")]
    for _ in range(6000):
        t = "".join(rng.choice(rng.choice(pii_parts)) if rng.random() < .3 else rng.choice(pii_parts[rng.randrange(5)]) for _ in range(rng.choice([10, 40])))
        assert sorted(s for s in pii.find(t) if s[0] in pii.BASE) == brute_pii(t), t
        parts = rng.choice(key_parts)
        t = "".join(rng.choice(parts) for _ in range(rng.choice([4, 12, 30])))
        assert sorted(s for s in secret_scan.find(t) if s[0] in secret_scan.BASE) == brute_secrets(t), t
    assert brute_pii("4111 1111 1111 1111 9.9.9.9") and brute_pii("4111111111111111") == [("card", 0, 16)]


def test_added_spans():
    from seriesmart.llm import pii, secret_scan
    kinds = lambda f, t: {(k, t[a:b]) for k, a, b in f(t)}
    t = "ann (at) host [dot] org, http://u:pw@h.org/x, DE89 3704 0044 0532 0130 00 and Account no. 12345678"
    assert {("email_spelled", "ann (at) host [dot] org"), ("iban", "DE89 3704 0044 0532 0130 00"), ("account", "12345678")} <= kinds(pii.find, t)
    assert any(k == "url_login" for k, _, _ in pii.find(t))
    assert not any(k == "iban" for k, _, _ in pii.find("DE89 3704 0044 0532 0130 01"))
    body = "aZ" * 15
    good, bad = f"ghp_{body}{secret_scan.base62_crc(body)}", f"ghp_{body}000000"
    assert ("github", good) in kinds(secret_scan.find, f"x {good} y") and not kinds(secret_scan.find, f"x {bad} y")
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.c2ln"
    assert ("jwt", jwt) in kinds(secret_scan.find, jwt + " ")
    assert any(k == "private_key" for k, _, _ in secret_scan.find("-----BEGIN RSA PRIVATE KEY-----\nx\n-----END RSA PRIVATE KEY-----"))


def test_span_queries_and_redaction(spark, odd_docs, no_docs):
    from seriesmart.llm import pii, secret_scan
    for scan in (pii.scan, secret_scan.scan):
        assert scan(odd_docs.drop("spans")).count() == odd_docs.count()
        assert scan(no_docs.drop("spans")).count() == 0
    docs = spark.createDataFrame([(1, "a token = 'abcdefghijklmnop' b"), (2, None), (3, "")], "doc_id long, text string")
    assert [r.text for r in secret_scan.redact(docs).orderBy("doc_id").collect()] == ["a [SECRET]' b", None, ""]
    assert secret_scan.redact(odd_docs).columns == odd_docs.columns


# --- 3: quality -----------------------------------------------------------------------------

def brute_base(t):
    w, seen, covered = re.findall(r"[^\x20\x09-\x0D]+", t), defaultdict(list), set()
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(j for i in places for j in range(i, i + 8))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_quality(spark, odd_docs, no_docs):
    from seriesmart.llm import quality_llr as q
    rng = random.Random(5)
    good = [(100 + i, sentence(rng, 60)) for i in range(40)]
    bad = [(200 + i, " ".join(w + "%%%" for w in sentence(rng, 60).split())) for i in range(40)]
    small = [(300 + i, " \n\t".join(rng.choice("ab|") * rng.choice([1, 1, 2]) + rng.choice(["", "\n"]) for _ in range(rng.choice([5, 30, 80])))) for i in range(60)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(good + bad + small, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:20]] + [(i, 0, 0) for i, _ in bad[:20]] + [(None, 1, 0), (101, 0, 0)], "doc_id long, quality int, toxic int")
    got = q.score(docs.withColumn("llr", F.lit("x")), labels).collect()
    want = Counter((r.doc_id, *brute_base(r.text or "")) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in bad)
    assert q.score(no_docs, labels).count() == 0
    assert all(abs(r.llr) < 1e-12 for r in q.score(docs, labels.limit(0)).collect())


# --- 4: near duplicates ---------------------------------------------------------------------

@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, odd_docs, no_docs, k):
    from seriesmart.llm import near_dup
    rng = random.Random(k)
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    for g in range(6):  # chains of edits, from one word to most of the text
        base = sentence(rng, rng.choice([3, 4, 5, 40, 90, 150])).split()
        for i in range(14):
            w = list(base)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            rows.append((1000 + 100 * g + i, " ".join(w)))
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, component_id int")
    got = near_dup.classes(docs, spark, words=k)
    assert Counter(map(tuple, got.collect())) == Counter(brute_components(rows, k))
    assert near_dup.classes(no_docs, spark, words=k).count() == 0
    left = near_dup.distinct(docs, spark, words=k)
    assert left.columns == docs.columns
    comps = brute_components(rows, k)
    ids = [r.doc_id for r in left.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted({d for d, _, c in comps if d is not None and d == c})


@pytest.mark.parametrize("doc", [None, 7])
def test_rows_of_one_id_meet_only_their_own_class(spark, tmp_path, monkeypatch, doc):
    from seriesmart.llm import near_dup
    rng = random.Random(12)
    rows = []
    for i in range(60):  # pairs of near copies that share one id, or have none; one row is repeated
        w = sentence(rng, 60).split()
        rows += [(doc, " ".join(w)), (doc, " ".join([*w, "tail"]))] * (2 if i == 0 else 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed_texts, of = tmp_path / "hashed", near_dup.map_column
    hashed_texts.mkdir()

    def counted(df, col, out, fn):
        if not out.startswith("got"):
            return of(df, col, out, fn)

        def run(texts):
            with open(f"{hashed_texts}/{os.getpid()}", "a") as f:
                f.write("x" * len(texts))
            return fn(texts)
        return of(df, col, out, run)
    monkeypatch.setattr(near_dup, "map_column", counted)
    got = near_dup.classes(docs, spark, words=5)
    assert Counter(map(tuple, got.collect())) == Counter(brute_components(rows, 5))
    assert sum(f.stat().st_size for f in hashed_texts.iterdir()) == len(rows)  # not rows x classes


def test_distinct_decides_by_row(spark):
    from seriesmart.llm import near_dup
    rng = random.Random(13)
    a, b, c, d = (sentence(rng, 60) for _ in range(4))
    rows = [(5, a), (7, a), (5, b), (3, b),  # 5 stands for a, not for b
            (2, c), (2, c), (2, d), (2, d + " tail"), (4, d),  # repeated; near copies of one id
            (None, a), (None, a), (None, "x"), (None, "x"), (None, None), (None, None), (6, ""), (6, "")]
    got = Counter(map(tuple, near_dup.distinct(spark.createDataFrame(rows, "doc_id long, text string"), spark).collect()))
    tail = (2, d + " tail")
    assert got[(2, d)] + got[tail] == 1
    want = Counter([(5, a), (3, b), (2, c), (6, "")] + [r for r in rows if r[0] is None])
    assert Counter({r: n for r, n in got.items() if r not in ((2, d), tail)}) == want


def test_batches_drop_only_unlikely_pairs():
    from seriesmart.llm.near_dup import MISS, least_matches
    for n, m in least_matches(80):
        assert m < 0.8 * n
        assert sum(1 for _ in range(1)) and m >= 0.45 * n or n < 64
    assert MISS <= 1e-5


# --- 5: benchmark leaks ---------------------------------------------------------------------

def test_leaks(spark, odd_docs, no_docs):
    from seriesmart.llm import decontaminate as d
    rng = random.Random(7)
    items = [(i, sentence(rng, rng.choice([15, 30, 50]))) for i in range(20)]
    rows, want = [], set()
    for i in range(60):
        body = sentence(rng, 80)
        item, text = rng.choice(items)
        w = text.split()
        if i % 3 == 0:
            want.add((i, item))  # exact, in other case and with signs
            body = f"{body} {text.upper().replace(' ', ', ')} {sentence(rng, 30)}"
        elif i % 3 == 1:
            want.add((i, item))  # one word in six is another, one is left out
            for at in range(3, len(w), 6):
                w[at] = "zzz"
            del w[len(w) // 2]
            body = f"{body} {' '.join(w)}"
        else:
            body = f"{body} {' '.join(w[:5])}"  # five words are no leak
        rows.append((i, body))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(*x, "clash") for x in items] + [(90, None, ""), (91, "two words", ""), (None, sentence(rng, 20), "")], "item_id long, text string, leaks string")
    got = {(r.doc_id, x.item_id): x for r in d.leaks(docs, bench).collect() for x in r.leaks}
    assert set(got) == want
    assert all(x.score == 1 for (i, _), x in got.items() if i % 3 == 0)
    texts = dict(rows)
    for (i, item), x in got.items():
        if i % 3 == 0:
            assert texts[i][x.start:x.end].replace(", ", " ").lower() == dict(items)[item]
    assert sorted(r.doc_id for r in d.clean(docs, bench).collect()) == sorted(set(texts) - {i for i, _ in want})
    assert d.leaks(no_docs, bench).count() == 0
    assert d.clean(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_alignment_against_a_plain_table():
    from seriesmart.llm.decontaminate import GAP, MATCH, MISMATCH, align
    import numpy as np
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 9))] for _ in range(2))
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (MATCH if a[i - 1] == b[j - 1] else MISMATCH), h[i - 1][j] + GAP, h[i][j - 1] + GAP)
        assert align(np.array(a), np.array(b))[0] == max(map(max, h))


# --- 6: tokens ------------------------------------------------------------------------------

def test_tokens_against_the_library(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer
    from seriesmart.llm import bpe
    lib, own = Tokenizer.from_file(VOCABULARY), bpe.tables(VOCABULARY)
    rng = random.Random(9)
    letters = [chr(c) for c in range(0x300)] + [chr(c) for c in (0x2028, 0x200B, 0x3000, 0x1F600, 0x4E2D, 0x85, 0xA0, 0x660, 0xB2, 0x2160)]
    for i in range(3000):
        t = "".join(rng.choice(letters if i % 2 else "aaab  \n\t'stre13$") for _ in range(rng.choice([0, 3, 8, 30]))) + rng.choice(["", "<|endoftext|>", " 's <|endoftext|>x"])
        ids = lib.encode(t, add_special_tokens=False).ids
        assert list(own.encode(t)) == ids and own.decode(ids) == lib.decode(ids, skip_special_tokens=False), t
    for r in bpe.round_trip(odd_docs.withColumn("whole", F.col("text")), VOCABULARY).collect():
        assert r.decoded == (r.whole or "") and r.ids == lib.encode(r.whole or "", add_special_tokens=False).ids
    there = bpe.decode(bpe.encode(odd_docs, VOCABULARY), VOCABULARY)
    assert Counter(r.text for r in there.collect()) == Counter(r.text or "" for r in odd_docs.collect())
    assert bpe.round_trip(no_docs, VOCABULARY).count() == 0
    assert own.decode([-1, 10**9]) == "" and own.decode(None) == ""


# --- 8: toxicity ----------------------------------------------------------------------------

def test_toxicity(spark, odd_docs, no_docs):
    from seriesmart.llm import toxicity as x
    rng = random.Random(10)
    insults = ["clodpole", "dunderhead", "nincompoop", "wretchling"]
    disguise = [lambda w: w, lambda w: w.replace("o", "0").replace("e", "3"), lambda w: " ".join(w), lambda w: w[0] + w[1] * 4 + w[2:], lambda w: ".".join(w)]
    rows, toxic = [], {}
    for i in range(600):
        w = sentence(rng, 40).split()
        toxic[i] = i % 5 == 0
        for _ in range(3 if toxic[i] else 0):
            plain = rng.random() < 0.6 or zlib.crc32(str(i).encode()) % 3 != 1
            w.insert(rng.randrange(len(w)), rng.choice(disguise[:1] if plain else disguise)(rng.choice(insults)))
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(t)) for i, t in toxic.items()] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in x.rate(docs.withColumn("score", F.lit("clash")), labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert all(got[i].predicted == 0 for i in held if not toxic[i])
    assert sum(got[i].predicted for i in held if toxic[i]) >= 0.95 * sum(toxic[i] for i in held)
    # flipping the labels of held-out rows changes nothing
    other = labels.withColumn("toxic", F.when(x.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in x.rate(docs, other).collect()} == {i: r.score for i, r in got.items()}
    odd = x.rate(docs.union(odd_docs.select("doc_id", "text")), labels).collect()
    assert len(odd) == 600 + odd_docs.count() and not any(r.held_out for r in odd if r.doc_id is None)
    assert x.rate(no_docs, labels).count() == 0
    assert {r.score for r in x.rate(docs, labels.limit(0)).collect()} == {0.0}
    assert x.clean(odd_docs, labels).columns == odd_docs.columns


@pytest.mark.parametrize("text", [
    "1d!07", "[1d10t]", "*1d10t*", "-1d10t", "you/1d10t", "\u201c1d10t\u201d", "\u00ab1d10t\u00bb", "<1d10t>", "idi" + 70 * "o" + "t", "id" + 30 * "1" + "ot",
    "i/d/i/o/t", "i, d, i, o, t", "i   d   i   o   t", "! d ! 0 t", "*diot", "4$$h0l3", "$$cum", "$ c u m", "1d10t", "i.d.i.o.t"])
def test_disguises(text):
    import numpy as np
    from seriesmart.llm import toxicity as x
    counts = np.full((27, 27, 27), 0.1)
    for word in 20 * ["idiot", "asshole", "scum"] + sentence(random.Random(14), 2000).split():
        c = x._code(" " + word + " ")
        np.add.at(counts, (c[:-2], c[1:-1], c[2:]), 1)
    model = x.Restorer(np.log(counts / counts.sum(axis=2, keepdims=True)))
    assert model.words(f"so {text} there".lower()) & {"idiot", "asshole", "scum"}
    for plain in ("2024", "10:30", "$500", "123,456.78", "07.11.1999"):
        assert not set(model.restored(plain))


# --- 9: main text ---------------------------------------------------------------------------

def test_main_text(spark):
    from seriesmart.llm.html_main import extract, main_text
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><p>tagline here</p></header>
    <nav><ul><li><a href=x>Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies to make this better for all of you</p></div>
    <main><article><header><h1>The title</h1></header><p>First &amp; only a < b para&nbsp;x <a href=y>link</a> text.<br>More.</p><script>var t="</p>";</script>
    <ul><li>one</li><li>two</li></ul><!-- <p>no</p> --><aside class="related"><p>Read more here about this other thing that is long enough</p></aside>
    <form><p>Sign up now</p></form></article><section id="comments"><h2>Comments</h2><p>I liked it very much indeed, thank you all</p></section></main>
    <footer><p>&copy; 2020 all rights reserved</p></footer></body>"""
    assert main_text(page) == "The title\n\nFirst & only a < b para x link text. More.\n\none\n\ntwo"
    long = " ".join(["word"] * 60)
    assert main_text(f"<body><div><a href=1>a</a></div><div>{long}</div><p>{long}</p><div><a href=2>next page</a></div>") == f"{long}\n\n{long}"
    assert main_text(None) == main_text("") == main_text("<nav>unclosed") == ""
    pages = spark.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, "x")], "page_id long, url string, html string, n_chars string")
    assert sorted(r.text for r in extract(pages).collect()) == ["", main_text(page), main_text(page)]
    assert extract(pages.limit(0)).count() == 0


def test_main_text_of_whole_pages(spark):
    """The given pages' articles, taken by a plain pattern of their own layout."""
    import html
    from seriesmart.llm.html_main import main_text
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert main_text(r.html) == "\n\n".join(b for b in blocks if b)


# --- 10: shards -----------------------------------------------------------------------------

def test_shards(spark, odd_docs, no_docs):
    from seriesmart.llm import shards
    rng = random.Random(11)
    rows = [(i, sentence(rng, 5)) for i in range(700)] + [(1000 + i, f"group {i // 3}") for i in range(300)] + [(5000 + i, "hot") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(odd_docs.select("doc_id", "text")).withColumn("shard", F.lit("clash"))
    got = shards.assign(docs, spark).collect()
    n = docs.count()
    assert len(got) == n
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    texts = {i: t or "" for i, t in rows}
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got if r.doc_id in texts and r.doc_id >= 100)
    where = defaultdict(set)
    for r in got:
        if r.doc_id is not None and r.doc_id >= 1000:
            where[texts[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for t, s in where.items() if t != "hot") <= 5
    assert len(where["hot"]) <= 14  # 500 of 1,513 rows need eight shards at least
    assert shards.assign(no_docs, spark).count() == 0


# --- links ----------------------------------------------------------------------------------

def test_components_of_long_chains(spark):
    from seriesmart.llm.graph import components
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 200) for i in range(50)]
    random.Random(4).shuffle(links)
    got = {r.v: r.c for r in components(spark.createDataFrame(links, "a long, b long"), spark).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 100}
