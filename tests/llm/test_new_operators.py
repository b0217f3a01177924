"""Spelling variants, main text and periodic runs against plain Python."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter

import pytest

from tessera.llm import mincut, periodic, variants
from tessera.llm import queries  # noqa: F401
from tessera.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


# -- spelling variants -------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def last(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], last(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def plain_words(rows, one_in=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % one_in == 0 else w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def as_set(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("widest", [50, 3])
def test_variants_with_hot_chunks(spark, widest, monkeypatch):
    rnd = random.Random(widest)
    words = {"".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 8))) for _ in range(150)}
    for w in list(words):
        i, c = rnd.randrange(len(w)), rnd.choice("abxé")
        words |= {w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]}
    # a third of all words share a chunk
    words |= {"hotprefix" + "".join(rnd.choice("ab") for _ in range(rnd.randint(3, 8))) for _ in range(250)}
    counts = {w: int(5 * 5 ** (5 * rnd.random())) for w in sorted(words) if len(w) >= 6}
    monkeypatch.setattr(variants.near_pairs, "__defaults__", (widest, 5000))
    assert as_set(variants.group(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain_groups(counts)


def test_variant_chain_leads_to_its_last_form(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "zzzzzz": 7, "abcdefq": 24}
    got = as_set(variants.group(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == plain_groups(counts)
    assert {r[2] for r in got if r[0] in ("abcdef", "abcdeg", "abcdhg")} == {"abjihg"}


def test_variants_of_awkward_texts(spark):
    rnd = random.Random(4)
    pool = ["Hello", "WORLDLY", "worldly", "worldlÿ", "Éclairs", "éclairs", "naïve×x÷y", "tessera", "tesserae", "x" * 3000]
    rows = [(i, " ".join(rnd.choice(pool) for _ in range(60))) for i in range(30)] * 2
    rows += [(None, " ".join(pool)), (7, None), (8, ""), (None, None), (9, "日本 --- 12")]
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, word string, n int")
    counts = plain_words(rows, 7)
    got = variants.group(variants.vocabulary(variants.damaged(variants.words_of(docs), 7)))
    assert as_set(got) == plain_groups(counts) and len(counts) > 5
    assert variants.group(variants.vocabulary(variants.words_of(docs.limit(0)))).count() == 0
    assert as_set(variants.group(spark.createDataFrame([(None, 9), ("abcdef", None)], "word string, n long"))) == {
        (None, None, None, 9, 0, None), ("abcdef", None, "abcdef", None, 0, None)}


def test_variant_query_on_the_smallest_table(spark):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert as_set(QUERIES["op11_spelling_variants"](spark, SF)) == plain_groups(plain_words(rows))


# -- main text ---------------------------------------------------------------

BODY = ("<p>The river rose slowly in the night, and nobody in the village noticed it.</p>\n"
        "<p>By morning,  the lower\nfields were under water; the road was gone.<p>&quot;No warning,&quot; said the <b>mayor</b> in a "
        "<a href='/x'>short statement</a> &lt;today&gt;.")
TEXT = ("The river rose slowly in the night, and nobody in the village noticed it.\n"
        "By morning, the lower fields were under water; the road was gone.\n\"No warning,\" said the mayor in a short statement <today>.")
PAGES = {
    "divisions": f"""<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><div id="header"><a href=/>Home</a></div>
        <div class="cookie-banner"><p>We use cookies to improve your visit, and more. Please accept them.</p><button>OK</button></div>
        <div id="content">{BODY}<div class="advert">Buy our boots, now cheaper than ever. Order today!</div></div>
        <div class="sidebar"><ul><li><a href=1>Another story about a storm in the hills</a></li></ul></div>
        <div class="comments"><div class="comment"><p>I think this is a good article, thank you. It made my day.</p></div></div>
        <div id="footer">Copyright 2020, all rights reserved.</div>""",
    "elements": f"""<body><header><h1>The Daily</h1><nav><a href=/>Home</a></nav></header><main><article class="post">{BODY}</article>
        <section id="comments"><p>Great read, thanks for posting this. I liked it a lot, really.</p><form><textarea>abc</textarea></form></section>
        </main><aside><p>Subscribe to our letter, it is free. You get it weekly.</p></aside><footer><p>About us. Terms, and privacy.</p></footer>""",
    "plain": f"<table><tr><td><a href=1>Home</a><td><a href=2>About</a></table>{BODY}<hr><small>&copy; 2020 Someone</small>",
    "names": f"""<div class="page mainWrapper"><div class="nav-bar"><ul><li>Home<li>Shop</ul></div><div class="post-content">{BODY}</div>
        <div class="share-buttons">Share it</div><div role="complementary"><p>Text of a box, long enough to look like it.</p></div></div>""",
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_main_text_of_layouts(name):
    assert mincut.main_text(PAGES[name]) == TEXT


def test_cut_is_minimal():
    rnd = random.Random(2)
    for _ in range(150):
        n, m = rnd.randint(1, 7), rnd.randint(1, 4)
        above = [-1] + [rnd.randrange(i) for i in range(1, m)]
        parents = [rnd.randrange(m) for _ in range(n)]
        values = [rnd.uniform(-3, 3) for _ in range(n)]
        used = {0}
        for p in parents:
            while p >= 0:
                used.add(p)
                p = above[p]
        units = lambda w: round(mincut.SCALE * w)
        edges = [(i - 1, i, units(mincut.NEIGHBOUR + (mincut.SIBLING if parents[i - 1] == parents[i] else 0))) for i in range(1, n)]
        edges += [(i, n + p, units(mincut.PARENT)) for i, p in enumerate(parents)]
        edges += [(n + p, n + above[p], units(mincut.PARENT) // 2) for p in used if above[p] >= 0]

        def cost(side):
            wrong = sum(abs(units(v)) for v, s in zip(values, side) if units(v) and (v > 0) != bool(s))
            return wrong + sum(w for u, v, w in edges if side[u] != side[v])
        got = mincut.label(values, parents, above)
        assert min(cost((*got, *t)) for t in itertools.product((0, 1), repeat=m)) == min(
            cost(t) for t in itertools.product((0, 1), repeat=n + m))


def test_main_text_of_awkward_pages(spark):
    long = "<body><article>" + "".join(f"<p>part {i} of it, and so on." for i in range(3000))
    htmls = [None, "", "  ", "<", "<a \"", "a < b, and so it goes on for a while.", "<!-- open", "<div>" * 2000 + "x", "</p></div>", long,
             "<article><p>One, two &amp; three.</article>", "<script>never closed"]
    rows = [(i, None if i % 3 else "u", h, "x") for i, h in enumerate(htmls)] + [(None, None, htmls[-2], None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    got = {(r.page_id, r.text) for r in mincut.extract(pages).collect()}
    assert {(None, "One, two & three."), (0, ""), (1, ""), (2, ""), (6, ""), (8, ""), (11, "")} <= got
    assert (9, "\n".join(f"part {i} of it, and so on." for i in range(3000))) in got
    assert mincut.extract(pages).count() == len(rows) and mincut.extract(pages.limit(0)).count() == 0


def test_main_text_query(spark):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    import html
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op12_mincut_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        lines = html.unescape(re.sub("<[^>]*>", "", re.sub(r"</?(?:p|br|h1)[^>]*>", "\n", inner))).split("\n")
        assert r.text == "\n".join(" ".join(x.split()) for x in lines if x.strip()) and r.n_chars == len(r.text)


# -- periodic runs -----------------------------------------------------------

def plain_runs(words, power=4, shortest=6):
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            s = words[i:j + q]
            if j > i and size >= max(shortest, power * q) and not any(
                    all(s[t] == s[t + p] for t in range(size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_against_all_periods():
    rnd = random.Random(3)
    for _ in range(1500):
        k = rnd.choice([1, 2, 2, 3, 5])
        words = [rnd.randrange(k) for _ in range(rnd.randint(0, 50))]
        for _ in range(rnd.randint(0, 3)):
            a = rnd.randint(0, len(words))
            words[a:a] = [rnd.randrange(k) for _ in range(rnd.randint(1, 5))] * rnd.randint(2, 7)
        want = plain_runs(words)
        assert periodic.runs_of(words) == want
        assert sorted(periodic.runs_of_piece(words), key=lambda r: (r[0], r[2])) == want
        assert periodic.runs_of(words, 3, 8) == plain_runs(words, 3, 8)


def plain_row(doc_id, text):
    words = [w for w in SPACE.split(text or "") if w]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_of_awkward_texts(spark, tmp_path):
    rnd = random.Random(8)
    texts = [None, "", " \t\n", "one", "a " * 6, "a b " * 4, "a b " * 3, "a\x0b" * 7, "é\xa0é " * 9, "x " * 20000,
             " ".join(str(i) for i in range(500)) + " " + "l1 l2 l3 " * 900]
    texts += [" ".join(rnd.choice("ab") for _ in range(200)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] * 2 + [(None, "a " * 8), (None, None)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, start string, runs int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else v for v in r)
    got = sorted((tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()), key=key)
    small = [r for r in rows if r[1] is None or len(r[1]) < 3000]
    assert [r for r in got if r[0] not in (9, 10)] == sorted((plain_row(*r) for r in small), key=key)
    assert {r[1:5] for r in got if r[0] == 9} == {(1, 0, 20000, 1)}
    assert {r[1:5] for r in got if r[0] == 10} == {(1, 500, 2700, 3)}
    assert periodic.detect(docs.limit(0)).count() == 0


def test_run_query_on_the_smallest_table(spark):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in docs if len(r.text or "") < 2000}
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > 50
    for doc_id, text in short.items():
        assert got[doc_id] == plain_row(doc_id, text)
