"""Manifest, page extraction and whitening: against brute force."""

import hashlib
import html as html_module
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import extraction, manifest, whitening

SMALL = "/root/testdata/sf0.001"


# ---- manifest
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows):
    """(doc_id, source, lang, n_chars, text) -> the contract's columns, one tree at a time."""
    leaves = {}
    for doc_id, source, lang, n, text in rows:
        leaf, changed = (h(field(doc_id), field(source), field(lang), field(x), field(text)) for x in (n, None if n is None else n + 1))
        picked = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        leaves.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, changed if picked else leaf, doc_id))

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def way(t, i):
        for level in t[:-1]:
            yield i & 1, level[i ^ 1] if (i ^ 1) < len(level) else None
            i >>= 1

    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([leaf[2] for leaf in sorted(leaves[x])]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (_, _, leaf, node, doc_id) in enumerate(sorted(leaves[lang])):
            steps = [*way(trees[lang], i), *way(top, k)]
            for odd, other in steps:
                node = h(node) if other is None else h(other, node) if odd else h(node, other)
            out.append((doc_id, leaf, trees[lang][-1][0], top[-1][0], h(*[s for _, s in steps if s]), node, node == top[-1][0]))
    return sorted(out, key=repr)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got_manifest(docs):
    return sorted((tuple(r) for r in manifest.manifest(docs).select(MANIFEST).collect()), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    r = random.Random(5)
    return [(r.choice([None, 5, 5, 7, -3, 2**62, -(2**63), i, i * 1_000_003]), r.choice([None, "a", ""]),
             r.choice([None, "", "é", "z", "-", "=a"]), r.choice([None, 1, 2**63 - 1]), r.choice([None, "", "t é", "x" * i]))
            for i in range(2500)] + [(5, "a", "z", 1, "same")] * 1200


def odd_docs(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, slot long, g string, leaf int"
    return spark.createDataFrame([(*r, 1, "g", 2) for r in rows], schema).repartition(3)


def test_manifest_against_brute_force(spark, odd_rows):
    """Null, negative, huge and repeated ids, more than a slot array of one id, nulls in all columns, clashing names."""
    assert got_manifest(odd_docs(spark, odd_rows)) == brute_manifest(odd_rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 1025])
def test_manifest_of_few_rows(spark, n):
    rows = [(i * 3, "s", "en", i, "t") for i in range(n)]
    assert got_manifest(odd_docs(spark, rows)) == (brute_manifest(rows) if n else [])


def test_manifest_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = got_manifest(docs)
    assert got == brute_manifest(rows)
    assert any(not r[-1] for r in got)


# ---- extraction
def plain_article(page):
    """The article of the test pages, whose only tags there are h1, p, b and br."""
    found = re.search("<article>(.*)</article>", page or "", re.S)
    blocks = re.split("</?(?:p|h1)>", found[1] if found else "")
    texts = [" ".join(html_module.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_extraction_of_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = extraction.extract(pages).collect()
    assert len(got) == len(html)
    for r in got:
        assert r["text"] == plain_article(html[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


MARKED = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><a href="/">Home</a></nav><div class="cookie-notice"><p>We use cookies.</p></div>
<article class="post"><header><h1>Title {0}</h1></header><p>One <b>bold</b>ness &amp; two&nbsp;three<br>four {0}<p>Unclosed {0} <i>text
<div class="ad-box">Buy!</div><aside>Note</aside><ul><li>a<li>b</ul><script>"</article>"</script><table><tr><td>c<td>d {0}</table>
<form><input><button>Go</button></form><footer>By me</footer><!-- <p>no</p> --></article>
<section id="comments"><article><p>Reader {0} says</p></article></section><footer>&copy; x</footer></body></html>"""
SOUP = """<div id="x1"><div><a href="/a">Home</a> <a href="/b">News</a></div><div><h1>Head {0}</h1><div>Body {1} {0}</div><div>More {1} {0}</div>
<blockquote>Follow us today</blockquote></div><div>All rights reserved by us</div></div>"""


def test_marked_parts_and_unmarked_templates(spark):
    words = "lorem ipsum dolor sit amet " * 20
    rows = [(i, "https://A.example/x", MARKED.format(i), "h", 1) for i in range(5)]
    rows += [(10 + i, f"https://soup.example/{i}", SOUP.format(i, words), "h", 1) for i in range(5)]
    rows += [(20, "https://soup.example/", None, "h", 1), (21, None, "", "h", 1), (22, None, "just text", "h", 1),
             (23, "u", "<p>a<p>b &lt;c&gt; &am <x", "h", 1), (0, "https://A.example/x", MARKED.format(0), "h", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, slot int").repartition(3)
    got = sorted((r["page_id"], r["text"]) for r in extraction.extract(pages).collect())
    marked = lambda i: f"Title {i}\n\nOne boldness & two three four {i}\n\nUnclosed {i} text\n\na\n\nb\n\nc\n\nd {i}"
    soup = lambda i: f"Head {i}\n\nBody {words}{i}\n\nMore {words}{i}"
    expected = [(i, marked(i)) for i in range(5)] + [(10 + i, soup(i)) for i in range(5)] + [
        (20, ""), (21, ""), (22, "just text"), (23, "a\n\nb <c> &am"), (0, marked(0))]
    assert got == sorted(expected)
    found = {r["host"]: r["wrapper"] for r in extraction.wrappers(pages).collect()}
    assert found["a.example"].count("(<li>#</li>)+") == 1
    assert extraction.extract(pages.limit(0)).collect() == []


def test_wrappers_find_options_and_repeated_groups():
    def tree(page):
        shape = extraction.Page(page).shape()
        for s in shape.slots():
            s.stat = (1, 1, 1, 0, 1, 1)
        return shape

    one = tree("<h2>a</h2><p>b</p><p>c</p><h2>d</h2><p>e</p><h2>f</h2><p>g</p>")
    assert extraction.expression(one) == "<html>(<h2>#</h2>(<p>#</p>)+)+</html>"
    both = extraction.merge(tree("<div>x</div><p>a</p><table><tr><td>1</table>"), tree("<p>a</p><ul><li>z</ul><table><tr><td>1</table>"))
    assert extraction.expression(both) == "<html>(<div>#</div>)?<p>#</p>(<ul><li>#</li></ul>)?<table><tr><td>#</td></tr></table></html>"


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "deep", "<p class='a%d'>x" * 10, "<" * 100_000, "<a=" * 50_000, "<p>x<h2>y" * 20_000,
                                  "<td><div>x</td>" * 20_000, "&#55555;&#0;" * 1000, '<p a="' * 30_000, "<li>x" * 50_000])
def test_long_and_broken_pages(page):
    shape = extraction.Page(page).shape()
    stats = [extraction.page_stats(extraction.Page(page), s) for s in shape.slots()] if len(page) < 10_000 else None
    assert extraction.read(extraction.json.loads(extraction.shape_text(shape)), iter(stats or [None] * 100_000))


def test_wrapper_is_the_same_however_pages_are_dealt(spark):
    r = random.Random(2)
    rows = [(i, f"http://{r.choice('ab')}.x/", "".join(f"<{t}>{i}</{t}>" for t in r.choices(["p", "h2", "div", "pre"], k=r.randint(1, 7)))) for i in range(900)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one, many = (sorted(tuple(x) for x in extraction.wrappers(pages.repartition(n)).collect()) for n in (1, 7))
    assert one == many and len(one) == 2


# ---- whitening
def test_divide_and_conquer_finds_the_spectrum():
    r = np.random.default_rng(1)
    cases = [np.eye(4), np.zeros((3, 3)), np.ones((12, 12)), np.diag(np.arange(9.0)), np.array([[1, 0.5], [0.5, 1.0]]), np.array([[2.0]])]
    for d in (2, 7, 40):
        x = r.normal(size=(3 * d, d)) * np.logspace(0, -3, d)
        q, _ = np.linalg.qr(r.normal(size=(d, d)))
        for a in (x.T @ x, x[: d // 2].T @ x[: d // 2], (q * np.repeat([3, 2, 2, 1e-9], d)[:d]) @ q.T, (q * np.logspace(0, -14, d)) @ q.T):
            cases.append((a + a.T) / 2)
    for a in cases:
        values, vectors = whitening.eigen(a)
        scale = np.linalg.norm(a) or 1
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * scale
        assert np.abs(a @ vectors - vectors * values).max() <= 1e-14 * scale
        assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() <= 1e-14


def brute_whitening(rows):
    keep = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) and abs(64 * c) < 2**62 for c in v)]
    lengths = Counter(len(x) for _, x in keep)
    d = min(lengths, key=lambda k: (-lengths[k], k))
    keep = [k for k in keep if len(k[1]) == d]
    fit = sorted({tuple(x) for _, x in keep})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centre = lambda x: np.array([(n * a - s) / n for a, s in zip(x, sums)])
    c = np.array([centre(x) for x in fit])
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(16, d)
    rows = [(i, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), centre(x) @ u[:, :k] / np.sqrt(e[:k])) for i, x in keep]
    return rows, e[:k] / np.trace(v)


def agree(got, rows):
    expected, explained = brute_whitening(rows)
    k = len(explained)
    assert len(got) == k * len(expected)
    ours = {}
    for g in got:
        assert abs(g["explained"] - explained[g["component"] - 1]) <= 1e-12 and g["identity_error"] <= 1e-12
        ours.setdefault(g["component"], []).append(g)
    for c, rows_of in ours.items():
        theirs = np.array([w[c - 1] for *_, w in expected])
        sign = lambda x: 1 if sum(v**3 for v in x) >= 0 else -1
        a = sorted((str(g["vec_id"]), g["n"], g["deviation"], round(sign([g["whitened"] for g in rows_of]) * g["whitened"], 7) + 0.0) for g in rows_of)
        b = sorted((str(i), n, d, round(sign(theirs) * w[c - 1], 7) + 0.0) for i, n, d, w in expected)
        assert [x[:3] for x in a] == [x[:3] for x in b]
        assert np.abs(np.array([x[3] for x in a]) - np.array([x[3] for x in b])).max() <= 2e-7


def test_whitening_against_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(i if i % 9 else None, [float(np.float32(c)) for c in r.normal(size=5) ** 3 * [100, 1, 5, 0.2, 30]]) for i in range(300)]
    rows += [rows[3]] * 50
    odd = [(901, None), (902, []), (903, [1.0, None, 2.0, 3.0, 4.0]), (904, [float("nan")] * 5), (905, [float("inf")] * 5),
           (906, [1.0, 2.0]), (907, [3e38] * 5)]
    frame = spark.createDataFrame([(i, v, 1, 0.0) for i, v in rows + odd], "vec_id long, embedding array<float>, n long, x double")
    agree(whitening.whiten(frame.repartition(4)).collect(), rows + odd)
    assert whitening.whiten(frame.limit(0)).collect() == []
    got = whitening.whiten(frame.where("vec_id = 3")).collect()  # one vector: nothing to whiten
    assert {(g["n"], g["deviation"], g["whitened"], g["explained"], g["identity_error"]) for g in got} == {(1, 0, 0.0, 0.0, 0.0)}


def test_whitening_of_embeddings(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    agree(whitening.whiten(frame).collect(), [(r["vec_id"], r["embedding"]) for r in frame.collect()])


def test_deviations_are_exact(spark):
    rows = [(1, [1e15, 2.0]), (2, [-1e15, 3.0]), (3, [0.0, 1e3])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {g["vec_id"]: g["deviation"] for g in whitening.whiten(frame).where(F.col("component") == 1).collect()}
    assert got[1] is None and got[2] is None
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    sums = [sum(c) for c in zip(*x.values())]
    assert got[3] == sum((3 * a - s) ** 2 for a, s in zip(x[3], sums))
