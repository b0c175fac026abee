"""HTML extraction, URL filter and nearest neighbours on odd rows and against brute force."""

import re
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from netquery.llm import ann, html_extract, url_filter

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><div>My site</div></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies. <button>OK</button></div><!-- <p>hidden</p> -->
<article><h1>A  title &amp; more</h1><p>First &lt;para&gt;\n  with <b>bold</b> and <a href="x">a link</a>, and some more words to read.<p>Second paragraph, unclosed, goes on for a while.
<ul><li>item one<li>item two</ul><p>Last paragraph of the story&#33;</p></article>
<aside class="sidebar"><p>Related stories</p></aside><div class="comments"><p>I liked it</p></div>
<form><label>Mail</label><input name=q><textarea>x</textarea></form><footer>&copy; 2024</footer></body></html>"""
ARTICLE = ["A title & more", "First <para> with bold and a link, and some more words to read.", "Second paragraph, unclosed, goes on for a while.",
           "item one", "item two", "Last paragraph of the story!"]


def test_blocks_of_a_page():
    texts = [t for t, _, _ in html_extract.blocks(PAGE)]
    assert [t for t in texts if t in ARTICLE] == ARTICLE
    assert "T & t" not in texts and not any("hidden" in t or "var a" in t or t in ("OK", "x") for t in texts)
    assert html_extract.blocks(None) == [] and html_extract.blocks("  ") == [] and [t for t, _, _ in html_extract.blocks("plain <b>te</b>xt")] == ["plain text"]
    assert html_extract.blocks("<p title='unclosed>x") is not None
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert [t for t, _, _ in html_extract.blocks(deep)] == ["x"]


def test_no_text_is_lost_behind_raw_and_hidden_elements():
    say = lambda h: [t for t, _, _ in html_extract.blocks(h)]
    for between in ("<svg width='1'/>", "<svg><title>T</title><text>no</text></svg>", "<video-player></video-player>", "<title-bar>", "<button>", "<select>", "<textarea>",
                    "<svg>", "<button>OK</button>", "<math/>", "<iframe>", "<template>", "<BUTTON class='a>b'><div>go</div></Button >", "<script>1 < 2 </p></script >", "<style/>p{}</style>",
                    "<select><option>no</option></select>", "<template><p>no</p></template>"):
        assert say(f"<body><p>A</p>{between}<p>B</p></body>") == ["A", "B"], between
    assert say("<p>A <math><mi>x</mi></math> end</p>") == ["A x end"] and say("<p>A <noscript>n</noscript><object>o</object> <audio>s</audio></p>") == ["A no s"]
    assert say("<p>A <button>no <p>B</p></button>C") == ["A", "B", "C"]
    assert say("<p>A</p><script>x") == ["A"] and say("<title>x<p>A") == ["x", "A"]
    many = "<button>" * 20_000 + "<p>A</p>" + "<textarea>" * 20_000 + "<p>B</p>" + "<svg>" * 20_000 + "C"
    assert say(many) == ["A", "B", "C"]


def test_a_long_page_keeps_all_blocks(spark):
    parts = [f"Sentence {i} of a long article, with some words." for i in range(20_000)]
    page = "<html><body><nav><a href=x>Go</a></nav><article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article><footer>Legal</footer></body></html>"
    small = [f"<html><body><nav><a href='/{i}'>Go</a></nav><article><h1>Head line {i}</h1><p>Some text, with words. More text here.</p></article></body></html>" for i in range(40)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate([page, *small])], "page_id long, url string, html string")
    got = html_extract.op2_html_extract(spark, pages).where("page_id = 0").first()
    assert got.text == "\n\n".join(parts) and got.n_chars == len(got.text)


def test_elements_in_the_middle_of_deep_paths_count():
    page = lambda *es: html_extract.blocks("<html><body>" + "<div>" * 8 + "".join(f"<{e}>" for e in es) + "<div>" * 40 + "<p>Some text, with words.")
    some = [page("article"), page("nav"), page("article", "aside"), page("div")]
    for i, a in enumerate(some):
        for b in some[:i]:
            assert (html_extract.vectors(a) != html_extract.vectors(b)).any()
    assert [p[0][1].article for p in some] == [True, False, False, False]
    after = html_extract.blocks("<body>" + "<div>" * 20 + "<nav class=x><p>in</p></nav>" + "<div>" * 20 + "<p>Some text</p>")
    assert after[1][1].bits == html_extract.blocks("<body>" + "<div>" * 40 + "<p>Some text</p>")[0][1].bits      # closed elements leave nothing


def test_extraction_equals_marked_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_extract.op2_html_extract(spark, pages).collect()}
    for r in pages.collect():
        a = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", a)]
        assert got[r.page_id].text == "\n\n".join(x for x in parts if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_other_layouts():
    pages = [f"<html><body><nav><a href='/{i}'>Go</a></nav><article><h1>Head line {i}</h1><p>Some text, with words. More text here.</p></article></body></html>" for i in range(40)]
    net = html_extract.train(pages)
    p = html_extract.blocks(PAGE)
    flags = net.label([html_extract.vectors(p)])[0]
    assert [t for (t, _, _), f in zip(p, flags, strict=True) if f] == ARTICLE
    other = html_extract.blocks("<body><div id=navigation><a>One</a><a>Two</a></div><div class='post content'><h2>Title of it</h2><p>Long text, with many words in it. And more.</p>"
                                "<p>Another paragraph of text, as long as that.</p></div><div class=sidebar><p>Side</p></div><div class=footer>Legal</div></body>")
    flags = net.label([html_extract.vectors(other)])[0]
    assert [t for (t, _, _), f in zip(other, flags, strict=True) if f] == ["Title of it", "Long text, with many words in it. And more.", "Another paragraph of text, as long as that."]


def test_pages_odd_rows(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (None, "http://a.com", "<p>x</p>"), (3, "HTTP://A.Example.ORG/es/x?q#f", PAGE), (3, "HTTP://A.Example.ORG/es/x?q#f", PAGE), (4, "x://h#f", "   ")]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, text int, host string")
    got = html_extract.op2_html_extract(spark, pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (1, 2, 4)} == {""}
    judged = url_filter.op5_url_filter(spark, pages).collect()
    by = {r.page_id: r for r in judged}
    assert len(judged) == len(rows) and by[3].host == "a.example.org" and by[3].path == "/es/x" and by[3].rule == "example.org/es/" and by[3].verdict == "block"
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("", "", None, "allow") and (by[4].host, by[4].path) == ("h", "")
    for q in (html_extract.op2_html_extract, url_filter.op5_url_filter):
        assert q(spark, pages.where("false")).count() == 0


def test_distrust_flows_against_links(spark):
    link = lambda *hosts: " ".join(f'<a href="https://{h}/p">x</a>' for h in hosts)
    pages = spark.createDataFrame([(1, "http://bad.com/de/x", ""), (2, "http://spam.net/x", link("bad.com", "bad.com")), (3, "http://good.org/x", link("fine.net")), (4, "http://fine.net/x", "")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert [got[i].verdict for i in (1, 2, 3, 4)] == ["block", "block", "allow", "allow"]
    assert got[2].distrust > got[2].trust and got[4].trust > 0 and got[4].distrust == 0


def test_distrust_reaches_far_and_small_hosts(spark):
    link = lambda h: f'<a href="https://{h}/p">x</a>'
    hosts = ["bad.com", *[f"h{i}.net" for i in range(13)]]
    rows = [(0, "http://bad.com/de/x", "")] + [(i, f"http://{h}/x", link(hosts[i - 1])) for i, h in enumerate(hosts) if i]         # distrust goes up the chain
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].verdict == "block" and got[i].distrust > 0 == got[i].trust for i in range(14))
    seeds = spark.createDataFrame([("distrust", "s", 1)], "kind string, host string, pages long")
    share = spark.createDataFrame([("distrust", "s", "t", 1.0), ("distrust", "t", "s", 1.0)], "kind string, src string, dst string, share double")
    score = {r.host: r.score for r in url_filter.propagate(seeds, share).collect()}
    assert abs(score["s"] - 1 / 1.85) < 1e-6 and abs(score["t"] - 0.85 / 1.85) < 1e-6
    pages = spark.createDataFrame([(0, "http://small.net/x", link("tail.com")), (1, "http://tail.com/de/x", ""), (-1, "http://large.net/x", link("tail.com") * 2000)], "page_id long, url string, html string")
    e = spark.range(2_000_000).selectExpr("id + 2 AS page_id", "'http://bad.com/de/x' AS url", "CAST(NULL AS string) AS html")
    for rest in (None, e):                       # the verdict does not depend on the other blocked pages
        judged = url_filter.op5_url_filter(spark, pages if rest is None else pages.unionByName(rest)).where("page_id IN (0, 1)").collect()
        assert [r.verdict for r in judged] == ["block", "block"]


def brute(ids, x, k):
    out = {}
    for i in ids:
        if i % 20 == 0:
            q = x[ids.index(i)]
            s = [(-float((v * q).sum()), j) for j, v in zip(ids, x, strict=True) if j != i]
            out[i] = [(j, -a) for a, j in sorted(s)[:k]]
    return out


def test_neighbours_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in e], np.array([r.embedding for r in e], float)
    want = brute(ids, x, 20)
    got = {}
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, cell=100).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(want)
    hits = 0
    for i, rows in got.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21)) and all(a.score >= b.score for a, b in zip(rows, rows[1:], strict=False))
        assert all(abs(r.score - float((x[ids.index(r.vec_id)] * x[ids.index(i)]).sum())) < 1e-12 for r in rows)
        hits += len({r.vec_id for r in rows} & {j for j, _ in want[i]})
    assert hits >= 0.9 * 20 * len(want)


def test_neighbours_prune_and_find_clusters(spark):
    r = np.random.default_rng(2)
    centres = r.standard_normal((12, 16)) * 4
    x = centres[r.integers(0, 12, 1500)] + 0.2 * r.standard_normal((1500, 16))
    want = brute(list(range(1500)), x, 5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for row in ann.nearest(df, F.col("vec_id") % 20 == 0, k=5, cell=100).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    assert sum(len(got[i] & {j for j, _ in want[i]}) for i in want) >= 0.9 * 5 * len(want)


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows += [(100 + i, [2.0, 1.0]) for i in range(1, 40) if (100 + i) % 20] + [(101, [2.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in ann.op8_nearest_neighbours(spark, df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {0, 20}
    assert [v for _, v, _ in sorted(got[0])] == [100 + i for i in range(1, 22) if (100 + i) % 20][:20]
    assert ann.op8_nearest_neighbours(spark, df.where("false")).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.5]), (1, [1.0, 0.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in sorted(ann.op8_nearest_neighbours(spark, few).collect(), key=lambda r: r.rank)] == [(1, 1.0), (2, -1.0)]


def test_chi_square_quantile():
    draws = (np.random.default_rng(0).standard_normal((200_000, 8)) ** 2).sum(1)
    assert (draws <= ann.chi_square_quantile(0.9, 8)).mean() == pytest.approx(0.9, abs=0.005)


def test_neighbours_of_very_large_and_small_vectors(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((300, 6))
    x[7], x[20], x[33], x[40], x[41] = np.eye(6)[0] * 1e200, np.eye(6)[0] * 1e200, -np.eye(6)[1] * 1e300, x[40] * 1e-200, np.eye(6)[2] * 5e-324
    ids = list(range(300))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for row in sorted(ann.nearest(df, F.col("vec_id") % 20 == 0, k=8, cell=64, chance=0.999999).collect(), key=lambda r: r.rank):
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert set(got) == {i for i in ids if i % 20 == 0}
    for i in got:
        with np.errstate(over="ignore"):
            scores = (x * x[i]).sum(1)
        best = sorted((j for j in ids if j != i), key=lambda j: (-scores[j], j))[:8]
        assert [v for v, _ in got[i]] == best and all(s == scores[v] for v, s in got[i])
    assert got[20][0] == (7, float("inf"))


def test_neighbours_of_repeated_ids(spark):
    rows = [(0, [3.0, 1.0]), (0, [1.0, 0.0]), (1, [0.5, 9.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.op8_nearest_neighbours(spark, df).collect())
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 0.5)]
