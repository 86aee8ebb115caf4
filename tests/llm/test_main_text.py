"""Main text: hand-made layouts, a brute-force version of the vote, and the given pages by a plain reading of their one layout."""

import html
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import main_text
from tidemark.llm.main_text import best_container, extract_page, parse

SCHEMA = "page_id long, url string, html string"


def plain(s):
    """The given pages hold their text in one article of headings and paragraphs."""
    m = re.search(r"<article>(.*?)(</article>|<footer|$)", s or "", re.S)
    body = re.sub(r"<[^>]*$", "", m.group(1)) if m else ""
    body = re.sub(r"<(/?(p|h1|br))>", " ", body)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", body)).split())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    t = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    want = {r.page_id: plain(r.html) for r in t.collect()}
    rows = main_text.extract(t).collect()
    assert {r.page_id: r.text for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


P1 = "The first paragraph, which is long enough to be an article's text, has some commas, and more words than any menu."
P2 = "A second one follows &amp; ends here; it isn&rsquo;t short either, as good texts go &#8212; or do they&hellip;"
T = f"{P1} {html.unescape(P2)}"
JUNK = """<header><h2>Site name</h2><a href=/>Home</a></header><nav><ul><li><a href="/a">Menu item that is quite long</a><li><a href=/b>Other</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site, and this notice says so at some length, twice, in fact.</p></div>"""
TAIL = """<div id="sidebar"><p>Sidebar text that goes on, and on, and on, with commas, so that it may look like an article.</p></div>
<section class="comments"><h2>Comments</h2><article class="comment"><p>First! I have read this text, and I think, well, that it is fine.</p></article></section>
<form><p>Subscribe to our letter, please, it comes each week.</p><input type=text><button>Go</button></form><footer>&copy; us</footer>"""
LAYOUTS = {
    "article": (f"<html><body>{JUNK}<article><h1>Title</h1><p>{P1}</p><p>{P2}</p></article>{TAIL}</body></html>", f"Title {T}"),
    "own header": (f"<body>{JUNK}<article><header><h1>Title</h1></header><p>{P1}<p>{P2}<aside>Ad.</aside></article>{TAIL}", f"Title {T}"),
    "div": (f"<body class='has-sidebar nav-open'>{JUNK}<div class='post post-17'><h1>Title</h1><div class=text><p>{P1}<p>{P2}</div></div>{TAIL}", f"Title {T}"),
    "main with sections": (f"<body>{JUNK}<main><h1>Title</h1><section><p>{P1}</section><section><p>{P2}</section></main>{TAIL}", f"Title {T}"),
    "bare body": (f"<p>{P1}<p>{P2}", T),
    "no tags": (P1, P1),
    "inline": (f"<article><p>wo<b>rd</b>s a<br>b<i> c</i>\n\n d</p><p>{P1}</p><ul><li>x<li>y</ul><script>if (a<b) '</p>'</script></article>", f"words a b c d {P1} x y"),
    "quotes": (f"<article><p title='a > b'>{P1}</p><a href=\"x>y\">link</a> 1 < 2 <p data-x=\"unclosed>{P2}</p></article>", f"{P1} link 1 < 2 {html.unescape(P2)}"),
    "cut in a tag": (f"<body>{JUNK}<article><h1>Title</h1><p>{P1}</p><p>{P2}</p><di", f"Title {T}"),
    "cut in a script": (f"<article><p>{P1}</p><script>var x = 1;", P1),
    "cut in a comment": (f"<article><p>{P1}</p><!-- never ends <p>x</p>", P1),
    "table": (f"<article><table><tr><td>1<td>2<tr><td>3</table><p>{P1}</article>", f"1 2 3 {P1}"),
    "empty": ("", ""), "white": (" \n\t", ""), "only a menu": ("<nav><a href=x>Menu</a></nav>", ""),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    s, want = LAYOUTS[name]
    assert extract_page(s, []) == want


def test_deep_and_very_long_pages():
    deep = "<div>" * 20_000 + f"<p>{P1}</p>"
    assert extract_page(deep, []) == P1
    assert extract_page("<article>" + f"<p>{P1}</p>" * 20_000 + "</article>", []) == " ".join([P1] * 20_000)
    assert extract_page("<a href=\"" * 3000, []) == ""


def test_consensus(spark):
    page = lambda cls, p: f"<body><div class='{cls}'><p>{p}</div><div class='extra'><p>{'Longer text of a box, on one page only. ' * 9}</div>"
    good = f"<body><div class='story'><p>{P1}<p>{P2}</div><div class='extra'><p>Short.</div>"
    rows = [(i, f"https://h.example/{i}", good) for i in range(9)] + [(9, "http://H.example:80/x", page("story", P1)), (10, None, page("story", P1)),
            (11, "https://other.example/", page("story", P1)), (12, "https://h.example/", None), (12, "https://h.example/", None), (None, "//h.example", good)]
    t = spark.createDataFrame(rows, SCHEMA).withColumn("host", F.lit("clash")).withColumn("paths", F.lit(1)).withColumn("text", F.lit("x")).repartition(4)
    got = sorted(((r.page_id, r.url, r.text) for r in main_text.extract(t).collect()), key=str)
    votes, hosts = {}, {}
    for _, url, s in rows:
        host = re.match(r"(?:\w+:)?//([^/:]+)", url.lower()).group(1) if url else None
        best = best_container(parse(s)) if s else None
        if host and best:
            votes.setdefault(host, {}).setdefault(best.path, 0)
            votes[host][best.path] += 1
        hosts[url] = host
    win = {h: [p for n, p in sorted((-n, p) for p, n in v.items()) if -n >= 0.1 * sum(v.values())] for h, v in votes.items()}
    assert got == sorted(((i, u, extract_page(s or "", win.get(hosts[u], []))) for i, u, s in rows), key=str)
    by = {i: x for i, _, x in got}
    assert by[9] == P1 and by[10] != P1 and by[11] != P1 and by[12] == "" and by[None] == T


def test_empty(spark):
    assert main_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0
