import collections
import gzip
import hashlib
import io
import random
import re
import time
from html import unescape

import pytest

from fundalake.llm import common, html_extract, warc
from fundalake.llm.html_extract import Page

PAGES = "page_id long, url string, html string"


def text(html):
    return "\n".join(Page(html).blocks())


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<body><nav>m</nav><article><h1>A &amp; b</h1><p>x  <b>y\n</b>z<br>w<p>q</article><footer>f</footer>", "A & b\nx y z w\nq"),
        ("<html><head><title>t</title><script>var t='</p>';</script></head><body><div>one<div class='ad'>no</div>two</div>", "one\ntwo"),
        ("<main><ul><li>a<li>b</ul><aside>s</aside><form><input>f</form></main>", "a\nb"),
        ("<article><header><h1>h</h1></header><div id=comments><article class=comment>c</article></div><p>1 &lt; 2 <!-- x --></article>", "h\n1 < 2"),
        ("plain &eacute;&#233;&nbsp; text", "plain éé text"),
        ("<p title='a>b'>x</p><p hidden>y</p><p>a < b", "x\na < b"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<article><div class='entry-header'><h1>Title</h1></div><p>x</p></article>", "Title\nx"),
        ("<article><p class='related-work'>a</p><p id=search>b</p><section class=notices>c</section><div class=ad>no</div><p class=advert>no</p></article>", "a\nb\nc"),
        ("<p>q <select><option>o</select> r", "q\nr"),
        ("<aside><article>teaser</article></aside><p>main text</p>", "main text"),
        ("<p>a <math><mi>x</mi></math> b</p>", "a x b"),
        ("<article><p>text</p><div class=comment-list><p>reader</p></div><ul class='comment-list'><li>reader</ul><div class=ad-box>no</div></article>", "text"),
        ("<main><p>text</p><div class=related-posts>a</div><div class=newsletter-signup>b</div><div class='cookie-notice'>c</div><div class=sidebar-box>d</div><div class=post-footer>e</div><div class=login>f</div><label>g</label></main>", "text"),
        ("<main><div class='has-sidebar content-comments'><p>text</p></div></main>", "text"),
        ("<div class='post-header'><h1>Title</h1></div><div class='site-header'>Site</div><p>x</p>", "Title\nx"),
        ("<div><article><h2>teaser</h2></article><p>the main text of the page is here</p></div>", "teaser\nthe main text of the page is here"),
        ("<article><p>the main text of the page is here</p></article><p>outside</p>", "the main text of the page is here"),
        ("", ""),
    ],
)
def test_blocks(html, want):
    assert text(html) == want


def test_broken_markup_ends():
    rng = random.Random(1)
    for _ in range(300):
        text("".join(rng.choice(["<p", ">", "</p>", "<div class=\"", "\"", "'", "<", "<!--", "-->", "<li>", "</ul>", "a ", "&amp", "<script>", "</article>", "<article>"]) for _ in range(40)))


def test_long_broken_markup_takes_time_in_proportion():
    began = time.time()
    for html in ("<b><table>" + "<i>" * 50_000 + "</b>" * 50_000, "<table>" + "<p>" * 3 + "<em>" * 50_000 + "<p>" * 50_000, "<a \"" * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "<p><b>" * 50_000 + "<h1>" * 50_000, "<" * 100_000):
        Page(html).blocks()
    assert time.time() - began < 40


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_test_pages_against_plain_substitution(spark, sf):
    """Their main text is what stands in the article, which regular expressions can take apart on these well-formed pages."""
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article[^>]*>(.*?)</article>", r.html or "", re.S)
        body = re.sub(r"<br\s*/?>", " ", article[1]) if article else ""
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)\b[^>]*>", "\n", body))
        assert got[r.page_id] == "\n".join(x for x in (" ".join(unescape(line).split()) for line in body.split("\n")) if x)


@pytest.mark.parametrize("small_rows", [1 << 18, -1])
def test_templates_against_a_plain_count(spark, monkeypatch, small_rows):
    """Hosts of random boxes: what is on 4 pages of a host, and on 5 % of them, goes; both plans of the join."""
    monkeypatch.setattr(common, "SMALL_ROWS", small_rows)
    rng = random.Random(4)
    rows, boxes = [], {}
    for i in range(240):
        host = rng.choice(["hot.example"] * 4 + ["b.example", "c.example"])
        boxes[i] = host, rng.sample([f"box {k}" for k in range(40)], rng.randint(0, 3)) + [f"own {i}"]
        rows.append((i, f"http://{host}/{i}", "<body>" + "".join(f"<div>{b}</div>" for b in boxes[i][1]) + "</body>"))
    n = collections.Counter(h for h, _ in boxes.values())
    on = collections.Counter((h, b) for h, bs in boxes.values() for b in bs)
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: "\n".join(b for b in bs if on[h, b] < max(4, 0.05 * n[h])) for i, (h, bs) in boxes.items()} and max(on.values()) >= 8


def test_templates_go_and_copied_articles_stay(spark):
    page = lambda i, body: (i, f"http://h.example/{i}", f"<body><div><span>Menu of the site</span></div><div><p>{body}</p></div></body>")
    rows = [page(i, f"text number {i}") for i in range(20)] + [page(100 + i, "the same article") for i in range(20)] + [(200, "http://other.example/", "<body><div><span>Menu of the site</span></div><p>alone</p></body>")]
    rows += [(300, None, None), (301, None, ""), (300, None, None)]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == ("text number 3", 13) and got[105] == ("the same article", 16)
    assert got[200][0] == "Menu of the site\nalone"
    assert got[300] == ("", 0) and got[301] == ("", 0) and len(got) == 43
    assert html_extract.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_paragraphs_of_articles_are_never_templates(spark):
    rows = [(i, f"http://h.example/{i}", f"<article><h1>t{i}</h1><p>common passage</p><div>box</div></article>") for i in range(20)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[7] == "t7\ncommon passage"


def archive(pages):
    return b"".join(warc.member(warc.record(i, u, p, len(p), hashlib.sha1(p).hexdigest(), None, False)) for i, u, p in pages)


@pytest.mark.parametrize("step", [1, 7, 100_000])
def test_reader(step, monkeypatch):
    monkeypatch.setattr(warc, "_READ", step)
    pages = [(1, "http://a/ \r\nX: y", b"p" * 3000), (2, None, b""), (None, "u", bytes(range(256)) * 40 + b"\r\n\r\n")]
    got = [warc.parse(h, b) for h, b in warc.Reader(io.BytesIO(archive(pages)))]
    assert [(g["page_id"], g["payload"]) for g in got] == [(i, p) for i, _, p in pages]
    assert gzip.decompress(archive(pages)).count(b"WARC/1.1\r\n") == 3


def test_reader_finds_damage():
    data = archive([(1, "u", b"hello " * 100)])
    with pytest.raises(warc.Broken):
        list(warc.Reader(io.BytesIO(data[:-20])))
    plain = gzip.decompress(data)
    with pytest.raises(warc.Broken):
        [warc.parse(h, b) for h, b in warc.Reader(io.BytesIO(warc.member(plain.replace(b"hello", b"hallo", 1))))]
    with pytest.raises(warc.Broken):
        list(warc.Reader(io.BytesIO(warc.member(plain + plain))))


def test_revisits(spark):
    big, small = "é" * 500, "x" * 999
    rows = [(1, "a", big), (2, "b", big), (3, "c", big), (4, "d", small), (5, "e", small), (6, None, None), (3, "c", big), (None, "n", big)]
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to, r.payload_digest) for r in warc.round_trip(spark.createDataFrame(rows, PAGES)).collect())
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    assert got == [(0, 1000, "revisit", 3, sha(big)), (1, 1000, "revisit", 3, sha(big)), (2, 1000, "revisit", 3, sha(big)), (3, 1000, "response", None, sha(big)), (3, 1000, "response", None, sha(big)), (4, 999, "response", None, sha(small)), (5, 999, "response", None, sha(small)), (6, 0, "response", None, sha(""))]
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
