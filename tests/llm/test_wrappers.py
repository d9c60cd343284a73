"""Main text of pages: parsing, tree matching, wrappers, whole tables."""

import html as H
import re

import numpy as np

from tumbleweed.llm import dom, wrappers
from tumbleweed.llm.queries import QUERIES


def texts(root):
    return [t for _, t, _ in wrappers.blocks(root)]


def test_parser_reads_what_browsers_read():
    page = dom.parse("<!DOCTYPE html><!-- <p>no --><p>a &amp; b<p>c<b>d<br>e</b> <i>f<div>g</div> h<script>var t='</p>x<p>';</script><hr>i &copy j &lt;k")
    assert texts(page) == ["a & b", "cd e f", "g", "h", "i © j <k"]
    assert texts(dom.parse("1 < 2 and <3 <p title='a>b' x=\"</p>\">y</p><unclosed")) == ["1 < 2 and <3", "y"]
    assert texts(dom.parse("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table>")) == ["a", "b", "c", "d", "1", "2", "3"]
    assert texts(dom.parse("<p>a \n\t b</p><!-- never closed <p>c")) == ["a b"]
    assert texts(dom.parse("x</p></div>y<style>p{}")) == ["xy"] and texts(dom.parse("")) == [] and texts(dom.parse("<")) == ["<"]
    assert texts(dom.parse("<title>t</title><textarea><p>x</textarea>z<?php <p> ?>w")) == ["z ?>w"]


def test_deep_and_wide_pages():
    deep = "<div>" * 5000 + "<p>in</p>" + "</div>" * 5000 + "<p>after</p>"
    assert texts(dom.parse(deep)) == ["in", "after"]
    wide = dom.parse("".join(f"<h2>{i}</h2><p>{i}</p>" for i in range(3000)))
    other = dom.number(dom.shape_of(dom.parse("<h2>x</h2><p>y</p>" * 2000)))
    dom.align(dom.shape_of(wide), other)  # more pairs of children than are paired optimally
    assert sum(k.slot >= 0 for k in wide.nodes) == 4000 and len(texts(wide)) == 6000


def brute_match(a, b):
    """Simple tree matching straight from its definition."""
    if a.label != b.label:
        return 0
    m = np.zeros((len(a.kids) + 1, len(b.kids) + 1), dtype=int)
    for i, x in enumerate(a.kids, 1):
        for j, y in enumerate(b.kids, 1):
            m[i, j] = max(m[i - 1, j], m[i, j - 1], m[i - 1, j - 1] + brute_match(x, y))
    return 1 + m[-1, -1]


def random_tree(rng, depth=0):
    kids = [] if depth == 3 else [random_tree(rng, depth + 1) for _ in range(int(rng.integers(0, 4)))]
    return f"<{(t := str(rng.choice(['div', 'ul', 'section'])))}>" + "".join(kids) + f"</{t}>"


def test_alignment_is_a_maximum_matching():
    rng = np.random.default_rng(3)
    for _ in range(150):
        a, b = (dom.shape_of(dom.parse(random_tree(rng) + random_tree(rng))) for _ in range(2))
        b = dom.read_shape(b.text)
        dom.align(a, b)
        slots = [s.slot for s in a.all() if s.slot >= 0]
        assert len(slots) == len(set(slots)) == brute_match(a, b)
        assert slots == sorted(slots)  # order is kept
        assert dom.read_shape(a.text).text == a.text


def page(body):
    return f"<html><head><title>T</title></head><body>{body}</body></html>"


def rows(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string")


def extracted(spark, data, **options):
    out = wrappers.extract(rows(spark, data), **options)
    assert out.columns == ["page_id", "url", "text"]
    return {r["page_id"]: r["text"] for r in out.collect()}


def soup(i, n):
    """A site of plain boxes: only repetition tells its menu, notice and footer from the text."""
    paragraphs = "".join(f"<p>Paragraph {j} of story {i} &amp; more words to read here.</p>" for j in range(n))
    return page("<div><div>Our Site</div><div><a href=/>Home</a> <a href=/n>News</a></div>"
                f"<div><h1>Story number {i}</h1><div>We use tracking. Accept?</div><div>{paragraphs}</div></div><div>All rights reserved by us forever.</div></div>")


def soup_text(i, n):
    return "\n".join([f"Story number {i}", *(f"Paragraph {j} of story {i} & more words to read here." for j in range(n))])


def test_constant_nodes_are_template(spark):
    data = [(i, f"https://soup.example/{i}", soup(i, 1 + i % 5)) for i in range(12)]
    data.append((50, "https://soup.example/cut", soup(50, 3)[:-60]))  # breaks off
    assert extracted(spark, data) == {i: soup_text(i, 1 + i % 5) for i in range(12)} | {50: soup_text(50, 3)}


def test_marked_regions_are_template_whatever_varies(spark):
    def marked(i):
        return page(f"<header>Head {i}</header><nav><ul><li><a>Menu {i}</a></ul></nav><div class='ad'>Buy {i}</div><div id=cookie-notice>ok {i}</div>"
                    f"<article><header><h1>Title {i}</h1></header><p>Text {i} with <span class='ad-inline'>ad</span>words, and with rather more of them.</p><aside>See {i}</aside>"
                    f"<form>Mail {i}<input></form><p>Released under the MIT License.</p></article><section class='comments'><p>Comment {i} is long "
                    f"and goes on and on and on, much longer than the text.</p></section><div role=complementary>More {i}</div><footer>&copy; {i}</footer>")

    data = [(i, f"https://m.example/{i}", marked(i)) for i in range(6)]
    got = extracted(spark, data)
    # the license line stands in every article of this host: constant, so template
    assert got == {i: f"Title {i}\nText {i} with words, and with rather more of them." for i in range(6)}
    few = extracted(spark, data[:2])  # too few pages to tell
    assert few == {i: f"Title {i}\nText {i} with words, and with rather more of them.\nReleased under the MIT License." for i in range(2)}


def test_copies_of_one_article_are_kept(spark):
    same = [(i, f"https://copy.example/{i}", page(f"<nav>Menu {i}</nav><article><p>One and the same text.</p></article>")) for i in range(8)]
    assert set(extracted(spark, same).values()) == {"One and the same text."}


def test_pages_unlike_their_host(spark):
    data = [(i, f"http://h.example/{i}", page(f"<article><h1>A {i}</h1><p>text {i}</p></article>")) for i in range(6)]
    data += [(10, "http://h.example/x", page("<div id=odd><p>another build</p><p>of page</p></div>")), (11, "http://h.example/y", "plain words only"),
             (12, None, page("<p>no url</p>")), (13, "nohost", page("<p>no host</p>")), (14, "http://h.example/z", None), (15, "http://h.example/w", ""),
             (None, "http://one.example/", page("<main><p>alone</p></main>")), (3, "http://h.example/3", data[3][2])]
    got = extracted(spark, data)
    assert got[3] == "A 3\ntext 3" and got[10] == "another build\nof page" and got[11] == "plain words only"
    assert (got[12], got[13], got[14], got[15], got[None]) == ("no url", "no host", "", "", "alone")


def test_links_lists_are_menus_where_nothing_is_marked(spark):
    links = "".join(f"<li><a href=/{j}>Topic number {j}</a></li>" for j in range(8))
    data = [(i, f"http://l.example/{i}", page(f"<div><ul>{links.replace('Topic', f'Topic {i}')}</ul><div><p>{'Story words ' * 20}{i}.</p><p>End {i}.</p></div></div>"))
            for i in range(5)]
    assert extracted(spark, data) == {i: f"{('Story words ' * 20)}{i}.\nEnd {i}." for i in range(5)}


def test_wrappers_travel_by_broadcast_or_join_alike(spark):
    data = [(i, f"https://h{i % 3 if i % 2 else 0}.example/{i}", soup(i, 1 + i % 4)) for i in range(40)]
    want = extracted(spark, data)
    assert extracted(spark, data, broadcast_bytes=0, hot_hosts=2) == want == extracted(spark, data, broadcast_bytes=0, hot_hosts=1000)


def test_shuffled_and_clashing_columns(spark):
    data = [(i, f"https://soup.example/{i}", soup(i, 2)) for i in range(6)]
    wide = rows(spark, data).selectExpr("*", "'x' AS host", "1 AS shape", "2 AS wrapper", "3 AS text").repartition(3)
    assert {r["page_id"]: r["text"] for r in wrappers.extract(wide).collect()} == {i: soup_text(i, 2) for i in range(6)}
    assert wrappers.extract(rows(spark, [])).collect() == []


def article(source):
    """The text of the only article of a page of the given tables, by regular expressions."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
    inner = re.sub(r"</?(?:p|h1)>", "\n", re.sub(r"\s+", " ", re.sub(r"</?b>|<[^>]*$", "", inner.replace("<br>", " "))))
    return "\n".join(t for t in (" ".join(H.unescape(x).split()) for x in inner.split("\n")) if t)


def test_query_equals_regular_expressions(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op12_html_text"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]
