"""Main-text extraction: markup rules, the site style tree, whole tables."""

import html
import re

import pytest

from casetrail.llm import queries
from casetrail.llm import style_tree as tree

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/a>A<li>B</ul></nav>
<script>var x = "</p><article>no</article>";</script><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div id="left-sidebar"><p>side</p></div>
<article class="post"><header><h1>Head &amp; line&nbsp;one</h1></header><p>First <b>bold</b>
 text<br>after break<p>Second &lt;p&gt; a<i>b</i>c<div class=ad-slot>buy</div>
<ul><li>one<li>two</ul><form><input name=q>find</form><blockquote>quoted</blockquote>
<div class="comments"><p>reader says</p></div></article>
<aside>more</aside><footer>&copy; us</footer></body></html>"""
WANT = ["Head & line one", "First bold text after break", "Second <p> abc", "one", "two", "quoted"]


def test_markup_rules():
    assert tree.main_text(ARTICLE) == "\n\n".join(WANT)


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("a < b <c", "a < b <c"),
    ("<div><nav>x</nav></div>", ""), ("</p></div>x", "x"), ("<script>never closed", ""),
    ("<!-- open", ""), ("<main><p>m</p><div role=navigation>n</div></main><p>out</p>", "m"),
    ("<article>one</article><p>no</p><article>two</article>", "one\n\ntwo"),
    ("<article><p>a<article class=comment>c</article></article>", "a"),
    ("<article>x<table><tr><td>1<td>2<tr><td>3</table>y</article>", "x\n\n1\n\n2\n\n3\n\ny"),
    ("<p a='>'>q</p>", "q"), ("<body>" + "<div>" * 3000 + "deep", "deep"),
])
def test_small_pages(page, want):
    assert tree.main_text(page) == want


def site(i, text):
    """A host without semantic markup: template boxes and one text box."""
    return (f'<body><div class=top><p>Welcome to our place</p></div><div class=text><p>{text}</p>'
            f'</div><div class=bottom><p>Call 555</p><span>Call now</span></div>')


def test_template_boxes_are_noise(spark):
    rows = [(i, "http://Host.org/" + str(i), site(i, f"story number {i} of many")) for i in range(9)]
    rows += [(100 + i, f"http://copies.org/{i}", site(i, "one story, copied")) for i in range(9)]
    rows += [(200, "http://copies.org/x", None), (201, None, "<p>lone</p>"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "c") for r in rows],
                               "page_id long, url string, html string, host string")
    out = tree.digest(tree.extract(df))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    for i in range(9):
        assert text[i] == f"story number {i} of many"
        # equal pages count once: nothing can be told to be a template
        assert text[100 + i] == "Welcome to our place\n\none story, copied\n\nCall 555\n\nCall now"
    assert text[200] == "" and text[201] == "lone"
    assert all(r.n_chars == len(r.text) for r in got)


def test_importance_is_the_entropy(spark):
    rows = [(i, "http://h/", f"<body><div><p>{t}</p></div><div id=x>{i}</div>")
            for i, t in enumerate("aabc")]
    from math import log
    got = {r.path: r for r in tree.importance(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    leaf = got["/body/div/p"]
    assert leaf.n == 4
    assert abs(leaf.importance - (1 - (log(2) / log(4) + 0 + 0) / 3)) < 1e-9
    assert abs(got["/body/div#x"].importance - 1) < 1e-9


def test_query_against_a_plain_version(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op3_style_tree(spark, sf_small).collect()}
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip()
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[p.page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert tree.digest(tree.extract(df)).collect() == []


@pytest.mark.parametrize("page, want", [
    ("<div class='has-sidebar'><article><p>a</article><div class=menu>m</div></div>", "a"),
    ("<div id='page-with-menu'><div class=related-wrap><main><p>m</main></div></div>", "m"),
    ("<div class=sidebar><p>s</div><article>a</article>", "a"),
    ("<article><div class='entry-header'><h1>Title</h1></div><p>a</article>", "Title\n\na"),
    ("<div class=comments><article class=comment>c</article></div><p>x", "x"),
])
def test_a_name_cuts_no_wrapper_of_an_article(page, want):
    assert tree.main_text(page) == want


def post(i, text):
    """A page whose article holds a host's by-line, a box and a closing line, all without names
    that mark them."""
    return (f"<body><nav>{i}</nav><article><h1>News</h1><div class=by><span class=who>By the desk"
            f"</span></div><p><b>{text}<br><p>More on {i} {text}</p><div class=also><h3>Read also</h3>"
            f"<ul><li>Our ten best</ul></div><p class=end>All rights kept</p></article>")


def test_the_tree_cuts_what_a_host_repeats_in_its_articles(spark):
    rows = [(i, f"http://post.org/{i}", post(i, f"story {i}")) for i in range(9)]
    # one article under many menus, and articles that share their first paragraph
    rows += [(100 + i, f"http://same.org/{i}", post(0, "one story").replace("<nav>0", f"<nav>{i}"))
             for i in range(9)]
    rows += [(200 + i, f"http://near.org/{i}", f"<article><h1>News</h1><p><b>Same start<br><p>End {i}"
              "</article>") for i in range(9)]
    rows += [(300 + i, f"http://main.org/{i}", f"<main><p>Text {i}</p><div class=box>Box</div></main>")
             for i in range(9)]
    got = {r.page_id: r.text for r in tree.extract(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()}
    for i in range(9):
        assert got[i] == f"News\n\nstory {i}\n\nMore on {i} story {i}"
        assert got[100 + i] == ("News\n\nBy the desk\n\none story\n\nMore on 0 one story\n\n"
                                "Read also\n\nOur ten best\n\nAll rights kept")
        assert got[200 + i] == f"News\n\nSame start\n\nEnd {i}"
        assert got[300 + i] == f"Text {i}"


def test_a_whole_article_is_no_template():
    page = "<article><h1>T</h1><p>a</p></article>"
    assert tree.main_text(page, frozenset({"/article", "/article/h1", "/article/p"})) == "T\n\na"
    assert tree.main_text(page, frozenset({"/article/p"})) == "T"
