"""HTML rendering: literal pages, and the pages table against the standard parser."""

import re
import time
from html.parser import HTMLParser

import pytest

from quillsieve.llm import html_text, queries
from quillsieve.llm.html_text import page_text

CASES = {
    "one  two\n three": "one two three",
    "<p>a<p>b": "a\n\nb",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<h1>T</h1>x<h2>U</h2>": "T\n\nx\n\nU",
    "<b>a</b> <i>b</i>c": "a bc",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "- a\n- b\n  - c\n- d\n\ne",
    "<ol start=9><li>a<li><p>b</p>c</ol>": "9. a\n10. b\n\n    c",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu",
    "<pre>a  b\n  c</pre>d": "a  b\n  c\n\nd",
    "<table><tr><th>n<th>long name<tr><td>1000<td>x</table>z": "n     long name\n1000  x\n\nz",
    "<table><tr><td>a</td><td><p>b</p><p>c</p></td><td>d</td></tr></table>": "a  b  d\n\n   c",
    "<table><tr><td colspan=2>wide<td>e<tr><td>a<td>b<td>c</table>": "wide  e\na  b  c",
    "<table><tr><td><table><tr><td>i<td>j</table><td>k</table>": "i  j  k",
    "<p>a<table><tr><td>x</td></tr></table>b": "a\n\nx\n\nb",
    "<p hidden>a</p><p style='display: none'>b</p><span style=visibility:hidden>c</span>d": "d",
    "<style>.x, p#y {display:none} #z{display:none}</style><p class='q x'>a</p><p id=z>b</p><p id=y>c": "c",
    "<details>a<summary>s</summary>b<p>c</p></details>d": "s\nd",
    "<details open><summary>s</summary>b</details>": "s\nb",
    "<script>if (a<b) '</p>'</script>x<!-- <p>no --><noscript>n</noscript>": "x",
    "<title>t</title><textarea> a\n b</textarea>": " a\n b",
    "a &lt; b &amp;amp; &copy &#x41; < c": "a < b &amp; © A < c",
    "<a title=\"x > y\" href='z'>t</a>": "t",
    "</p></div>a</b></li>": "a",
    "<li>a</li><td>b": "- a\nb",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "a<": "a<",
    "a<b": "a",
    "a<!--": "a",
    "<select><option>a<option>b</select>": "a\nb",
    "": "",
}


@pytest.mark.parametrize("source", CASES)
def test_cases(source):
    assert page_text(source) == CASES[source]


def test_null_and_operator(spark):
    rows = [(1, "<p>a", 5), (2, None, 6), (2, "", 7)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id int, html string, page_text int"))
    assert got.columns == ["page_id", "html", "page_text"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [(1, "<p>a", "a"), (2, None, None), (2, "", "")]))
    assert html_text.extract(spark.createDataFrame([], "html string")).collect() == []


@pytest.mark.parametrize("part", ["<div>", "<p>", "<", "<a b=\"", "<td>", "<!--", "&amp", "<ul><li>", "<table>", "='"])
def test_long_and_deep_pages_end(part):
    start = time.time()
    page_text(part * 20_000 + "x")
    assert time.time() - start < 20


@pytest.mark.parametrize("page", [
    "<table><tr><td>" + "long " * 20_000 + "<td>x" + "<tr><td>a<td>b" * 3_000 + "</table>",
    "<table><tr>" + "<td colspan=1000>c" * 800 + "</table>",
    "<table><tr>" + "<td>c" * 40_000 + "</table>",
    "<table><tr>" + f"<td>{'w' * 79}" * 1_000 + "<tr><td colspan=999><td>x" * 3_000 + "</table>",
    "<table><tr><td>" + "a<br>" * 20_000 + "<td>b" * 5_000 + "</table>",
    "<table><tr><td>x<br>y" * 2_000 + "z",
    "<table><tr><td colspan=99999999999>a<td>b" * 50,
])
def test_tables_stay_in_proportion(page):
    start = time.time()
    text = page_text(page)
    assert time.time() - start < 10 and len(text) < 30 * len(page)


def test_wide_cells_and_tables():
    long = "word " * 30
    assert page_text(f"<table><tr><td>a<td>{long}<td>c<tr><td>d<td>e<td>f</table>z") == f"a\n{long.strip()}\nc\nd  e  f\n\nz"
    wide = "<table>" + "".join("<tr>" + "".join(f"<td>{r}{'x' * (70 if r == c % 2 else 1)}" for c in range(8)) for r in range(2)) + "</table>"
    first, second = page_text(wide).split("\n")
    assert first.split("  ") == [f"0{'x' * (70 if c % 2 == 0 else 1)}" for c in range(8)] and second.split("  ")[0] == "1x"
    # A span takes the room of the columns that have cells of their own.
    assert page_text("<table><tr><td colspan=500>a<td>b<tr><td>c<td>d</table>") == "a     b\nc  d"


def test_whole_page():
    page = """<html><head><title>no</title><style>.ad { display: none }</style></head><body>
      <h1>Report</h1><p class=ad>buy</p><p>Two  words<br>and a line.
      <ul><li>one<ol><li>first<li>second</ol><li>two</ul>
      <table><thead><tr><th>Name<th>Value</thead><tbody><tr><td>alpha<td>1<tr><td>b<td><p>2</p><p>3</p></tbody></table>
      <pre>  keep
   this</pre><script>var no = 1</script><footer>End</footer></body></html>"""
    assert page_text(page) == (
        "Report\n\nTwo words\nand a line.\n\n- one\n  1. first\n  2. second\n- two\n\n"
        "Name   Value\nalpha  1\nb      2\n\n       3\n\n  keep\n   this\n\nEnd"
    )


def test_rules_hold_at_any_depth():
    spans = "<span>" * 600
    assert page_text(spans + "a<script>var x = '<p>no';</script><style>p{}</style><div hidden>h</div>b<ul><li>c</ul>d") == "ab\n\n- c\n\nd"
    assert page_text("<b>" * 700 + "<table><tr><td>1<td>2<tr><td>3<td>4</table></b>z") == "1  2\n3  4\n\nz"
    # An end tag closes its own element, not one of the same name further out.
    assert page_text("<div hidden>" + spans + "<div>x</div>y</div>z") == "z"


class Plain(HTMLParser):
    """Words and block borders only: enough for pages without tables, lists within lists or hidden parts."""

    def __init__(self):
        super().__init__()
        self.skip, self.lines = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "head")
        if tag in html_text.BLOCKS or tag == "br":
            self.lines.append("")
        if tag == "li":
            self.lines[-1] = "- "

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "head")
        if tag in html_text.BLOCKS:
            self.lines.append("")

    def handle_data(self, data):
        if not self.skip:
            self.lines[-1] += data


def test_table(spark, sf_dir):
    want = {}
    for row in queries.table(spark, sf_dir, "pages").collect():
        parser = Plain()
        parser.feed(row.html)
        parser.close()
        want[row.page_id] = [x for x in (re.sub(r"\s+", " ", x).strip() for x in parser.lines) if x]
    got = {r.page_id: [x for x in r.text.split("\n") if x] for r in queries.op4_html_text(spark, sf_dir).collect()}
    assert got == want
