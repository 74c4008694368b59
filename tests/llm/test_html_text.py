import hashlib
from html.parser import HTMLParser

import pytest
from authweave.llm import html_text, queries
from authweave.llm.html_text import render
from authweave.llm.tables import table

CASES = [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<div>a</div><div>b</div>", "a\nb"), ("a <b>b</b>  <i> c</i>", "a b c"), ("<ul><li>a<li>b</ul>", "- a\n- b"),
    ("<ol start=4><li>a</li><li value=9>b</li><li>c</ol>", "4. a\n9. b\n10. c"),
    ("<ul><li>a<ul><li>x<li>y</ul><li>b</ul>", "- a\n  - x\n  - y\n- b"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><thead><tr><th>n<th>q</thead><tbody><td>x<td>1</table>", "n  q\nx  1"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td colspan=2>wide one<td>z<tr><td>a<td>b<td>c</table>", "wide one  z\na  b  c"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"), ("<table><caption>T</caption><tr><td>x</table>", "T\nx"),
    ("<pre>  a\n    b</pre>", "  a\n    b"), ("x<script>var a='</p>';</script>y<style>p{}</style>z", "xyz"),
    ("<title>t</title><body>b", "b"), ("a<!-- no --> b", "a b"), ("<p hidden>x</p>y", "y"), ("<p style='display: none'>x</p>y", "y"),
    ("<p style='visibility:hidden'>x<b style='visibility:visible'>v</b></p>", "v"),
    ("<style>.h, #k {display:none} i{visibility:hidden}</style><p class='a h'>x</p><p id=k>y</p><i>z</i>w", "w"),
    ("1 < 2 & 3 > 2", "1 < 2 & 3 > 2"), ("a <b title='>'>c</b>", "a c"), ("<a href=x>l", "l"), ("a</p>b", "a\n\nb"),
    ("<details><summary>s</summary>hid</details><details open><summary>t</summary>seen</details>", "s\nt\nseen"),
    ("<blockquote>q<p>r</blockquote>", "  q\n\n  r"), ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("<h1>a<h2>b", "a\n\nb"),
    ("<input value=v><input type=hidden value=h><button>go</button>", "vgo"), ("<textarea> a\n b</textarea>", " a\n b"),
    ("&#233;&nbsp;x", "é x"), ("<select><option>a<option>b</select>", "a\nb"), ("unclosed <b", "unclosed"),
    ("<!DOCTYPE html><?php x ?>t", "t"), ("<p>a<table><tr><td>b</table>c", "a\n\nb\n\nc"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert render(page) == text


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>t</title><body><p>text", "text"), ("<head><title>t</title><p>a</p>b", "a\n\nb"),
    ("<head><meta charset=x>\n plain", "plain"), ("<head><style>p{}</style><link rel=x></head><body>b", "b"),
    ("<head><template><p>x</p></template><title>t</title><div>d", "d"), ("a<head>b", "ab"),
])
def test_open_head_ends_where_the_body_begins(page, text):
    assert render(page) == text


@pytest.mark.parametrize("page,text", [
    ("<p>Hi</p>Visible tail <!-- cut", "Hi\n\nVisible tail"), ("plain text <!-- cut", "plain text"),
    ("1 < 2 <!-- cut", "1 < 2"), ("<!-- cut", ""), ("<p>a<!-- b > c", "a"),
    ("a<noscript> no <b>script</b></noscript> z", "a no script z"),
    ("<head><noscript><link rel=x></noscript><title>t</title></head>b", "b"),
    ("<head><noscript><p>x</p></noscript></head><body>y", "x\n\ny"),
])
def test_text_before_an_open_comment_and_in_noscript(page, text):
    assert render(page) == text


def test_missing_and_extreme_pages():
    assert render(None) == ""
    assert render("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert render("<ul><li>" * 3000 + "x").split()[-1] == "x"
    assert len(render("<p>word " * 50_000).split()) == 50_000
    assert render("<" * 20_000) == "<" * 20_000
    assert render("<a =\"" * 5_000) == ""  # one tag that the page leaves open
    assert render("<table>" + "<tr><td colspan=99999999>a<td>b" * 3 + "</table>").split() == ["a", "b"] * 3


@pytest.mark.parametrize("page, text", [
    ('<p>Hi</p>Visible tail <a href="x', "Hi\n\nVisible tail"),
    ("<p>tail </di", "tail"), ("x<!doctype", "x"), ("x <!-- cut", "x"), ("x <?xml", "x"),
    ("a < b", "a < b"), ("1 <2", "1 <2"), ("a <", "a <"), ("a </", "a </"), ("a <b>c</b", "a c"),
    ("<p>a < b <i", "a < b"), ("", ""), ("<", "<"),
])
def test_markup_cut_by_the_end(page, text):
    assert render(page) == text


class Words(HTMLParser):
    """Words of visible text by the plainest reading, for the pages of the test tables."""

    def __init__(self):
        super().__init__()
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title")
        self.words.append(" ")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title")
        self.words.append(" ")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_query_keeps_all_visible_words(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, folder, "pages").collect()}
    rows = queries.op9_html(spark, folder).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        plain = Words()
        plain.feed(pages[r.page_id])
        plain.close()
        kept = "".join(r.text.split()).replace("-", "")
        assert kept == "".join("".join(plain.words).split()).replace("-", "")
        assert r.n_chars == len(r.text) and r.text_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a", "x"), (None, None, "y"), (1, "<p>a", "x")], "page_id long, html string, text string")
    rows = sorted(((r.page_id, r.text, r.n_lines) for r in html_text.extract(pages).collect()), key=str)
    assert rows == [(1, "a", 1), (1, "a", 1), (None, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0
