import re

import pytest

from conftest import SMALL
from ebbline.llm import htmltext
from ebbline.llm.htmltext import rendered

CASES = {
    "paragraphs close each other": ("<p>a<p>b", "a\n\nb"),
    "a block closes a paragraph": ("<p>a<div>b</div>c", "a\n\nb\nc"),
    "line breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "spaces run together": ("a  \n b<b> c </b> d", "a b c d"),
    "lists": ("x<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>y", "x\n\n- a\n- b\n  3. c\n  4. d\n\ny"),
    "numbered by value": ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
    "aligned table": ("<table><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td>fig<td>3</table>", "Name   Qty\napple  10\nfig    3"),
    "spans": ("<table><tr><td colspan=2>a<td>b<tr><td>c<td>d<td>e</table>", "a     b\nc  d  e"),
    "caption and sections": ("<table><caption>C</caption><thead><tr><th>a<tbody><tr><td>b<tfoot><tr><td>c</table>", "C\na\nb\nc"),
    "table in a cell": ("<table><tr><td><table><tr><td>in<td>n2</table><td>o</table>", "in  n2  o"),
    "cells without rows": ("<table><td>a<td>b</table>", "a  b"),
    "not visible": (
        "<head><title>t</title></head>a<script>s('</p>')</script><style>x</style><template>t</template><noscript>n</noscript>"
        "<p hidden>h</p><i style='color:red; display : none'>d</i><i style='visibility:hidden'>v</i><input type=hidden value=q>b<!-- c -->",
        "ab",
    ),
    "visible again behind hidden": ("<div hidden>a<p>b</div>c", "c"),
    "closed details": ("<details>x<summary>S</summary>hid<p>den</details>y", "S\ny"),
    "open details": ("<details open><summary>S</summary>seen</details>y", "S\nseen\ny"),
    "preformatted": ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    "entities": ("a &amp; &lt;b&gt; &eacute;&#x41;", "a & <b> éA"),
    "unmatched tags": ("</div>a</p>b<b>c</i>d", "a\n\nbcd"),
    "quoted angle": ("<a title='x>y'>z</a>", "z"),
    "text with less-than": ("1 < 2 and 3<4", "1 < 2 and 3<4"),
    "unfinished": ("a<!-- b", "a"),
    "unfinished script": ("a<script>b", "a"),
    "textarea": ("<textarea><b>x</b></textarea>", "<b>x</b>"),
    "end tag of a cell's outside": ("<div><table><tr><td>a</div>b</table></div>", "ab"),
    "head ended by body content": ("<html><head><title>t</title><p>Hello</p>", "Hello"),
    "head ended by text": ("<head><meta charset=x><script>s</script> \n Hello <b>you</b>", "Hello you"),
    "a later head is no head": ("<p>a<head>b</head>c", "abc"),
    "noscript in a head": ("<head><noscript><img><p>n</noscript><title>t</title></head>a", "a"),
    "empty comments": ("a<!-->b<!--->c", "abc"),
    "comment ended by --!>": ("a<!--x--!>b", "ab"),
    "CDATA is a comment up to >": ("a<![CDATA[x>b", "ab"),
    "CDATA in SVG is text": ("a<svg><text><![CDATA[x>y]]></text></svg>b", "ax>yb"),
    "end tag of no name": ("a</3 x>b</>c</", "abc</"),
    "visible inside hidden": ("a<div style='visibility: hidden'>b<ul><li>l</ul><i style='Visibility:VISIBLE'>c</i>d</div>e", "a\n\nc\ne"),
    "not shown inside display none": ("<div style='display:none'><i style='visibility:visible'>c</i></div>e", "e"),
    "last declaration counts": ("<i style='display:none;display:inline'>a</i><i hidden style='display:block'>b</i>", "ab"),
    "cells outside a table": ("<td>a<td>b<tr><td>c", "a b\nc"),
    "inputs": ("<input type=number value=7> <input type=date value=2024-02-01> <input type=password value=s><input type=checkbox value=on>", "7 2024-02-01"),
    "option groups": ("<select><optgroup label=Fruit><option>fig<option>pear</select>", "Fruit\nfig\npear"),
    "row spans": ("<table><tr><td rowspan=2>ab<td>c<tr><td>d<tr><td>e<td>f</table>", "ab  c\n    d\ne   f"),
    "row and column spans": ("<table><tr><td>a<td rowspan=2 colspan=2>bb<td>c<tr><td>d<td>e</table>", "a  bb    c\nd        e"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_rendering(name):
    page, want = CASES[name]
    assert rendered(page) == want


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "x", "<table><tr><td>" * 3000 + "x", "<ul><li>" * 3000 + "x", "<p>" * 60_000 + "x", "</p>" * 60_000 + "x", "<" * 30_000 + "x>", "<!" * 30_000])
def test_deep_and_long_pages_end(page):
    assert len(rendered(page)) < 30_000_000


def test_events_are_balanced():
    for page, _ in CASES.values():
        stack = []
        for kind, name, _ in htmltext.tree_events(page):
            if kind == "start":
                stack.append(name)
            elif kind == "end":
                assert stack.pop() == name
        assert not stack


def test_given_pages_keep_all_visible_words(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    texts = {row.page_id: row.text for row in htmltext.extract_text(pages).collect()}
    for row in pages.collect():
        body = re.sub(r"(?s)<head.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", row.html)
        from html import unescape

        want = unescape(re.sub(r"</?(?:b|i|em|strong|span|a)\b[^>]*>", "", body))
        want = re.sub(r"<[^>]*>", " ", want)
        got = re.sub(r"(?m)^ *(?:-|[0-9]+\.) ", "", texts[row.page_id])
        assert got.split() == want.split()


def test_odd_rows(spark):
    schema = "page_id long, html string, text string, row string"
    rows = [(1, None, "t", "r"), (2, "", "t", "r"), (3, "<p>x", "t", "r"), (3, "<p>x", "t", "r"), (None, "y", "t", "r")]
    found = htmltext.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((row.page_id, row.text) for row in found), key=str) == sorted([(1, ""), (2, ""), (3, "x"), (3, "x"), (None, "y")], key=str)
    assert htmltext.extract_text(spark.createDataFrame([], schema)).count() == 0


QUOTES = {
    "quote inside an unquoted value": ("<p title=Bob's>Hello don't stop</p>", "Hello don't stop"),
    "quote at the end of an unquoted value": ("<a x=5'>text", "text"),
    "quote behind a name": ('<p a"b>one</p><p>say "two"</p>', 'one\n\nsay "two"'),
    "quote never closed": ('<a title="x>text', "text"),
    "spaces around the sign": ("<a title = 'x>y' href= \"u>v\">z</a>", "z"),
    "no value": ("<a title=>z</a>", "z"),
    "values side by side": ("<p a='1>'b=\"2>\"c=3>z", "z"),
    "slashes": ("<a href=/x/y'z/>it's</a><br/>b", "it's\nb"),
    "hidden behind an unquoted value": ("<p title=Bob's hidden>no</p>it's", "it's"),
}


@pytest.mark.parametrize("name", QUOTES)
def test_quotes_in_tags(name):
    page, want = QUOTES[name]
    assert rendered(page) == want


@pytest.mark.parametrize("page", ["<a " + "b=c' " * 60_000, "<a b='" * 60_001 + "x", "<a b=c" + "=" * 60_000 + '"', "<a" + " " * 60_000 + "'"])
def test_long_tags_end(page):
    assert len(rendered(page)) < 1_000_000
