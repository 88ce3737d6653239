import random
import re
import time

import pytest

from seasonframe.llm.html_text import extract_text, parse, text_of

CASES = {
    "plain": ("a  b\n c", "a b c"),
    "inline": ("Hi <b>bo</b>ld <i> it </i>x", "Hi bold it x"),
    "paragraphs, implied ends": ("<p>one\n two<p>three<div>four</div>five", "one two\n\nthree\n\nfour\nfive"),
    "line breaks": ("a<br>b<br><br>c<br/>d", "a\nb\n\nc\nd"),
    "head, scripts and styles": ("<html><head><title>T</title><meta x><style>p{}</style></head><body>x<script>var a='</p>';</script>y<template>z</template>", "xy"),
    "comments and declarations": ("<!DOCTYPE html><!-- a --> x <!-->y<?php echo ?>z<![CDATA[q]]>", "x yz"),
    "hidden": ('a<div hidden>b</div><p style="color:red; display : none">c<p>d</p><span style="visibility:hidden">e<b style="visibility: visible">f</b></span>', "a\n\nd\n\nf"),
    "entities": ("&lt;b&gt; &amp; &eacute;&#x41;&#66; &nbsp;x &bogus;", "<b> & éAB \xa0x &bogus;"),
    "lists": ("<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>", "- a\n- b\n  - c\n  - d\n- e"),
    "ordered": ('<ol start=9><li>a<li value="20">b<li>c<p>d</ol>', "9. a\n20. b\n21. c\n\n    d"),
    "reversed": ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    "definitions": ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\n    v\nl\n    w"),
    "table": ("<table><caption>C</caption><tr><th>Name<th>N<tr><td>Al<td>10<tr><td colspan=2>wide cell<tr><td>x</table>", "C\nName  N\nAl    10\nwide cell\nx"),
    "table of wide characters": ("<table><tr><td>漢字<td>a<tr><td>b<td>c</table>", "漢字  a\nb     c"),
    "cells of several lines": ("<table><tr><td>a<br>b<td>c<tr><td>d<td>e</table>", "a  c\nb\nd  e"),
    "table without rows' tags": ("<table><td>a<td>b</table>", "a  b"),
    "text misplaced in a table": ("<table>stray<tr><td>a</table>", "stray\na"),
    "nested table": ("<table><tr><td>x<td><table><tr><td>1<td>2</table></table>", "x  1  2"),
    "pre": ("<pre>\n  a\n\n   b &amp;</pre>c", "  a\n\n   b &\n\nc"),
    "quote": ("a<blockquote>b<p>c</blockquote>d", "a\n\n    b\n\n    c\n\nd"),
    "images": ("<img src=x alt='a cat'> b", "a cat b"),
    "unclosed and misnested": ("<div><p>a<b>b</div>c</i></b></table>d", "ab\n\ncd"),
    "attributes with marks": ("<a title='x > y' href=\"<z>\">t</a>", "t"),
    "unclosed tag, quote and comment": ("a<p title='x", "a"),
    "unclosed comment": ("a<!-- b", "a"),
    "less-than": ("1 < 2 <3 a<b", "1 < 2 <3 a"),
    "form": ("<select><option>a<option>b</select><textarea> x </textarea><input value=q><button>Go</button>", "a\nb\nx Go"),
    "dialog": ("<dialog>no</dialog><dialog open>yes</dialog><details><summary>s</summary>d</details>", "yes\ns"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    source, want = CASES[name]
    assert text_of(source) == want


def test_all_visible_words_of_random_markup_come_out_in_order():
    rng = random.Random(1)
    tags = ["div", "p", "b", "ul", "li", "span", "section", "h2", "blockquote", "ol", "pre", "dd", "table", "tr", "td"]
    for _ in range(300):
        parts, words = [], []
        for i in range(30):
            parts.append(f"<{rng.choice(tags)}>" if rng.random() < 0.6 else f"</{rng.choice(tags)}>")
            words.append(f"w{i}")
            parts.append(f" w{i} ")
        found = text_of("".join(parts)).split()
        assert sorted(w for w in found if w.startswith("w")) == sorted(words)


@pytest.mark.parametrize(
    "bad",
    ["<" * 100_000, "<div>" * 50_000 + "x", "<table><tr><td>" * 3000 + "x", "<ul><li>" * 3000 + "x", "<a b='" * 5000, "<!--" * 50_000, "</p>" * 30_000,
     "<p " * 50_000, "<b>" * 20_000 + "</i>" * 20_000, "<script>" * 3000, "&" * 100_000, "a" * 3_000_000, "<li>" * 30_000],
)
def test_hostile_pages_end_soon(bad):
    began = time.time()
    text_of(bad)
    assert time.time() - began < 20


def test_tree_has_implied_elements():
    body = parse("<table><td>a").children[0]
    assert body.children[0].name == "table" and body.children[0].children[0].name == "tr"


def test_pages_with_odd_values(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "<p>a", "x", 1), (3, "<p>b", "x", 1), (3, "<p>b", "x", 1)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, html string, text string, url int")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == [(1, ""), (2, ""), (3, "b"), (3, "b"), (None, "a")]
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_cells_that_span_rows_keep_their_columns():
    assert text_of("<table><tr><td rowspan=2>A<td>B1</tr><tr><td>B2</table>") == "A  B1\n   B2"
    page = "<table><tr><td>a<td rowspan=3>long<td>c<tr><td rowspan=0>d<td>e<tr><td>f<tbody><tr><td>g<td>h<td>i</table>"
    assert text_of(page) == "a  long  c\nd        e\n         f\ng  h     i"
    assert text_of("<table><tr><td rowspan=2 colspan=2>x y<td>z<tr><td>w<tr><td>p<td>q<td>r</table>") == "x y   z\n      w\np  q  r"


def test_what_is_visible_again_inside():
    hidden, shown = "style='visibility:hidden'", "style='visibility: visible'"
    assert text_of(f"<ul><li>one<li {hidden}>two<b {shown}>seen</b><li>three</ul>") == "- one\n  seen\n- three"
    assert text_of(f"<ol><li>a<li {hidden}>b<li>c</ol>") == "1. a\n3. c"
    assert text_of(f"<table><tr {hidden}><td>no<td {shown}>yes<tr><td>left<td {hidden}>x<p {shown}>right</p></table>") == "      yes\nleft  right"
    assert text_of(f"<table><tbody {hidden}><tr><td>gone</tbody><tbody style='display:none'>loose<tr><td {shown}>gone</table>") == ""


def test_closed_details_show_their_summary():
    body = "<summary>head</summary><p>body</p>"
    assert text_of(f"<details>{body}</details>") == "head"
    assert text_of(f"<details open>{body}</details>").split() == ["head", "body"]
    assert text_of("<details><p>body</p></details>end") == "end"


def random_page(rng, depth, visible, words):
    """Markup and, in ``words``, what of it shows, in order: by the rules of inheritance alone."""
    parts = []
    for _ in range(rng.randint(1, 3)):
        word = f"w{len(words[1])}"
        words[1].append(word)
        if visible:
            words[0].append(word)
        parts.append(word)
        if depth < 6 and rng.random() < 0.8:
            style, inner = rng.choice([("", visible)] * 3 + [("visibility:hidden", False), ("visibility:visible", True), ("display:none", None)])
            kept = (words[0] if inner is not None else [], words[1])
            content = random_page(rng, depth + 1, bool(inner), kept)
            kind = rng.choice(["div", "span", "p", "ul", "ol", "table", "blockquote", "section"])
            wrapped = {"ul": f"<li>{content}</li>", "ol": f"<li>{content}</li>", "table": f"<tbody><tr><td>{content}</td></tr></tbody>"}.get(kind, content)
            parts.append(f"<{kind} style='{style}'>{wrapped}</{kind}>")
    return " ".join(parts)


def test_visibility_is_inherited_whatever_is_nested():
    rng = random.Random(14)
    for _ in range(400):
        words = ([], [])
        page = random_page(rng, 0, True, words).replace("<p ", "<div ").replace("</p>", "</div>")
        found = re.findall(r"w\d+", text_of(page))
        assert found == words[0], page
