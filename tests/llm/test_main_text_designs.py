"""Main text of page designs that no training layout has, and of the given pages, whose article is marked by its tag."""

from __future__ import annotations

import pytest

from parley.llm import html

P = [f"Paragraph {i} of the piece has some length, a comma and a full stop. It goes on for a while, as prose does when somebody writes it." for i in "abcdefgh"]
DESIGNS = [
    # an old page of tables
    (f"""<html><body bgcolor=white><table width=100%><tr><td colspan=2><a href=/>Home</a> | <a href=/n>News</a> | <a href=/c>Contact</a></td></tr>
<tr><td width=150 class=menu><a href=/1>One</a><br><a href=/2>Two</a><br><a href=/3>Three</a></td><td class=story><h1>An old story</h1><p>{P[0]}<p>{P[1]}<p>{P[2]}</td></tr>
<tr><td colspan=2 class=footer>Copyright 1999 by nobody</td></tr></table></body></html>""", ["An old story", *P[:3]]),
    # sections in main, with figures
    (f"""<html><body><header><a href=/>Site</a><nav><a href=/a>A</a><a href=/b>B</a></nav></header><main><section><h2>A part of it</h2><p>{P[0]}</p><figure><img src=x><figcaption>{P[5]}</figcaption></figure><p>{P[1]}</p></section>
<section><h2>Another part</h2><p>{P[2]}</p><blockquote><p>{P[3]}</p></blockquote></section></main><aside><h3>More</h3><ul><li><a href=/x>See this</a></li><li><a href=/y>See that</a></li></ul></aside><footer><p>All rights reserved.</p></footer></body></html>""",
     ["A part of it", P[0], P[5], P[1], "Another part", P[2], P[3]]),
    # a wiki-like page
    (f"""<html><body><div id=sidebar><div class=portal><h3>Tools</h3><ul><li><a href=/p>Print</a></li><li><a href=/c>Cite</a></li></ul></div></div><div id=content><h1 id=firstHeading>Some subject</h1><div id=bodyContent><p>{P[0]}</p>
<h2>History</h2><p>{P[1]}</p><ul><li>{P[2]}</li><li>{P[3]}</li></ul><p>{P[4]}</p></div></div><div id=foot><a href=/privacy>Privacy</a> <a href=/about>About</a></div></body></html>""",
     ["Some subject", P[0], "History", *P[1:5]]),
]


LINKS = """<html><body><div><a href=/>Start</a> <a href=/x>About us</a></div><h1>T</h1><div class=entry><h2>Words</h2><p>%s</p><p>%s</p></div></body></html>""" % (P[0], P[1])
PAGES = "page_id long, url string, html string, text string"


def article(source):
    """The text runs in the ``article`` element, but for what is marked as something else."""
    tree = html.parse(source or "")
    inside = [False] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        other = tree.tag[i] in ("aside", "nav", "footer", "header", "form", "ul") or {"ad", "comment", "comments", "notice", "cookie"} & set(tree.words[i])
        inside[i] = (tree.tag[i] == "article" or inside[tree.parent[i]]) and not other
    return "\n\n".join(text for node, text in tree.runs if inside[node])


@pytest.mark.parametrize("seed", [11, 1, 2])
def test_designs_that_are_not_trained_on(spark, seed):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model = html.fit(pages, html.Training(sample_pages=40, layouts=4, seed=seed))
    given = [(i, "u", page, "own") for i, (page, _) in enumerate(DESIGNS)] * 2 + [(9, "u", LINKS, None)]
    table = spark.createDataFrame(given, PAGES)
    got = html.extract(table, model).collect()
    assert len(got) == 2 * len(DESIGNS) + 1 and all(set(r.asDict()) == {"page_id", "url", "text"} for r in got)
    for r in got:
        if r.page_id < len(DESIGNS):
            assert r.text == "\n\n".join(DESIGNS[r.page_id][1])
        else:
            assert "Start" not in r.text and r.text.endswith(f"Words\n\n{P[0]}\n\n{P[1]}")
    if seed == 11:
        for r in html.extract(pages, model).join(pages.select("page_id", "html"), "page_id").collect():
            assert r.text == article(r.html)


def test_a_slash_in_an_unquoted_value_ends_no_element():
    tree = html.parse('<div><a href=/>Start</a> <a href="/x"/>no link</div>')
    assert tree.links[1] == 1 and tree.link_chars[1] == 5
