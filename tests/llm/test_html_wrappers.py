"""Extraction of pages: layouts of many kinds, and the alignment itself."""

from __future__ import annotations

import copy
import json
import random

import pytest

from hazeline.llm import html_wrappers as hw
from hazeline.llm.oracle_pages import PAGES
from hazeline.llm.queries import REGISTRY

COLUMNS = "page_id long, url string, html string"
RNG = random.Random(8)


def prose(n=30):
    return " ".join(RNG.choice(["alpha", "beta", "gamma", "delta", "rho", "sigma"]) + str(RNG.randrange(9999)) for _ in range(n)) + "."


def paragraphs(n):
    return [prose() for _ in range(n)]


def article(body):
    return "".join(f"<p>{p}</p>" for p in body)


MENU = "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>"


def with_article(body):
    title, *rest = body
    return (
        f"<!DOCTYPE html><html><head><title>x</title><script>if (a<b) document.write('<p>no</p>')</script></head><body>{MENU}"
        f"<header class=site><p>The site's name</p></header><main><article class=post><header><h1>{title}</h1></header>{article(rest)}"
        "<div class='share-buttons'><a href=#>Share</a></div><aside>Read also</aside><form><p>Mail <input></p></form></article>"
        "<section id=comments><article class=comment><p>First!</p></article></section></main>"
        "<div class='cookie notice'>We use cookies</div><footer>End</footer></body></html>"
    )


def with_main(body):
    return f"<body>{MENU}<div role=main>{article(body)}<ul class=pagination><li><a>1</a><li><a>2</a></ul></div><p>Contact</p>"


def with_divisions(body):
    """Nothing here says which part is the article, and no class helps."""
    links = "".join(f"<tr><td><a href=/{i}>Topic {i} of the site</a></td></tr>" for i in range(RNG.randrange(2, 6)))
    return (
        "<html><body><div><div>A name that all pages show</div><table>" + links + "</table></div>"
        f"<div><div>{article(body)}</div><div>Written by the same people on every page</div></div>"
        "<div>All rights reserved, as ever</div></body></html>"
    )


LAYOUTS = {"one.example": with_article, "two.example": with_main, "three.example": with_divisions}


@pytest.fixture(scope="module")
def planted():
    rows, wanted = [], {}
    for number, (host, layout) in enumerate(LAYOUTS.items()):
        for i in range(40):
            body = paragraphs(RNG.choice([2, 3, 5, 9]))
            rows.append((100 * number + i, f"https://{host}/{i}", layout(body)))
            wanted[100 * number + i] = "\n".join(body)
    return rows, wanted


def frame(spark, rows):
    clash = [(*r, "clash", "clash") for r in rows]
    return spark.createDataFrame(clash, f"{COLUMNS}, text string, host string").repartition(5)


def test_layouts(spark, planted):
    rows, wanted = planted
    got = {r["page_id"]: r for r in hw.extract(frame(spark, rows)).collect()}
    assert {i: r["text"] for i, r in got.items()} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_dealing_of_rows_changes_nothing(spark, planted):
    rows, _ = planted
    few = sorted(map(tuple, hw.wrappers(hw.expressions(frame(spark, rows).coalesce(1))).collect()))
    assert few == sorted(map(tuple, hw.wrappers(hw.expressions(frame(spark, rows))).collect()))
    assert len(few) == len(LAYOUTS)


def test_rounds_of_alignment(spark, planted, monkeypatch):
    """Many expressions of a host are aligned in rounds of bounded groups."""
    rows, wanted = planted
    rows = [(i, u, h.replace("<p>", f"<div class=k{chr(97 + i % 20)}><p>", 1).replace("</p>", "</p></div>", 1)) for i, u, h in rows if i < 40]
    monkeypatch.setattr(hw, "MERGED", 3)
    got = {r["page_id"]: r["text"] for r in hw.extract(frame(spark, rows)).collect()}
    assert got == {i: wanted[i] for i in got} and len(got) == 40


def text_of(page, others=()):
    """One page's text by the wrapper of all pages given."""
    wrapper = None
    for html in (page, *others):
        part = hw.expression(hw.tree(html))
        for slot in hw.slots(part):
            slot.sums = hw.summed(slot)
        wrapper = part if wrapper is None else hw.join(wrapper, part)
    part = hw.expression(hw.tree(page))
    own = hw.slots(part)
    found = [(n, t) for i in hw.chosen(wrapper, hw.marks(wrapper), part) for n, t, _ in own[i].texts]
    return "\n".join(t for _, t in sorted(found))


@pytest.mark.parametrize(
    "page, wanted",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<article>a &amp;lt; b &eacute;&#233;&#xe9; &nbsp; c</article>", "a &lt; b ééé c"),
        ("<article><p>one<p>two<ul><li>three<li>four</ul>five<br>six</article>", "one\ntwo\nthree\nfour\nfive six"),
        ("<article><p>a <b>b <i>c</b> d</i> <a href='x>y'>e</a>f</p>", "a b c d ef"),
        ("<article><h1>t</h2><p>u</article><p>outside", "t\nu"),
        ("<article><!-- <p>no</p> --><p>yes</p><![CDATA[x]]><?php y ?></article>", "yes"),
        ("<article><p>1 < 2 and 3 <4</p></article>", "1 < 2 and 3 <4"),
        ("<nav><ul><li>menu<article><p>unclosed menu</p></article>", "unclosed menu"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</article>", "yes"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><pre>d\n  e</pre></article>", "a\nb\nc\nd e"),
        ("<ARTICLE><P CLASS=Lead>Big</P></ARTICLE>", "Big"),
        ("<article><p>cut off <a href='", "cut off"),
        ("<article></article><main><p>other way</p></main>", "other way"),
        ("<article><section><h2>a</h2><p>b</p></section><section><h2>c</h2><p>d</p></section></article>", "a\nb\nc\nd"),
        ("<div itemprop=articleBody><p>body</p></div><p>rest</p>", "body"),
        ("<script>var a = '</article>'</script><article>x<style>p{}</style>y</article>", "xy"),
    ],
)
def test_single_pages(page, wanted):
    assert text_of(page or "") == wanted


def test_long_and_deep_pages():
    body = [f"paragraph number {i}" for i in range(20_000)]
    assert text_of("<article>" + article(body) + "</article>") == "\n".join(body)
    assert text_of("<div>" * 5000 + "<article><p>deep</p></article>") == "deep"
    assert text_of("<article>" + "<div>" * 5000 + "<p>deeper</p>") == "deeper"
    mixed = [f"<h{i % 6 + 1} class=c{chr(97 + i % 26)}>t{i}</h{i % 6 + 1}>" for i in range(3000)]
    assert text_of("<article>" + "".join(mixed) + "</article>") == "\n".join(f"t{i}" for i in range(3000))


def shape(page):
    return hw.shown(hw.expression(hw.tree(page)))[2]


def test_neighbours_are_folded():
    assert shape("<p>a<p>b<p>c") == [["p", 1, [["#", 0, []]]]]
    group = shape("<h2>a</h2><p>b<h2>c</h2><p>d<p>e")
    assert [(p[0], p[1], [q[0] for q in p[2]]) for p in group] == [("()", 1, ["h2", "p"])]
    assert group[0][2][1][1] == 1  # the paragraph repeats within the group


def test_mismatches_become_optional():
    a, b = (hw.expression(hw.tree(p)) for p in ("<h1>a</h1><p>b<footer>c", "<h1>d</h1><ul><li>x</ul><p>e<p>f"))
    whole = hw.join(copy.deepcopy(a), copy.deepcopy(b))
    assert [(p.label, p.many, p.maybe) for p in whole.parts] == [
        ("h1", False, False),
        ("ul", False, True),
        ("p", True, False),
        ("footer", False, True),
    ]
    again = hw.join(copy.deepcopy(whole), copy.deepcopy(b))
    assert json.dumps(hw.shown(again)) == json.dumps(hw.shown(whole))


def test_wrappers_stay_small():
    """Pages in which anything follows anything make a wrapper of the kinds of tags."""
    rng, whole = random.Random(2), None
    kinds = ["p", "ul", "h2", "h3", "pre", "blockquote", "table", "figure"]
    for _ in range(300):
        page = "".join(f"<{k}>x</{k}>" for k in (rng.choice(kinds) for _ in range(60)))
        part = hw.expression(hw.tree(f"<article>{page}</article>"))
        whole = part if whole is None else hw.join(whole, part)
    assert whole.parts[0].free and len(whole.parts[0].parts) == len(kinds)


def test_odd_rows(spark):
    """Null ids, addresses and pages, repeated rows, hosts of one page; each row has its result."""
    page = with_article(["t", "p"])
    rows = [(None, None, None), (1, None, page), (1, None, page), (2, "not a url", page), (3, "HTTP://A.B", ""), (4, "http://c", "x")]
    got = sorted(map(tuple, hw.extract(frame(spark, rows)).collect()), key=str)
    wanted = [(None, None, "", 0), (1, None, "t\np", 3), (1, None, "t\np", 3), (2, "not a url", "t\np", 3), (3, "HTTP://A.B", "", 0), (4, "http://c", "x", 1)]
    assert got == sorted(wanted, key=str)


def test_no_rows(spark):
    assert hw.extract(spark.createDataFrame([], COLUMNS)).collect() == []


def test_query_has_sql():
    assert "op13_html_extraction" in REGISTRY and "article" in PAGES
