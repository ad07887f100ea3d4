"""Main-text extraction: pages with known articles, mended markup, odd input and time on hostile pages."""

import html
import random
import re
import time

import pytest

from memberlens.llm import html_text
from memberlens.llm.common import ship
from memberlens.llm.html_text import main_text
from tests.conftest import SF_ORACLE
from tests.llm.helpers import prose


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


MENU = "<ul>" + "".join(f'<li><a href="/{k}">{w}</a></li>' for k, w in enumerate(prose(1, 8).split())) + "</ul>"
P = [prose(100 + k, n) + "." for k, n in enumerate((60, 45, 80, 30, 55, 70))]
FOOT = "© 2024 Example Ltd. All rights reserved."


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def joined(*blocks):
    return "\n\n".join(blocks)


def test_given_pages(spark):
    """Against a plain cut of the article element: references decoded, paragraphs apart, white space single."""
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet")
    got = html_text.extract_pages(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {r["page_id"]: r for r in got.collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        body = re.search("<article>(.*)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " " if "br" in b else "", b)).split())
                  for b in re.split("</?(?:p|h1)>", body)]
        assert found[r["page_id"]]["text"] == joined(*[b for b in blocks if b])
        assert found[r["page_id"]]["n_chars"] == len(found[r["page_id"]]["text"]) and found[r["page_id"]]["url"] == r["url"]


@pytest.mark.parametrize("page", [
    # Everything around the article is told by its element.
    "<html><head><title>T</title><style>p{}</style></head><body><header><a href='/'>Home</a> Site of the year</header><nav>{menu}"
    "</nav><main><article><h1>Head line</h1>{p}</article></main><aside><h3>About</h3><p>{x}</p></aside><footer><p>{foot}</p>"
    "</footer></body></html>",
    # By class and id.
    "<body><div id='masthead'><p>{x}</p></div><div class='top-nav'>{menu}</div><div class='cookie-notice'><p>{x}</p><button>OK"
    "</button></div><div class='post'><h1>Head line</h1>{p}</div><div class='sideBar'><p>{x}</p></div><div class='ad-slot'>{x}"
    "</div><section id='comments'><h2>2 comments</h2><article class='comment'><p>{x} {x} {x}</p></article></section>"
    "<div class='site-footer'>{foot}</div></body>",
    # By nothing but density.
    "<body><div class='a'>{menu}</div><div class='b'><div class='c'><h1>Head line</h1>{p}</div></div>"
    "<div class='d'>{menu}{menu}</div><div class='e'><p>{foot}</p></div></body>",
    "<table><tr><td>{menu}</td><td><h1>Head line</h1>{p}</td></tr><tr><td>{foot}</td></tr></table>",
    # Parts of the article, with an advert between them.
    "<body><div>{menu}</div><div class='w'><h1>Head line</h1><div>{p1}</div><div class='advert'>{x}</div><div>{p2}</div></div>"
    "<div>{foot}</div></body>",
    # Marked for what stands next to it; a form around the page; hidden and scripted text; a heading of its own.
    "<body class='has-sidebar'><form id='aspnet' action='/'><main class='with-sidebar no-comments'><header><h1>Head line</h1>"
    "<p>By someone</p></header>{p}<div hidden>{x}</div><div style='display: none'>{x}</div><script>if (a < b) '</p>'</script>"
    "<form><label>Name</label><input></form></main><div role='complementary'>{x}</div></form></body>",
    # Unclosed, misnested and upper-case elements, comments with markup, quoted angle brackets.
    "<!doctype html><!-- <p>no</p> --><BODY><NAV>{menu}</NAV><ARTICLE TITLE='a > b'><H1>Head line</h2>{open}</ARTICLE><FOOTER>"
    "{foot}",
])
def test_article_of(page):
    p, x = paragraphs(P), prose(7, 14)
    made = page
    for key, value in (("menu", MENU), ("p1", paragraphs(P[:3])), ("p2", paragraphs(P[3:])), ("p", p), ("x", x), ("foot", FOOT),
                       ("open", "".join(f"<p><b>{t}<br>" for t in P))):
        made = made.replace("{" + key + "}", value)
    assert main_text(made) == joined("Head line", *P)


def test_blocks():
    """White space, references, inline elements, lists, tables, quotations, preformatted text and lone ends."""
    body = ("<article><h2>A&nbsp;&amp;&#x20AC;&lt;b&gt; &zzz; &copy</h2>one<i>two</i>\n\t three<br>four<p>five</p>six"
            f"</p><ul><li>seven<li>eight <a href='/x'>nine</a></ul><table><tr><td>ten<td>eleven<tr><th>twelve</table>"
            f"<blockquote>{P[0]}</blockquote><pre>a\n   b</pre><div> \n </div><custom-x>thirteen</custom-x><img alt='no'>"
            f"<h3></h3><p>{P[1]}</p></article>")
    assert main_text(body) == joined(
        "A &€<b> &zzz; ©", "onetwo three four", "five", "six", "seven", "eight nine", "ten eleven", "twelve", P[0], "a b",
        "thirteen", P[1])


def test_links():
    """Links in the text stay with it; lists of links in the article, and related ones after it, go."""
    text = f"<p>{P[0]} <a href='/a'>{P[1]}</a> {P[2]}</p>"
    body = f"<article>{text}<ul>{MENU}</ul><p>{P[3]}</p><div class='related-posts'><p>{P[4]}</p></div></article>"
    assert main_text(body) == joined(" ".join(P[:3]), P[3])
    loose = f"<div><a href='/x'>unclosed<div>{paragraphs(P)}</div></a></div>"
    assert P[5] in main_text(loose)


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text(" \n ") == main_text("<p></p><script>x") == ""
    assert main_text("just words &amp; more") == "just words & more"
    assert main_text("<p>cut off in a tag <a href='") == "cut off in a tag"
    assert main_text("a < b and c > d, <3") == "a < b and c > d, <3"
    assert main_text("<div>line one<br>line two</div>") == "line one line two"
    assert main_text("<nav>only a menu</nav>") == ""
    assert main_text("<body><p>one</p></body></html><p>two after the end</p>") == joined("one", "two after the end")


@pytest.mark.parametrize("page", [
    "<div>" * 60000 + "x", "<p><button>" + "<div>a" * 60000, '<a href="x' * 50000, "<" * 200000, "<!--" * 50000,
    "<a " + "=" * 200000, "<a>x" * 60000, "<b>x<p>" * 40000, "<script>" * 40000, "<table>" + "<tr><td>a b" * 40000,
    "<ul><li>word" * 20000, "&amp" * 100000, "</p>" * 100000])
def test_time_follows_length(page):
    start = time.monotonic()
    main_text(page)
    assert time.monotonic() - start < 10


def test_rows(spark):
    """Nulls, repeated rows, clashing columns and no rows; a long page is read to its end."""
    rng = random.Random(3)
    long_ = "<article>" + paragraphs([prose(rng.randint(0, 99), 50) for _ in range(3000)]) + "</article>"
    rows = [(1, "u", f"<p>{P[0]}</p>"), (1, "u", f"<p>{P[0]}</p>"), (None, None, None), (3, "v", ""), (4, None, long_)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'clash' as text", "'clash' as n_chars", "'clash' as id")
    got = html_text.extract_pages(df).collect()
    assert len(got) == 5 and sum(r["text"] == P[0] for r in got) == 2
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in got if r["page_id"] in (None, 3)] == [(None, "", 0), (3, "", 0)]
    assert [r["text"].count("\n\n") for r in got if r["page_id"] == 4] == [2999]
    assert html_text.extract_pages(df.limit(0)).collect() == []
