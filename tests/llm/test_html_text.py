"""Main text of odd pages, and site trees of made-up hosts."""

import math
import random
from collections import Counter

import pytest

from tillroll.llm import html_text
from tillroll.llm.html_text import Page

FIELDS = "page_id long, url string, html string, text string, page int"

CASES = [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a<p>b", "a\n\nb"),
    ("<article><h1>T</h1><p><b>one<br><p>two &amp; &eacute;&#x41; &lt;b></article>after",
     "T\n\none\n\ntwo & éA <b>"),
    ("<head><title>no</title></head><body><p>yes<script>var t='<p>no</p>'</script>", "yes"),
    ("<style>p{}</style><nav><ul><li>menu</ul></nav><div class='ad'>buy</div><div>text</div>"
     "<footer>foot</footer>", "text"),
    ("<main><header><h1>Head</h1></header><p>x</p><aside>side</aside>"
     "<form><p>f</p></form></main><header>top</header>", "Head\n\nx"),
    ("<article>a<section class='post-comments'><article class=comment>c</article></section>b"
     "</article>", "a\n\nb"),
    ("<div role=navigation>m</div><div id='cookieNotice'>n</div><div hidden>h</div><p>z</p>", "z"),
    ("<article><p>cut off in a <b cla", "cut off in a"),
    ("<article><p>amp &am", "amp &am"),
    ("<p title='a>b'>q</p><p title='open>r</p>", "q\n\nr"),
    ("<p>1 < 2 <3 &lt;4</p><!-- <p>no</p> --><p>5<!-- cut", "1 < 2 <3 <4\n\n5"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
    ("<a href=x>link</a> <span>in</span>line", "link inline"),
    ("<P>Upper</P><BR><NAV>n</NAV>t", "Upper\n\nt"),
    ("<script>never closed <p>x", ""),
    ("<article><p>Dose.</p><section id='side-effects'>May cause sleep.</section></article>",
     "Dose.\n\nMay cause sleep."),
    ("<article><p>One <span class='search-term'>needle</span> two</p></article>", "One needle two"),
    ("<article><div class='related-work'>Others.</div><div class=form-factor>Small.</div></article>",
     "Others.\n\nSmall."),
    ("<article>teaser</article><div id=body>long story, and longer</div>",
     "teaser\n\nlong story, and longer"),
    ("<div class='content has-sidebar'>text</div><div class='side-bar left'>bar</div>"
     "<div class=comments-section>c</div><div id=ad-unit-300x250>a</div><ul class=related-posts>"
     "<li>p</ul><div class='form-group'>f</div><div class=nav__item--on>n</div>", "text"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_page(html, text):
    assert Page(html, "http://h/").text() == text


def test_deep_page():
    assert Page("<div>" * 20_000 + "x" + "</div>" * 20_000, None).text() == "x"


@pytest.mark.parametrize("url,host", [
    ("http://A.b.example.com:80/x", "a.b.example.com"), ("//c/d", "c"), (None, ""), ("x/y", ""),
    ("https://u@h.org?q", "h.org")])
def test_host(url, host):
    assert html_text.host_of(url) == host


def site(n, host, note="Read our other pages and tell your friends."):
    for i in range(n):
        body = "".join(f"<p>Story {host} {i} part {k}.</p>" for k in range(i % 4 + 1))
        yield (f"http://{host}/{i}",
               f"<body><div class=top><p>{note}</p></div><div class=story>{body}</div></body>",
               "\n\n".join(f"Story {host} {i} part {k}." for k in range(i % 4 + 1)))


def test_boilerplate_of_a_site_goes(spark):
    rows = [(i, u, h, "x", 1) for i, (u, h, _) in enumerate(site(40, "one.org"))]
    # On this host the same words stand on too few pages to tell.
    few = [(100 + i, u, h, "x", 1) for i, (u, h, _) in enumerate(site(3, "two.org"))]
    odd = [(None, None, None, "x", 1), (200, None, "<p>t</p>", "x", 1), (0, *rows[0][1:])]
    frame = spark.createDataFrame(rows + few + odd, FIELDS)
    got = {}
    for r in html_text.main_text(frame).collect():
        got.setdefault(r.page_id, []).append((r.text, r.n_chars))
    for i, (_, _, text) in enumerate(site(40, "one.org")):
        assert set(got[i]) == {(text, len(text))}, i
    assert len(got[0]) == 2
    for i, (_, _, text) in enumerate(site(3, "two.org")):
        assert got[100 + i][0][0] == "Read our other pages and tell your friends.\n\n" + text
    assert got[None] == [("", 0)] and got[200] == [("t", 1)]


def test_copied_articles_stay(spark):
    page = "<article><div><p>Same words on each page.</p></div></article>"
    rows = [(i, f"http://m.org/{i}", page, "x", 1) for i in range(30)]
    frame = spark.createDataFrame(rows, FIELDS)
    assert {r.text for r in html_text.main_text(frame).collect()} == {"Same words on each page."}
    assert html_text.main_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize("token,word", [
    ("post-comments", "comments"), ("cookieNotice", "notice"), ("side-bar", "sidebar"),
    ("ad_container_2", "ad"), ("comment__body--open", "comment"), ("related-articles", "related")])
def test_told(token, word):
    assert word in html_text.told(token)


@pytest.mark.parametrize("token", ["side-effects", "search-term", "related-work", "form-factor",
                                   "has-sidebar", "no-comments", "adventure", "menu-prices"])
def test_not_told(token):
    assert not html_text.told(token) & html_text.NO_CLASS


def plain_noise(nodes):
    """Nodes to remove, with entropies from probabilities, one node at a time."""
    seen = {}
    for _, node, main, layout, content in nodes:
        seen.setdefault((node, main), []).append((layout, content))

    def importance(rows):
        n = len(rows)
        if n < 2:
            return 1.0
        made = []
        for k in (0, 1):
            shares = [c / n for c in Counter(r[k] for r in rows).values()]
            made.append(-sum(p * math.log(p) for p in shares) / math.log(n))
        return 0.3 * made[0] + 0.7 * made[1]

    whole = {main: importance(rows) for (node, main), rows in seen.items() if node == main}
    return {node for (node, main), rows in seen.items()
            if node != main and len(rows) >= 5 and main in whole
            and importance(rows) < 0.3 * whole[main]}


def test_noise_equals_plain_entropies(spark):
    rng = random.Random(1)
    pages = []
    for i in range(60):
        body = "".join(f"<p>{rng.random()}</p>" for _ in range(1 + i % 3))
        note = rng.choice(["<p>Tell your friends.</p>", "<p>Tell <b>all</b> friends.</p>"])
        pages.append((i, f"http://h{i % 2}.org/{i}",
                      f"<div class=a>{note}</div><div class=b>{body}<div class=c><p>{i % 7}</p></div>"
                      f"</div><article><div class=d><p>All rights.</p></div>{body}</article>"))
    frame = spark.createDataFrame(pages, "page long, url string, html string")
    nodes = html_text._nodes(frame)
    rows = [tuple(r) for r in nodes.collect()]
    got = {r.node for r in html_text.unimportant(nodes).collect()}
    assert got == plain_noise(rows) and len(got) >= 4


def test_names_that_tell_nothing(spark):
    """Boilerplate and stories in elements of random names: only the tree can part them."""
    rows, want = [], {}
    for i in range(50):
        story = [f"Report {i} line {k} of the day." for k in range(2 + i % 3)]
        html = ("<div class=q7><div class=z1><p>Welcome to our pages.</p><p>Have a nice day.</p></div>"
                "<div class=k3>" + "".join(f"<p>{t}</p>" for t in story) + "</div>"
                "<section class=w9><p>Made with care in our town since 1950.</p></section></div>")
        rows.append((i, f"https://plain.example/{i}", html, "x", 1))
        want[i] = "\n\n".join(story)
    got = html_text.main_text(spark.createDataFrame(rows, FIELDS)).collect()
    assert {r.page_id: r.text for r in got} == want


def test_very_long_page():
    part = "<div class=x><p>word &amp; word</p></div>"
    text = Page("<article>" + part * 60_000 + "</article>", "http://h/").text()
    assert text == "\n\n".join(["word & word"] * 60_000)
