from __future__ import annotations

import html as entities
import re

import pytest
from conftest import SF_SMALL

from stratum.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"<p>"}</style></head><body class="home has-sidebar">
<header class="site"><h1>Site, name</h1><p>Welcome, all, of, you, to, this, page, of, many, commas.</p></header>
<div id="cookie-notice"><p>We use cookies, and more, and more, and even more.</p></div><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="wrap"><div class="sidebar"><p>Side, text, with, many, commas, in, it, yes, it, is, long, long, long.</p></div>
%s
</div><footer><p>&copy; all rights, reserved, here, and, there.</p></footer><script>if(a<b){document.write("<p>x</p>")}</script></body></html>"""
BODY = """<h2>A t&amp;itle</h2><p>Short.</p><p>A longer   paragraph, with some commas, and&nbsp;text
here.<p>Second <a href=x>link</a> text<br>more<!-- <p>no</p> --><ul><li>one<li>two</ul><div class="ad">Buy, now, or, never.</div>
<form><label>Mail</label><input></form><table><tr><td>cell &lt;1&gt;<td>cell 2</table><aside>By the way</aside><noscript>n</noscript>"""
TEXT = "A t&itle\nShort.\nA longer paragraph, with some commas, and text here.\nSecond link text more\none\ntwo\ncell <1>\ncell 2"
COMMENTS = """<section id="comments"><article class="comment"><p>First, great, article, really, long, comment, here, that, goes, on,
and, on, and, on, and, on, and, on.</p></article></section>"""


@pytest.mark.parametrize("holder", ["<article>%s</article>", '<div class="post-content">%s</div>', "<main><div>%s</div></main>", '<div id="x">%s</div>',
                                    "<article><header><h2 hidden></h2></header>%s</article>", "<table><tr><td>%s</td></tr></table>"])
def test_article(holder):
    assert html_text.main_text(PAGE % (holder % BODY + COMMENTS)) == TEXT


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<html><body></body></html>", ""), ("plain &lt;text&gt;\n here", "plain <text> here"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<p>a<b>b</b>c<p>d</div></span>e", "abc\nde"), ("<p>x &#233;&#x1F44D; &bogus;</p>", "x é👍 &bogus;"),
    ("<article><p>Sh.</p></article><div class=ad><p>Long, long, long, advert, with, commas, and, more, and, more.</p></div>", "Sh."),
    ("<script>never closed <p>x", ""), ("<p " + "a" * 5000, "")])
def test_small_pages(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(("names", "kept"), [
    ("main-nav", False), ("page-header", False), ("content-sidebar", False), ("related-posts", False), ("post-ad", False), ("content-footer", False),
    ("entry-header", True), ("has-sidebar", True), ("article-body", True), ("chapter", True), ("site-banner", False), ("shadow advanced", True),
    ("userComments", False), ("post comment", False), ("widget", False), ("notice", False)])
def test_parts_by_name(names, kept):
    page = f'<body><div class="x"><p>One, two, three, four, five, six.</p><div class="{names}"><p>Inner, text.</p></div><p>Last, one.</p></div></body>'
    assert html_text.main_text(page) == "One, two, three, four, five, six.\n" + "Inner, text.\n" * kept + "Last, one."


LONG = "".join(f"<p>Paragraph {i}, with some text, and commas, that goes on for a while.</p>" for i in range(10))
LONG_TEXT = "\n".join(re.findall("<p>(.*?)</p>", LONG))


@pytest.mark.parametrize(("page", "text"), [
    ('<div class=post><h1>Title</h1><p>Lead, short.</p><div class=entry-content>%s</div></div>', "Title\nLead, short.\n%s"),
    ('<div class=post><h1><a href=x>Title</a></h1>Bare lead<div><div class=entry-content>%s</div></div></div>', "Title\nBare lead\n%s"),
    ('<div><div><h2><a href=x>Title</a></h2></div><p><a href=x>By A</a></p><div>%s</div></div>', "Title\n%s"),
    ('<div><section>%s</section><section><h2>More</h2><p>Short.</p></section><div>End</div></div>', "%s\nMore\nShort.\nEnd"),
    ('<div><h1>T</h1><table><tr><td>%s</td></tr></table><p>End.</p></div>', "T\n%s\nEnd."),
    ('<div><div>%s</div><h2>Notes</h2><p>A note.</p><h3>Elsewhere</h3><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div>', "%s\nNotes\nA note."),
    ('<div><div>%s</div><h2>Notes</h2><p>A note.</p><p><a href=x>More</a></p></div>', "%s\nNotes\nA note.")])
def test_siblings_of_the_best_container(page, text):
    assert html_text.main_text(PAGE % (page % LONG + COMMENTS)) == text % LONG_TEXT


@pytest.mark.parametrize("holder", [
    '<article class="post has-comments">%s</article>', '<article class="post tag-social category-notices">%s</article>',
    '<article class="hentry category-advertising">%s</article>', '<article class="social">%s</article>', '<article class="post discussion">%s</article>',
    '<div class="hentry category-advertising">%s</div>', '<div class="tag-comments">%s</div>', '<div class="post no-comments">%s</div>',
    '<div class="social"><article>%s</article></div>', '<div class="menu-open promo"><div class="post">%s</div></div>',
    '<div class="post discussion">%s</div>', '<div class="modal">%s</div>', '<article class="discussion">%s</article>'])
def test_names_do_not_drop_the_article(holder):
    page = '<body><nav><a href=x>Home</a></nav>%s<div id="cookie-notice"><p>We use cookies.</p></div></body>'
    assert html_text.main_text(page % (holder % (LONG + '<div class="share"><p>Share it.</p></div>'))) == LONG_TEXT
    short = holder % LONG + '<div class="comments"><article class="comment"><p>Hi, all.</p></article></div>'
    assert html_text.main_text(page % short) == LONG_TEXT


@pytest.mark.parametrize("part", [
    '<div id="post-comments"><article class="comment post">%s</article></div>', '<div class="comments no-avatars"><p>A, b.</p>%s</div>',
    '<ol class="commentlist"><li><div class="comment-content">%s</div></ol>', '<div class="category-menu">%s</div>', '<div class="sidebar has-shadow">%s</div>'])
def test_names_still_drop_long_parts(part):
    page = "<body><article class='post has-comments'><h1>T</h1><p>Short, one.</p></article>%s</body>"
    assert html_text.main_text(page % (part % LONG)) == "T\nShort, one."
    page = "<body><div class='post'><h1>T</h1>%s%s</div></body>"
    assert html_text.main_text(page % (LONG, part % "<p>One, two, three.</p>")) == "T\n" + LONG_TEXT


def test_long_comments_of_a_short_post():
    page = f"<body><div class=post><p>Short, one.</p></div><div id=comments>{LONG}</div></body>"
    assert html_text.main_text(page) == "Short, one."


def test_long_page_is_whole():
    paragraphs = [f"Paragraph {i}, with text, and commas." for i in range(20_000)]
    page = PAGE % ("<article>" + "".join(f"<p>{p}" for p in paragraphs) + "</article>")
    assert html_text.main_text(page) == "\n".join(paragraphs)
    assert html_text.main_text("<div>" * 3000 + "deep, text" + "</div>" * 3000) == "deep, text"


def test_table(shipped):
    pages = shipped.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html")
    extra = shipped.createDataFrame([(None, None, None), (7_000_000, "u", ""), (7_000_000, "u", PAGE % BODY)], "page_id long, url string, html string")
    out = html_text.extract(pages.union(extra))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = out.collect()
    truth = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == len(truth) + 3
    for r in rows:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] in truth:
            article = re.search(r"<article>(.*)</article>", truth[r["page_id"]], re.S)[1]
            blocks = re.split(r"</?(?:p|h1|ul|li)\b[^>]*>", article)
            blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
            assert r["text"] == "\n".join(b for b in blocks if b)


def test_clashing_columns_and_empty(shipped):
    df = shipped.createDataFrame([("x", "old", 5, "<p>a, b</p>")], "k string, text string, n_chars int, html string")
    assert [tuple(r) for r in html_text.extract(df).collect()] == [("x", "a, b", 4)]
    assert html_text.extract(df.filter("false")).collect() == []
    assert html_text.extract(df.select("html")).collect()[0]["text"] == "a, b"


def test_forms_are_judged_by_their_share_of_the_text():
    article = "<div><h1>Title</h1><p>Main article, long and good.</p><p>More of it here.</p></div>"
    assert html_text.main_text(f"<body><form id=aspnetForm action=x>{article}</form></body>") == "Title\nMain article, long and good.\nMore of it here."
    page = f"<body><form id=aspnetForm><div class=nav>Home | News</div>{article}<label>Your name</label><input value=x><button>Send</button></form></body>"
    assert html_text.main_text(page) == "Title\nMain article, long and good.\nMore of it here."
    assert html_text.main_text(f"<body>{article}<form><p>Subscribe, now, to our letter, please do</p><input></form></body>") == \
        "Title\nMain article, long and good.\nMore of it here."
    assert html_text.main_text("<body><article><p>Text, of it.</p><form><p>Reply here, please do</p></form></article></body>") == "Text, of it."


@pytest.mark.parametrize("tail", ["<!-- ad text", "<!--", "<!DOCTYPE x", "<!x", "<?php echo 1", "<div class=", "</di", "<!-- a > b -- c"])
def test_unfinished_markup_at_the_end_is_no_text(tail):
    assert html_text.main_text("<p>Hello</p>" + tail) == "Hello"
    assert html_text.main_text("<p>Hello" + tail) == "Hello"


@pytest.mark.parametrize("unit", ["<div>x", "<ul><li>x", "<!--", "<b>x", "<section class=sidebar>x", "<article>x", "<form>x", "<a>x", "<table><tr><td>x",
                                  "<span><div>x", "<div ", "&#x", "</x><div>", "<article><header><h1>x"])
def test_time_is_linear_in_depth(unit):
    import time

    start = time.process_time()
    html_text.main_text(unit * 60_000)
    assert time.process_time() - start < 10  # a quadratic walk takes minutes


# -- an independent scorer -------------------------------------------------------
# A tree is (tag, children); a child is a tree or a text. Tags: div, p, h2, a.

def _render(node):
    if isinstance(node, str):
        return node
    tag, children = node
    return f"<{tag}>{''.join(map(_render, children))}</{tag}>"


def _texts(node, path=(), link=False):
    """(text, linked characters, path of block elements) of every block, in page order."""
    tag, children = node
    path = (*path, id(node))
    run, out = [], []

    def flush():
        text = "".join(t for t, _ in run).strip()
        if text:
            out.append((text, sum(len(t) for t, on in run if on), path))
        run.clear()

    for c in children:
        if isinstance(c, str):
            run.append((c, False))
        elif c[0] == "a":
            run.append((c[1][0], True))
        else:
            flush()
            out.extend(_texts(c, path))
    flush()
    return out


def _naive(body):
    """The best container by points and link density, with its siblings, from the definition."""
    byid, up = {}, {}

    def walk(node, parent):
        byid[id(node)] = node
        up[id(node)] = parent
        for c in node[1]:
            if not isinstance(c, str) and c[0] != "a":
                walk(c, id(node))

    html = ("html", [body])
    walk(html, None)
    blocks = _texts(html)
    points = {}
    for text, _, path in blocks:
        chain = list(reversed(path))
        if byid[chain[0]][0] in ("p", "h2"):
            chain = chain[1:]
        for share, e in zip((1, 1 / 2, 1 / 6, 1 / 9, 1 / 12), chain):
            points.setdefault(e, []).append((1 + text.count(",") + min(len(text) / 100, 10)) * share)
    if not points:
        return ""

    def inside(e):
        return [b for b in blocks if e in b[2]]

    def score(e):
        own = inside(e)
        return sum(points[e]) * (1 - min(1.0, sum(b[1] for b in own) / max(1, sum(len(b[0]) for b in own))))

    scores = {e: score(e) for e in points}
    top = max(scores.values())
    first = [e for e in points if scores[e] == top]
    best = first[0]
    while up[best] is not None and byid[up[best]][0] not in ("body", "html") and sum(len(b[0]) for b in inside(up[best])) == sum(len(b[0]) for b in inside(best)):
        best = up[best]
    if up[best] is None:
        return "\n".join(b[0] for b in blocks)
    parent = byid[up[best]]
    sides, run = [], []
    for c in parent[1]:
        if isinstance(c, str) or c[0] == "a":
            run.append(c)
            continue
        if run:
            sides.append((None, _texts(("div", run))))
            run = []
        sides.append((c, [b for b in blocks if id(c) in b[2]]))
    if run:
        sides.append((None, _texts(("div", run))))
    sides = [(c, own) for c, own in sides if own]
    at = [i for i, (c, _) in enumerate(sides) if c is not None and id(c) == best][0]
    keep = []
    for i, (c, own) in enumerate(sides):
        heading = c is not None and len(own) == 1 and byid[own[0][2][-1]][0] == "h2"
        plain = 2 * sum(b[1] for b in own) < sum(len(b[0]) for b in own)
        keep.append((c is not None and id(c) == best) or plain or (heading and i < at))
        if heading and i > at:  # goes with what it heads
            follow = []
            for c2, own2 in sides[i + 1:]:
                if c2 is not None and len(own2) == 1 and byid[own2[0][2][-1]][0] == "h2":
                    break
                follow.append(2 * sum(b[1] for b in own2) < sum(len(b[0]) for b in own2))
            keep[-1] = plain and (not follow or any(follow))
    return "\n".join(b[0] for k, (_, own) in zip(keep, sides) if k for b in own)


def test_small_trees_equal_an_independent_scorer():
    import random

    rng = random.Random(11)
    vocabulary = ["plain", "text", "with,", "commas,", "and", "some", "more"]

    def text():
        return " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 40])))

    def tree(depth):
        children = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.35 and depth:
                children.append(tree(depth - 1))
            elif kind < 0.7:
                children.append(("p", [text()]))
            elif kind < 0.8:
                children.append(("h2", [text()]))
            elif kind < 0.9:
                children.append(("p", [("a", [text()])]))
            else:
                children.append(("div", [text()]))
        return ("div", children)

    for _ in range(400):
        body = ("body", [tree(3) for _ in range(rng.randrange(1, 4))])
        assert html_text.main_text(f"<html>{_render(body)}</html>") == _naive(body), _render(body)
