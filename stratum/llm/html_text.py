"""Main text of web pages by tree scoring.

Paragraphs (runs of text between block-level tags) earn points for their length
and commas and pass them to the element that holds them, half to the next and
shrinking shares further up. An element's points are discounted by the share of
its text that is links. The best element is raised to the ``article`` or ``main``
around it; without one, its siblings - containers, headings, paragraphs and bare
text of any length - are kept with it unless half of their text is links. All
blocks of what is kept come out in page order. Elements that are never article text - menus, headers, footers,
sidebars, notices, adverts, forms, scripts, comments, told by tag, role, class
or id - are left out before scoring. Class, id and the tag ``form`` leave out
neither an ``article`` nor, as a rule, what holds most of the page's text
(``_without_parts``): some sites put the whole page into a form. Its labels,
fields and buttons are left out in any case.

One pass over the pages, each on its own, without a shuffle. The time for a page
grows with its length, however deep its tags are nested: sums go up the tree
once, and where an element stands is told by numbers in page order.

Defined results: null or empty html, or a page without text, gives the empty
text; html without tags is one block; unclosed and stray tags are tolerated, and
an unfinished tag or comment runs to the end of the page; a page of any length
is read whole, in the memory of one task; repeated rows are repeated; ids and
urls are passed through, nulls included; columns named text or n_chars are
replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("nav header footer aside label legend script style noscript template iframe object svg canvas audio video button select "
                    "textarea head title menu dialog datalist".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl body article section div td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("td th tr thead tbody tfoot".split())
PARAGRAPHS = frozenset("p pre blockquote li dd dt h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that tell an element's part in the page.
GOOD = frozenset("article content main body entry post story text page".split())
COMMENTS = frozenset("comment comments commentlist disqus replies respond discussion".split())
BAD = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion cookie cookies "
                "consent gdpr notice notices alert popup modal overlay sidebar aside menu nav navigation navbar breadcrumb breadcrumbs "
                "masthead footer colophon share sharing social related recommended newsletter subscribe subscription signup login "
                "pagination pager skip copyright".split())
# These tell nothing beside an article word ("entry-header").
WEAK = frozenset("header banner widget widgets search toolbar".split())
ARTICLE = frozenset("article content entry post story text".split())
ARTICLE_PART = ARTICLE | {"hentry"}
# What follows a layout switch ("has-sidebar") is no part of the page.
SWITCHES = frozenset("has no with without".split())
# Topics ("tag-social") tell what an article is about; "category-menu" alone is a menu.
TOPICS = frozenset("tag category cat topic taxonomy tax keyword".split())
MENUS = frozenset("menu nav navigation navbar breadcrumb breadcrumbs pagination pager sidebar widget widgets header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())

_WORD = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
_UNFINISHED = re.compile(r"</?[a-zA-Z]|<[!?]")
_SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)


class Element:
    __slots__ = ("tag", "up", "points", "chars", "links", "good", "depth", "lead", "named", "marked", "free", "led", "no", "last",
                 "block", "whole", "in_article", "in_header", "side")

    def __init__(self, tag: str, up: Element | None, good: bool, named: str = "", no: int = 0):
        self.tag, self.up, self.good, self.named = tag, up, good, named
        self.points, self.chars, self.links = 0.0, 0, 0
        self.depth = up.depth + 1 if up else 0
        self.no = self.last = no  # in page order; of the last element inside
        self.lead = self if good else up and up.lead  # the nearest likely article element
        self.marked = self if named else up and up.marked  # the nearest element told by name not to be article text
        self.whole = self if tag in ("article", "main") else up and up.whole
        self.block = self if tag not in INLINE or up is None else up.block  # the nearest one that is not inline
        self.in_article = tag == "article" or bool(up and up.in_article)
        self.in_header = tag == "header" or bool(up and up.in_header)
        # Of marked ones: characters that are no links, and the deepest likely article element around text in there.
        self.free, self.led = 0, self.depth if good else -1
        self.side: Element | None = None

    def holds(self, other: Element) -> bool:
        return self.no <= other.no <= self.last

    def above(self) -> Iterator[Element]:
        at = self
        while at is not None:
            yield at
            at = at.up


def _names(tag: str, attrs: dict[str, str | None]) -> list[set[str]]:
    """The words of each class and id, without what follows a switch or names a topic."""
    names = [[w.lower() for w in _WORD.findall(name)] for key in ("class", "id") for name in (attrs.get(key) or "").split()]
    article = tag == "article" or any(ARTICLE_PART & set(n) for n in names if n and n[0] not in TOPICS)
    out = []
    for n in names:
        if n and n[0] in TOPICS and (article or not MENUS & set(n)):
            continue
        out.append(set(n[:next((i for i, w in enumerate(n) if w in SWITCHES), len(n))]))
    return out


def part_of_page(tag: str, attrs: dict[str, str | None]) -> tuple[bool, str, bool]:
    """(never article text, "part" or "comments" if its names say so too, likely article text)."""
    each = _names(tag, attrs)
    names = set().union(*each)
    good = tag in ("article", "main") or bool(names & GOOD)
    if tag in ("html", "body", "main"):
        return False, "", good
    style = (attrs.get("style") or "").replace(" ", "").lower()
    if tag in DROPPED or (attrs.get("role") or "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style:
        return True, "", False
    if tag == "form":
        return False, "part", good
    if names & COMMENTS:
        beside = any(n & ARTICLE_PART and not n & COMMENTS for n in each)  # "post discussion", not "post-comments"
        return False, "part" if beside else "comments", good
    if names & BAD or names & WEAK and not names & ARTICLE:
        return False, "part", good
    return False, "", good


class Page(HTMLParser):
    """Elements with points, and the blocks of text that may be article text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", None, False)
        self.elements = [self.root]  # in page order, so an element comes after those around it
        self.open: list[tuple[Element, bool]] = [(self.root, False)]  # with: is it left out
        self.count: Counter[str] = Counter()  # open elements by tag
        self.blocks: list[tuple[str, int, Element]] = []
        self.run: list[str] = []
        self.links, self.in_link = 0, 0

    def _flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.blocks.append((text, self.links, self.open[-1][0].block))
            self.run, self.links = [], 0

    def _cut(self, i: int) -> None:
        self.count.subtract(e.tag for e, _ in self.open[i:])
        del self.open[i:]

    def _close(self, tags: set[str], scope: frozenset[str]) -> None:
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0].tag in tags:
                self._cut(i)
                return
            if self.open[i][0].tag in scope:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.run.append(" ")
            return
        if tag not in INLINE:
            self._flush()
            self.in_link = 0
            self._close({"p"}, SCOPES)
            if tag in CLOSES:
                self._close(CLOSES[tag], SCOPES - CLOSES[tag])
        if tag in VOID:
            return
        up, out = self.open[-1]
        bad, named, good = part_of_page(tag, dict(attrs))
        if tag == "header" and up.in_article and not out:
            bad, named = False, ""  # an article's own heading; only its h1 to h6 count
        if named and tag in INLINE:
            bad, named = True, ""
        if named == "part" and tag == "article" and not up.in_article:
            named = ""  # the tag says more than a name
        if tag == "a":
            self.in_link += 1
        self.elements.append(Element(tag, up, good, named, len(self.elements)))
        self.open.append((self.elements[-1], out or bad))
        self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in INLINE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.count[tag]:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0].tag == tag:
                    if tag not in INLINE:
                        self._flush()
                    self._cut(i)
                    break
                if tag in INLINE and self.open[i][0].tag not in INLINE:
                    return
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)

    def handle_data(self, data: str) -> None:
        if not self.open[-1][1]:
            self.run.append(data)
            if self.in_link:
                self.links += len(data.strip())

    def done(self) -> None:
        if _UNFINISHED.match(self.rawdata):  # at the end; it is no text
            self.rawdata = ""
        self.close()
        self._flush()
        for e in reversed(self.elements[1:]):
            e.up.last = max(e.up.last, e.last)


def _without_parts(blocks: list[tuple[str, int, Element]], elements: list[Element]) -> list[tuple[str, int, Element]]:
    """``blocks`` without those of elements that are no article text by name.

    A name is not believed of an element that holds most of the page's text that
    is no links - nine tenths where nothing in it is a likely article element -
    unless other text stands in an ``article`` or ``main``; of comments, only if
    no other text is left, or if it is the ``article``.
    """
    marked = [e for e in elements if e.marked is e]
    if not marked:
        return blocks
    total, plain, articles = 0, False, []
    for text, links, holder in blocks:
        free = max(0, len(text) - links)
        total += free
        at = holder.marked
        if at is None:
            plain = True
            if holder.whole is not None:
                articles.append(holder.whole)
        else:
            at.free += free
            at.led = max(at.led, holder.lead.depth if holder.lead is not None else -1)
    for e in reversed(marked):
        around = e.up.marked
        if around is not None:
            around.free += e.free
            around.led = max(around.led, e.led)
    newest, nearest_end = max((a.no for a in articles), default=-1), min((a.last for a in articles), default=len(elements))
    out: dict[Element | None, bool] = {None: False}
    for e in marked:  # those around come first
        beside = not newest <= e.no <= nearest_end  # an article element that doesn't hold it
        most = 2 * e.free > total if e.led >= e.depth else 10 * e.free > 9 * total
        believed = beside or not most or e.named == "comments" and (e.up.marked is not None or e.up.in_article or plain and e.tag != "article")
        out[e] = out[e.up.marked] or believed
    return [b for b in blocks if not out[b[2].marked]]


def main_blocks(html: str) -> list[str]:
    page = Page()
    page.feed(html)
    page.done()
    blocks = [b for b in _without_parts(page.blocks, page.elements) if b[2].tag in HEADINGS or not b[2].in_header]
    seen: dict[int, Element] = {}
    for text, links, holder in blocks:
        points = 1 + text.count(",") + min(len(text) / 100, 10)
        start = holder.up if holder.tag in PARAGRAPHS and holder.up is not None else holder
        for share, e in zip(_SHARES, start.above()):
            e.points += points * share
            seen[e.no] = e
        holder.chars += len(text)
        holder.links += links
    for e in reversed(page.elements[1:]):
        e.up.chars += e.chars
        e.up.links += e.links

    def score(e: Element) -> float:
        points = e.points * (1.5 if e.good else 1) + 25 * (e.tag in ("article", "main"))
        return points * (1 - min(1.0, e.links / max(1, e.chars)))

    if not seen:
        return []
    best = max(seen.values(), key=score)  # the first of equals, in the order of first points
    if best.whole is not None:
        return [text for text, _, holder in blocks if best.whole.holds(holder)]
    if best.tag in CELLS:  # layout tables: rows belong together
        best = [best, *(e for e in best.above() if e.tag == "table")][-1]
    while best.up is not None and best.up.tag not in ("body", "html") and best.up.chars == best.chars:
        best = best.up  # a wrapper: what stands beside it stands beside the text
    return _with_siblings(best, blocks, page.elements)


def _with_siblings(best: Element, blocks: list[tuple[str, int, Element]], elements: list[Element]) -> list[str]:
    """The text of ``best`` and of what stands beside it, in page order.

    Siblings are elements and bare text under the same parent. They stay unless
    half of their text is links. A single heading before ``best`` is its title
    and stays also as a link; one after ``best`` goes with the text it heads.
    """
    if best.up is None:
        return [text for text, _, _ in blocks]
    for e in elements[best.up.no + 1:best.up.last + 1]:
        e.side = e if e.up is best.up else e.up.side
    sides: list[tuple[Element | None, list[tuple[str, int, Element]]]] = []  # (child of the parent or None, its blocks)
    for block in blocks:
        if block[2] is best.up:
            sides.append((None, [block]))
            continue
        side = block[2].side
        if side is not None and sides and sides[-1][0] is side:
            sides[-1][1].append(block)
        elif side is not None:
            sides.append((side, [block]))
    at = next((i for i, (side, _) in enumerate(sides) if side is best), len(sides))
    out, heads_kept, heads_any = [], True, False
    for i in range(len(sides) - 1, -1, -1):
        side, own = sides[i]
        heading = len(own) == 1 and own[0][2].tag in HEADINGS
        keep = side is best or 2 * sum(links for _, links, _ in own) < sum(len(text) for text, _, _ in own)
        if heading and i < at:
            keep = True
        elif heading and side is not best:
            keep, heads_any = keep and heads_kept, False
        else:
            heads_kept, heads_any = keep or heads_any and heads_kept, True
        if keep:
            out += [text for text, _, _ in reversed(own)]
    return out[::-1]


def main_text(html: str | None) -> str:
    return "\n".join(main_blocks(html)) if html else ""


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        kept = [c for c in batch.schema.names if c not in ("html", "text", "n_chars")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                         names=[*kept, "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text and n_chars in place of html; other columns stay."""
    kept = [f for f in pages.schema.fields if f.name not in ("html", "text", "n_chars")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return pages.mapInArrow(_run, f"{schema}{', ' if kept else ''}text string, n_chars long")
