"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level elements. The first pass decides on what a block shows: where it stands,
its length, the density of stop words and of links. Names of elements, and forms, are evidence only: what holds most of
the page's long text is not set apart by them. Short blocks that show too little stay open; in the second pass
they take the label of the nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import text_batches

# --- fixed values: elements of HTML by what they do to the text
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe noembed noframes xmp template".split())  # their content is no markup of the page
APART = frozenset("head nav footer aside menu noscript button select dialog svg math object canvas audio video label".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# names of classes, ids and roles that mark what is not the article
APART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "nav navbar navigation navigator menu menus submenu breadcrumb breadcrumbs toc toolbar topbar pager pagination paging "
    "header masthead footer foot colophon copyright legal sidebar sidebars aside rail complementary contentinfo widget widgets "
    "cookie cookies consent gdpr notice notices alert alerts disclaimer popup modal overlay newsletter subscribe subscription signup "
    "login signin search share sharing social related recommended recommendations teaser outbrain taboola "
    "comment comments commentlist respond reply replies discussion disqus form skip hidden tags".split()
)
# of these, what marks text of another kind, which may outgrow the article; the others are also found on its layout
OTHER_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted related recommended "
    "recommendations teaser outbrain taboola cookie cookies consent gdpr footer foot colophon copyright legal disclaimer contentinfo "
    "newsletter comment comments commentlist respond reply replies discussion disqus".split()
)
# of names on elements within a line, only these set their text apart
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted outbrain taboola".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
ARTICLE_NAMES = frozenset("ad ads advert adverts advertisement comment comments promo promos promotion reply replies teaser teasers".split())
# parts of names that tell of a page's layout or an element's state instead
LAYOUT = frozenset("no not non without has have with is overflow".split())
STATES = frozenset("fixed sticky static enabled disabled open closed on off visible active collapsed expanded".split())
STOP_WORDS = frozenset(
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son "
    "el los las del se por con una su para es al lo como más pero sus le ya o fue este ha sí porque esta entre".split()
)

LONG = 25  # words from which a block speaks for itself
SHORT = 8  # words below which it does not
STOP_HIGH, STOP_LOW = 0.2, 0.06
STOP_USUAL = 0.15  # what long blocks of a language with listed stop words reach
LISTED = 0.25  # part of a page's long text that reaches it, from which stop words decide
LINK_HIGH = 0.4  # part of a block's characters that are link text

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_BETWEEN_QUOTES = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[^\W\d_]+")
_NAME = re.compile(r"[a-z]+")
# scripts without spaces between words: Thai to Myanmar, Khmer, Japanese, Chinese; two characters count as a word
_UNSPACED = re.compile(r"[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_SENTENCE = re.compile(r"[.!?…。！？।؟]\W*\Z")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    words: int
    stops: float
    links: float
    apart: bool  # inside a menu, footer, advert, form or the like
    inside: int  # number of the outermost article or main element it is in, or 0
    heading: bool
    other: bool = False  # most of its words are in a script of none of the listed stop words
    good: bool | None = None


def _is_apart(tag: str, attributes: str, inside: int) -> bool:
    if tag in APART or (tag == "header" and not inside):
        return True
    if not attributes.strip():
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN_STYLE.search(value)):
            return True
    return False


def _names(tag: str, attributes: str) -> set[str]:
    """Names in class, id and role that speak for setting the element apart: a whole name, or its first or last word."""
    out: set[str] = set()
    if tag in ("html", "body", "main") or not attributes.strip():
        return out
    known = ARTICLE_NAMES if tag == "article" else APART_NAMES
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for part in html.unescape(value.strip("\"'")).split():
                words = _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", part).lower())
                if words and LAYOUT.isdisjoint(words) and words[-1] not in STATES:
                    out |= known & {words[0], words[-1]}
    return out


@dataclass
class Named:
    """An element that its name, or being a form, speaks for setting apart."""

    above: int  # the next such element around it, or -1
    form: bool
    main: bool = False  # whether a main element is in it
    weights: tuple[int, ...] = (0, 0, 0, 0)


def _set_apart(found: list[Block], places: list[tuple[int, bool, bool]], named: list[Named]) -> None:
    """Sets ``apart`` of the blocks in named elements, but for those that hold a main element or most of the long text.

    Text in elements of ``OTHER_TEXT`` counts only if no other long text is there, or in an article within. Without long
    text what stands in articles counts; without any that, of forms, blocks of ``SHORT`` words do.
    """
    if not named:
        return
    totals = [0, 0, 0, 0]
    for b, (at, other, article) in zip(found, places, strict=True):
        if b.apart or b.links >= LINK_HIGH:
            continue
        n, long = len(b.text), b.words >= LONG
        weights = (n * (long and not other), n * (article and not other), n * long, n * (b.words >= SHORT))
        totals = [t + w for t, w in zip(totals, weights, strict=True)]
        if at >= 0:
            named[at].weights = tuple(x + w for x, w in zip(named[at].weights, weights, strict=True))
    for e in reversed(named):  # what is inside comes later
        if e.above >= 0:
            above = named[e.above]
            above.main |= e.main
            above.weights = tuple(x + w for x, w in zip(above.weights, e.weights, strict=True))
    level = next((i for i, t in enumerate(totals) if t), 3)
    apart: list[bool] = []
    for e in named:
        holds = e.main or (2 * e.weights[level] > totals[level] and (level < 3 or e.form))
        apart.append(not holds or (e.above >= 0 and apart[e.above]))
    for b, (at, _, _) in zip(found, places, strict=True):
        b.apart = b.apart or (at >= 0 and apart[at])


class _Scanner:
    """Finds the markup of a page, each character looked at a bounded number of times, however broken it is."""

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.last_end, self.last_start = page.rfind(">"), page.rfind("<")
        self.quotes = True  # whether quotes still hide the end of a tag: until one runs to the page's end

    def _end(self, at: int) -> int:
        """Behind the end of the tag whose name ends here."""
        start = at
        while self.quotes:
            at = _BETWEEN_QUOTES.match(self.page, at).end()
            if at >= self.size:
                self.quotes = False
            elif self.page[at] == ">":
                return at + 1
            else:
                at = self.page.find(self.page[at], at + 1) + 1
                if not at:
                    self.quotes = False
        return self.page.find(">", start) + 1

    def next(self, at: int) -> tuple[int, int, str, bool, str]:
        """Begin and end of the next piece of markup, its tag (empty for comments and the like), whether it is a closing
        one, and its attributes. What the page's end cuts off counts as markup; a ``<`` that begins none is text."""
        page = self.page
        while True:
            at = page.find("<", at)
            if at < 0:
                return self.size, self.size, "", False, ""
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else self.size, "", False, ""
            after = page[at + 1 : at + 2]
            if at > self.last_end:
                if at == self.last_start and (after in "/!?" or (after.isascii() and after.isalpha())) and after:
                    return at, self.size, "", False, ""
            elif hit := _TAG.match(page, at):
                end = self._end(hit.end())
                if end:
                    return at, end, hit[2].lower(), bool(hit[1]), page[hit.end() : end - 1]
            elif after and after in "/!?":
                return at, page.find(">", at) + 1, "", False, ""
            at += 1

    def behind_raw(self, tag: str, at: int) -> int:
        """Behind the end of an element whose content is no markup."""
        end = re.compile(rf"</{re.escape(tag)}\b", re.I).search(self.page, at)
        at = self.page.find(">", end.end()) + 1 if end else 0
        return at or self.size


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order.

    A text belongs to the element it stands in: where an element within a line is set apart (a button, an advert, a
    hidden span), its text is a block of its own and that of the line goes on behind it.
    """
    found: list[tuple[int, Block, tuple[int, bool, bool]]] = []
    named: list[Named] = []
    # tag, then apart, inside, heading, named element, other text, in an unnamed article (each with what stands above),
    # then the text of the line around it, if that is set aside
    stack: list[tuple[str, tuple, tuple | None]] = []
    open_tags: Counter[str] = Counter()
    open_blocks: list[int] = []  # places of block elements in the stack
    text: list[str] = []
    begin = linked = links = articles = 0
    top = (False, 0, False, -1, False, False)
    state = top

    def close() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            apart, inside, heading, place, other, article = state
            words = _WORD.findall(joined.lower())
            stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
            size, foreign = len(joined.split(" ")), False
            if not joined.isascii():
                size += len(_UNSPACED.findall(joined)) // 2
                foreign = 2 * sum(w[0] > "\u024f" and not "\u1e00" <= w[0] <= "\u1eff" for w in words) > len(words)
            block = Block(joined, size, stops, min(1.0, linked / len(joined)), apart, inside, heading, foreign)
            found.append((begin, block, (place, other, article)))
        text.clear()
        linked = 0

    def pop(at: int) -> None:
        nonlocal state, links, linked, begin
        while len(stack) > at:
            tag, _, around = stack[-1]
            if around is not None or tag in BLOCK:
                close()
            stack.pop()
            open_tags[tag] -= 1
            links -= tag == "a"
            if open_blocks and open_blocks[-1] == len(stack):
                open_blocks.pop()
            state = stack[-1][1] if stack else top
            if around is not None:
                text[:], linked, begin = around
                if text:
                    text.append(" ")

    scanner, at, size = _Scanner(page), 0, len(page)
    while at < size:
        start, end, tag, closing, attributes = scanner.next(at)
        data = html.unescape(page[at:start])
        if data:
            if not text:
                begin = at
            text.append(data)
            if links:
                linked += len(data.strip())
        at = end
        if not tag:
            continue
        if tag in BLOCK:
            close()
        elif tag == "br":
            text.append(" ")
        if closing:
            if open_tags[tag] > 0:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        pop(i)
                        break
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            at = scanner.behind_raw(tag, at)
            continue
        if tag in BLOCK and open_blocks:  # a paragraph, and what is open within it, ends where the next block starts
            last = stack[open_blocks[-1]][0]
            if last == "p" or (tag == "li" and last == "li"):
                pop(open_blocks[-1])
        apart, inside, heading, place, other, article = state
        names = set() if apart else _names(tag, attributes)
        if tag in INLINE:
            names &= ADVERTS
        was_apart = apart
        apart = apart or _is_apart(tag, attributes, inside)
        if tag in ("article", "main"):
            if not inside:
                articles += 1
                inside = articles
            if tag == "main" and place >= 0 and not apart:
                named[place].main = True
            if not names:
                other, article = False, True
        if names or tag == "form":
            named.append(Named(place, tag == "form"))
            place = len(named) - 1
            if not OTHER_TEXT.isdisjoint(names):
                other, article = True, False
        around = None
        if tag not in BLOCK and (apart != was_apart or (names and tag in INLINE)):
            around = (text[:], linked, begin)
            text.clear()
            linked = 0
        state = (apart, inside, heading or tag in HEADINGS, place, other, article)
        if tag in BLOCK:
            open_blocks.append(len(stack))
        stack.append((tag, state, around))
        open_tags[tag] += 1
        links += tag == "a"
    close()
    pop(0)
    close()
    found.sort(key=lambda f: f[0])
    out = [block for _, block, _ in found]
    _set_apart(out, [place for _, _, place in found], named)
    return out


def _is_marked(found: list[Block]) -> bool:
    """Whether article or main elements tell where the text is: they hold most of the page's long text.

    An element's text is long if its blocks are together; cards of few words are not.
    """
    words: dict[int, int] = {}
    weights: dict[int, int] = {}
    for b in found:
        if not b.apart and (b.inside or b.words >= LONG) and b.links < LINK_HIGH:
            words[b.inside] = words.get(b.inside, 0) + b.words
            weights[b.inside] = weights.get(b.inside, 0) + len(b.text)
    outside = weights.pop(0, 0)
    if not outside:
        return any(b.inside and not b.apart for b in found)
    return sum(n for i, n in weights.items() if words[i] >= LONG) > outside


def _is_listed(found: list[Block]) -> bool:
    """Whether the page's long text is, in good part, in a language whose stop words are listed.

    Without long blocks the shorter ones, from ``SHORT`` words on, tell it.
    """
    for least in (LONG, SHORT):
        rows = [(b.words, b.stops) for b in found if not b.apart and b.links < LINK_HIGH and b.words >= least]
        if rows:
            return sum(n for n, stops in rows if stops >= STOP_USUAL) >= LISTED * sum(n for n, _ in rows)
    return True


def _has_own_words(b: Block) -> bool:
    """Whether a block with many links says something beside them: some words, and fewer if they make a sentence."""
    own = (1 - b.links) * b.words
    return own >= 3 or (own >= 1.5 and bool(_SENTENCE.search(b.text)))


def _is_sentence(b: Block) -> bool:
    return b.words >= 3 and b.links < LINK_HIGH / 2 and bool(_SENTENCE.search(b.text))


def classify(found: list[Block]) -> None:
    """Sets ``good`` of each block."""
    marked, listed = _is_marked(found), _is_listed(found)
    doubted = set()  # failed one test of density, but may be part of an article: its neighbours tell
    for i, b in enumerate(found):
        by_stops = listed and not b.other
        if b.apart or (marked and not b.inside):
            b.good = False
        elif b.links >= LINK_HIGH:
            b.good = None if marked and b.words < LONG else False
            if _has_own_words(b):
                doubted.add(i)
        elif b.words >= LONG:
            b.good = True if marked or not by_stops else b.stops >= STOP_LOW
            if not b.good:
                doubted.add(i)
        elif b.words >= SHORT and b.links < LINK_HIGH / 2 and (b.stops >= STOP_HIGH if by_stops else bool(_SENTENCE.search(b.text))):
            b.good = True
    if not any(b.good for b in found):  # short paragraphs only: sentences speak for themselves
        for b in found:
            if b.good is None and _is_sentence(b) and not b.heading:
                b.good = True
    at = [i for i, b in enumerate(found) if not b.apart]  # a doubted block between two good ones belongs to them
    sure = {i for i in at if found[i].good}
    for left, i, right in zip(at, at[1:], at[2:]):
        if i in doubted and left in sure and right in sure and found[left].inside == found[right].inside:
            found[i].good = True
    # second pass: the nearest decided block on each side; a heading looks ahead, the others to the nearer side
    labels = [b.good for b in found]
    before: list[tuple[int, bool] | None] = []
    last = None
    for i, label in enumerate(labels):
        before.append(last)
        if label is not None:
            last = (i, label)
    after = None
    for i in range(len(found) - 1, -1, -1):
        b = found[i]
        if labels[i] is not None:
            after = (i, labels[i])
            continue
        left, right = before[i], after
        if marked:  # within an article its own end and begin are no neighbours
            left = left if left and found[left[0]].inside and not found[left[0]].apart else None
            right = right if right and found[right[0]].inside and not found[right[0]].apart else None
        if b.heading and right:
            b.good = right[1]
        elif left and right:
            b.good = left[1] if i - left[0] < right[0] - i else right[1] if right[0] - i < i - left[0] else left[1] or right[1]
        else:
            side = left or right
            b.good = side[1] if side else marked


def main_text(page: str) -> str:
    """The good blocks, one per line; empty if there are none."""
    found = blocks(page)
    classify(found)
    return "\n".join(b.text for b in found if b.good)


def extract(pages: DataFrame, html_column: str, into: str = "main_text") -> DataFrame:
    """All rows and columns of ``pages`` plus the main text as ``into`` (replaced if there).

    Null and empty pages, and pages without an article's text, give an empty text. Pages of any length are read as a
    whole; tags, comments and scripts that the page's end cuts off are left out. Repeated rows stay.
    """
    text_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def texts(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in column:
            yield pd.Series([main_text(v) if isinstance(v, str) else "" for v in values], dtype=object)

    return pages.withColumn(into, texts(F.col(f"`{html_column}`")))
