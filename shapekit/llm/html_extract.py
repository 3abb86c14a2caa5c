"""HTML main text by tag-path ratios.

A page is read as a sequence of text blocks, each with its tag path (root to the
innermost block element).  Per path, the page's text length and punctuation are
summed and divided by its number of blocks.  The two ratios, smoothed over
neighbouring blocks and fused (their product, less link text), are held against a
threshold of the page; paths above it hold content.  The article is the smallest element that
holds the content blocks (or every ``article`` and ``main`` with such blocks, if these hold most of them), with the
headings before it.  All of its blocks are kept, short ones too, except those in elements that are no
article text by tag, role or class.  A form or an element with such a class or id goes only after
scoring, if it holds less of the page's content than the text outside of such elements.  Inside an article
only whole class names and ids count, never those of headings and paragraphs, and words that an article may use for its
own parts (``legal``, ``social``) remove an element only if its paths and links say so too.

Pages are independent, so the work is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: a block's path score counts as content from this share of the page's best score
THRESHOLD = 0.1
#: weights of the smoothing over neighbouring blocks
KERNEL = np.array([0.1, 0.8, 0.1])

TOKEN = re.compile(
    r"<!--.*?(?:--\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？¿¡]")

#: HTML element names by role.
RAW = frozenset("script style noscript template textarea title iframe noframes noembed xmp svg annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i ins kbd label mark math mfenced mfrac mi mn mo
mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover object q rp rt ruby s samp
semantics small span strike strong sub sup time tt u var video""".split()) | {"br", "img", "wbr", "input", "embed"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"}}
#: containers that such an implied end does not cross
SCOPE = frozenset("table ul ol dl div article section main body html blockquote td th select".split())
#: Elements, roles and class or id words of what is not article text.
NOT_TEXT = frozenset("nav footer aside button select menu dialog".split())
ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist
consent cookie cookies copyright disqus footer gdpr legal login masthead menu modal nav navbar navigation newsletter notice notices
notification notifications pager pagination paywall popup promo promos promoted promotion recommended related reply replies respond
share sharing sidebar sidebars signup social sponsor sponsored sponsors subscribe subscription toolbar widget widgets""".split())
#: of these, what parts of an article may be named
OWN_WORDS = frozenset("""banner copyright legal login menu modal notification notifications recommended related reply replies respond
signup social toolbar widget widgets""".split())


#: of these, what readers wrote
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: class names that tell of the page around them ("has-sidebar", "comments-open")
STATE = re.compile(r"(?:has|no|with|without)[-_]\S*|\S*[-_](?:open|opened|closed|enabled|disabled)")
WHOLE = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: elements that are text themselves: their class and id name what they say
LEAVES = HEADINGS | frozenset("p pre caption figcaption dt dd td th tr tbody thead".split())
#: marked elements inside of each other; deeper ones share the fate of the innermost of these
NESTED = 32
#: marks of an element: article text, perhaps not, perhaps comments, not if it looks like it, not article text
TEXT, MAYBE, READERS, OWN, NO_TEXT = range(5)


def _mark(tag: str, attrs: str, in_box: bool, in_article: bool) -> int:
    """Whether an element is menu, header, footer, sidebar, notice or advert (``NO_TEXT``), or
    by its class, its id or as a form could be (``MAYBE``, ``READERS``, ``OWN``)."""
    if tag in NOT_TEXT or tag == "header" and not in_box:
        return NO_TEXT
    mark = MAYBE if tag == "form" else TEXT
    if "=" not in attrs and "hidden" not in attrs:
        return mark
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name in ("class", "id"):
            names = [v for v in value.split() if not STATE.fullmatch(v)]
            words = set(names) if in_box else {w for v in names for w in re.split(r"[^a-z0-9]+", v)}
            if tag in WHOLE:  # only an article inside of an article is a comment by its class
                if tag == "article" and in_article and words & COMMENTS:
                    return NO_TEXT
            elif tag in LEAVES:
                continue
            elif words & COMMENTS and not (in_box and words & OWN_WORDS):
                mark = READERS
            elif in_box and words & OWN_WORDS and not words & (WORDS - OWN_WORDS):
                mark = mark or OWN
            elif words & WORDS or "header" in words and not in_box and not words & {"article", "entry", "post", "content", "story"}:
                mark = mark if mark == READERS else MAYBE
        elif name == "role" and value == "form":
            mark = mark or MAYBE
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return NO_TEXT
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return NO_TEXT
    return mark


class Element(NamedTuple):
    """An open element: what holds for its text, all of it known from its parent."""

    tag: str
    number: int  # in page order
    box: int  # number of the innermost element that is no inline one
    path: int  # number of that one's tag path
    inline: bool
    hidden: bool
    linked: bool
    article: int  # number of the enclosing article or main, else 0
    in_article: bool
    marked: int  # innermost marked element, else 0


class Block(NamedTuple):
    text: str
    path: int
    tag: str
    box: int
    linked: int
    article: int
    marked: int


class Page:
    """Text blocks outside of non-article elements, and the elements by number: parent, last one inside, mark and
    next marked element around (marked ones only).  Nothing grows with the depth of an element."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.parent, self.last = [0], [0]
        self.marks: dict[int, tuple[int, int]] = {}
        paths: dict[tuple[int, str], int] = {}
        nested: dict[int, int] = {}
        stack = [Element("", 0, 0, 0, False, False, False, 0, False, 0)]
        open_: Counter[str] = Counter()
        run: list[str] = []
        linked = number = end = pos = 0

        def flush():
            nonlocal linked
            if run:
                top = stack[-1]
                text = " ".join("".join(run).split())
                run.clear()
                if text and not top.hidden:
                    self.blocks.append(Block(text, top.path, tags[top.box], top.box, linked, top.article, top.marked))
            linked = 0

        def text_until(stop: int):
            nonlocal linked
            if stop > end:
                piece = unescape(html[end:stop])  # a reference does not run over a tag
                run.append(piece)
                if stack[-1].linked:
                    linked += len(piece.strip())

        def close(at: int):
            for e in stack[at:]:
                open_[e.tag] -= 1
                self.last[e.number] = number
            del stack[at:]

        tags = [""]
        while m := TOKEN.search(html, pos):
            text_until(m.start())
            pos = end = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag = tag.lower()
            closing, attrs = m[1] or m[4], (m[3] if m[2] else m[6]) or ""
            if not closing and tag in RAW:
                if attrs.rstrip().endswith("/") and tag == "svg":
                    continue
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(html, pos)
                pos = end = stop.end() if stop else len(html)
                if tag != "svg":
                    run.append(" ")
                continue
            inline = tag in INLINE
            if not inline:
                flush()
            elif tag in ("br", "img"):
                run.append(" ")
            if closing:
                if open_[tag] > 0:
                    at = next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag)
                    if not (inline and any(not e.inline for e in stack[at + 1:])):
                        close(at)
                continue
            if tag in VOID:
                continue
            if not inline:
                ends = CLOSES.get(tag, set())
                if open_["p"] > 0 or any(open_[x] > 0 for x in ends):
                    for k in range(len(stack) - 1, 0, -1):
                        name = stack[k].tag
                        if name == "p" or name in ends:  # a block ends an open paragraph, an item the item before
                            close(k)
                        elif name in SCOPE and not (ends and name in ("td", "th")):
                            break
            elif tag == "a" and open_["a"] > 0:  # a link ends the one before it
                at = next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "a")
                if not any(not e.inline for e in stack[at + 1:]):
                    close(at)
            number += 1
            top = stack[-1]
            self.parent.append(top.number)
            self.last.append(number)
            tags.append(tag)
            article = number if tag == "article" and not top.in_article or tag == "main" and not top.article else top.article
            mark = _mark(tag, attrs, bool(top.article), top.in_article)
            if mark in (MAYBE, READERS, OWN) and nested.get(top.marked, 0) < NESTED:
                self.marks[number] = (mark, top.marked)
                nested[number] = nested.get(top.marked, 0) + 1
            link = tag == "a" and any(x[1].lower() == "href" for x in ATTRIBUTE.finditer(attrs))
            path = top.path if inline else paths.setdefault((top.path, tag), len(paths) + 1)
            stack.append(Element(tag, number, top.box if inline else number, path, inline, top.hidden or mark == NO_TEXT, top.linked or link, article,
                                 top.in_article or tag == "article", number if number in self.marks else top.marked))
            open_[tag] += 1
        text_until(len(html))
        flush()
        close(0)

    def around(self, block: Block) -> Iterator[tuple[int, int]]:
        """The marked elements around a block, inner ones first, with their marks."""
        e = block.marked
        while e:
            mark, outer = self.marks[e]
            yield e, mark
            e = outer


def _weights(found: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks are on paths that hold content, and the text they weigh."""
    paths = {p: k for k, p in enumerate(dict.fromkeys(b.path for b in found))}
    of = np.array([paths[b.path] for b in found])
    chars = np.array([len(b.text) - min(len(b.text), b.linked) for b in found], float)
    marks = np.array([len(PUNCTUATION.findall(b.text)) if b.linked < len(b.text) else 0 for b in found], float)
    nodes = np.bincount(of)
    text_ratio = (np.bincount(of, chars) / nodes)[of]
    mark_ratio = (np.bincount(of, marks) / nodes)[of]
    smooth = lambda x: np.convolve(np.pad(x, 1, "edge"), KERNEL, "valid")
    score = smooth(text_ratio) * (1 + smooth(mark_ratio))
    by_path = np.bincount(of, score) / nodes
    good = (by_path >= THRESHOLD * by_path.max())[of] & (text_ratio > 0)
    if not good.any():
        good[:] = True
    return good, np.where(good, chars + 1, 0)


def _without(page: Page, found: list[Block], gone: set[int]) -> list[Block]:
    return [b for b in found if not any(e in gone for e, _ in page.around(b))] if gone else found


def _holders(page: Page, found: list[Block], mark: int) -> dict[int, list[int]]:
    """The elements with a mark, outer ones first, with the places of their blocks."""
    out: dict[int, list[int]] = {}
    for k, b in enumerate(found):
        for e, m in page.around(b):
            if m == mark:
                out.setdefault(e, []).append(k)
    return dict(sorted(out.items()))


def unmarked(page: Page) -> list[Block]:
    """The blocks without those of marked elements, except of elements that hold the page's content."""
    found = page.blocks
    if not any(b.marked for b in found):
        return found
    by_readers = lambda b: any(m == READERS for _, m in page.around(b))
    own = [b for b in found if not by_readers(b)]
    if own and (holders := _holders(page, own, MAYBE)):
        _, weight = _weights(own)
        open_ = [sum(m == MAYBE for _, m in page.around(b)) for b in own]  # marked elements around a block that are not kept yet
        rest = sum(w for w, n in zip(weight, open_, strict=True) if not n)
        gone = set()
        for e, places in holders.items():
            held = weight[places].sum()
            if not held or held < rest:
                gone.add(e)
                continue
            for k in places:
                open_[k] -= 1
                rest += 0 if open_[k] else weight[k]
        found = _without(page, found, gone)
    if found and (holders := _holders(page, found, OWN)):
        good, _ = _weights(found)
        text = np.array([len(b.text) for b in found])
        links = np.array([min(b.linked, len(b.text)) for b in found])
        found = _without(page, found, {e for e, at in holders.items() if not good[at].any() or 2 * links[at].sum() > text[at].sum()})
    if own and found and (holders := _holders(page, found, READERS)):
        _, weight = _weights(found)
        before = np.cumsum([0 if by_readers(b) or b.tag in HEADINGS else w for b, w in zip(found, weight, strict=True)])
        found = _without(page, found, {e for e, places in holders.items() if before[places[0]] and before[places[0]] >= THRESHOLD * weight[places].sum()})
    return found


def content(page: Page) -> list[str]:
    """The blocks of the article."""
    found = unmarked(page)
    if not found:
        return []
    good, weight = _weights(found)
    boxed = np.array([b.article > 0 for b in found])
    if 2 * weight[boxed].sum() >= weight.sum():  # every article and main that holds content
        ends = [b.article for b, g in zip(found, good & boxed, strict=True) if g]
    else:
        ends = [b.box for b, g in zip(found, good, strict=True) if g]
    shared = ends[0]  # the innermost element around all of these
    while not (shared <= min(ends) and max(ends) <= page.last[shared]):
        shared = page.parent[shared]
    holds = lambda e: shared <= e <= page.last[shared]
    if any(b.box == shared for b, g in zip(found, good, strict=True) if g) and not any(b.article and b.article <= shared <= page.last[b.article] for b in found):
        shared = page.parent[shared]  # one block: its neighbours belong to the text
    inside = [holds(b.box) for b in found]
    first = start = inside.index(True)
    for k in range(first - 1, -1, -1):  # headings before it, and the lines between
        if found[k].linked >= len(found[k].text):
            break
        if found[k].tag in HEADINGS:
            start = k
    return [b.text for k, b in enumerate(found) if inside[k] or start <= k < first]


def main_text(html: str | None) -> str:
    return "\n".join(content(Page(html))) if html else ""


def _run(batches):
    for batch in batches:
        texts = [main_text(h) for h in C.column(batch, "html").to_pylist()]
        yield pa.RecordBatch.from_arrays([C.column(batch, "page_id"), C.column(batch, "url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``.

    Null, empty and text-free pages have an empty text.  Tags left open, to any depth, unknown tags and
    stray ends are read as browsers do for blocks; a page without tags is one block.
    Repeated rows are each returned; nulls in page_id or url are passed on.  Other columns are ignored.
    """
    C.prepare(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return (pages.mapInArrow(_run, "page_id long, url string, text string")
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
