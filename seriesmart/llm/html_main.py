"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page becomes a flat list of blocks, the texts between block-level tags.  Each
has its word count and link density, those of the blocks before and after it,
whether it is a heading, whether it stands in an ``article`` or ``main``, and
whether the nearest such container or one inside it is furniture (menu, header,
footer, sidebar, notice, advert, form, comments) by tag, role, class or id.
Names of ``html``, ``body``, ``article`` and ``main`` say nothing, nor do names
that file a page under a category or tag; weak names, which wrappers of whole
articles have too, leave the decision to words and link densities.  A decision
tree, trained here on the small table ``LABELLED``, tells content from
boilerplate.  Scripts, styles, comments, hidden parts and controls are no text;
a ``title`` is one only inside an article.

Defined results: a null or empty page has an empty text; a page without block
tags is one block; unclosed tags end with their container or the page; a ``<``
that begins no tag is text; white space (no-break spaces too) becomes one
space; repeated rows give repeated results; pages are read whole, in time that
grows in proportion also where tags and quotes don't end; an empty table gives
an empty result; further columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import map_column

_SKIPPED = "script|style|noscript|template|iframe|object|textarea|select|button|canvas|video|audio"
#: A tag ends before the next ``<`` that stands in no quotes, so text without any ``>`` isn't gone over again from every ``<``.
_ATTRIBUTES = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<skip>{_SKIPPED})\b{_ATTRIBUTES}>.*?(?:</(?P=skip)\s*>|\Z)"
    rf"|<[!?][^<>]*+>|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_ATTRIBUTES})>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Tags that end a block, and tags, roles and name parts of page furniture.
_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table
    tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("nav header footer aside form menu dialog".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar
    navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert banner popup modal
    overlay comment comments disqus reply replies respond share sharing social related recommended newsletter subscribe signup login
    search widget toolbar pagination pager tags copyright legal disclaimer skip""".split())
#: Name parts that wrappers of whole articles have too: there, words and link densities decide.
_WEAK = frozenset("social share sharing related search widget toolbar pagination pager tags legal login skip".split())
#: Containers whose names say nothing of what stands in them, and beginnings of names that file a page under something.
_WHOLE = frozenset("html body article main".split())
_FILED = re.compile(r"(?:category|cat|tag|term|topic|type|format|status|template|page|has|no|with|is)-")
_OWN = frozenset("article post entry story content main".split())


class Block(NamedTuple):
    text: str
    words: int
    links: float
    furniture: int
    article: bool
    heading: bool


def _furniture(tag: str, attrs: str, article: bool) -> int:
    """2: furniture by tag, role or name; 1: only by a weak name; 0: none."""
    if tag in _FURNITURE and not (tag == "header" and article):
        return 2
    weak = 0
    for name, *values in _ATTRIBUTE.findall(attrs):
        value = "".join(values).lower()
        name = name.lower()
        if name in ("class", "id"):
            if tag in _WHOLE:
                continue
            parts = {x for one in value.split() if not _FILED.match(one) for x in re.split(r"[^a-z]+", one)}
            found = parts & _NAMES
            if found and not (found <= {"header", "tags"} and parts & _OWN):
                if not found <= _WEAK:
                    return 2
                weak = 1
        elif name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return 2
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 2
    return weak


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    # (tag, furniture, article) of the open containers
    stack: list[tuple[str, int, bool]] = []
    open_tags: Counter = Counter()
    texts: list[str] = []
    linked = anchor = at = 0
    heading = False

    def flush() -> None:
        nonlocal linked, texts
        words = "".join(texts).split()
        if words:
            _, furniture, article = stack[-1] if stack else ("", 0, False)
            out.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)), furniture, article, heading))
        texts, linked = [], 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            piece = html.unescape(raw) if "&" in raw else raw
            texts.append(piece)
            if anchor:
                linked += len(piece.split())

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        text(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "title" and not m["close"] and not (stack and stack[-1][2]):
            end = _TITLE_END.search(page, at)
            at = end.end() if end else at
            continue
        if tag == "a":
            anchor = 0 if m["close"] else 1
        elif tag == "br":
            texts.append(" ")
        if tag not in _BLOCKS:
            continue
        flush()
        if m["close"]:
            anchor = 0
            while open_tags[tag]:  # the nearest of its name ends, and all within it
                inner = stack.pop()[0]
                open_tags[inner] -= 1
                if inner == tag:
                    break
            heading = False if tag in _HEADINGS else heading
        elif tag not in _VOID:
            if tag == "p" or tag in _HEADINGS:  # these don't hold each other
                while stack and (stack[-1][0] == "p" or stack[-1][0] in _HEADINGS):
                    open_tags[stack.pop()[0]] -= 1
            furniture, article = stack[-1][1:] if stack else (0, False)
            if tag in ("article", "main"):
                furniture, article = _furniture(tag, m["attrs"], True), True
            else:
                furniture = max(furniture, _furniture(tag, m["attrs"], article))
            stack.append((tag, furniture, article))
            open_tags[tag] += 1
            heading = tag in _HEADINGS
    text(page[at:])
    flush()
    return out


# --- decision tree --------------------------------------------------------------------------

#: The labelled table.  Columns: words, link density, words and link density of the block before and
#: of the one after (0 where there is none), furniture, article, heading; whether it is main text.
LABELLED = [
    # articles: title, paragraphs of all lengths, subheadings, lists and quotations
    ((9, 0.0, 12, 0.0, 60, 0.0, 0, 1, 1), 1), ((6, 0.0, 1, 1.0, 14, 0.0, 0, 1, 1), 1), ((70, 0.0, 9, 0.0, 45, 0.02, 0, 1, 0), 1),
    ((45, 0.02, 70, 0.0, 3, 0.0, 0, 1, 0), 1), ((1, 0.0, 80, 0.0, 90, 0.0, 0, 1, 0), 1), ((3, 0.0, 45, 0.0, 120, 0.0, 0, 1, 1), 1),
    ((120, 0.1, 3, 0.0, 8, 0.0, 0, 1, 0), 1), ((8, 0.0, 120, 0.1, 7, 0.0, 0, 1, 0), 1), ((2, 0.0, 6, 0.0, 5, 0.0, 0, 1, 0), 1),
    ((30, 0.3, 40, 0.0, 25, 0.1, 0, 1, 0), 1), ((5, 0.4, 60, 0.0, 50, 0.0, 0, 1, 0), 1), ((25, 0.0, 10, 0.0, 11, 0.3, 0, 1, 0), 1),
    ((1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0), 1), ((400, 0.01, 5, 0.0, 14, 0.0, 0, 1, 0), 1),
    # link lists and bylines of links inside articles
    ((4, 1.0, 50, 0.0, 5, 1.0, 0, 1, 0), 0), ((5, 1.0, 4, 1.0, 6, 1.0, 0, 1, 0), 0), ((3, 1.0, 5, 1.0, 2, 1.0, 0, 1, 0), 0),
    ((8, 0.9, 30, 0.0, 7, 0.9, 0, 1, 0), 0), ((12, 0.8, 90, 0.0, 2, 1.0, 0, 1, 0), 0),
    # furniture anywhere: menus, notices, adverts, forms, comments, footers
    ((1, 1.0, 1, 1.0, 1, 1.0, 2, 0, 0), 0), ((8, 0.0, 1, 1.0, 6, 0.0, 2, 0, 0), 0), ((15, 0.2, 70, 0.0, 0, 0.0, 2, 0, 0), 0),
    ((60, 0.0, 45, 0.0, 50, 0.0, 2, 0, 0), 0), ((35, 0.0, 3, 0.0, 40, 0.0, 2, 1, 0), 0), ((110, 0.0, 90, 0.0, 80, 0.0, 2, 1, 0), 0),
    ((4, 0.0, 90, 0.0, 30, 0.0, 2, 1, 1), 0), ((20, 0.5, 5, 0.0, 5, 1.0, 2, 0, 0), 0), ((2, 0.0, 2, 0.0, 3, 0.0, 2, 0, 1), 0),
    ((12, 0.0, 60, 0.0, 60, 0.0, 2, 1, 0), 0), ((250, 0.02, 4, 0.0, 30, 0.0, 2, 0, 0), 0),
    # pages without article tags
    ((60, 0.0, 8, 0.0, 55, 0.05, 0, 0, 0), 1), ((55, 0.05, 60, 0.0, 70, 0.0, 0, 0, 0), 1), ((30, 0.1, 55, 0.0, 4, 1.0, 0, 0, 0), 1),
    ((8, 0.0, 50, 0.0, 65, 0.0, 0, 0, 0), 1), ((7, 0.0, 2, 1.0, 75, 0.0, 0, 0, 1), 1), ((5, 0.0, 40, 0.0, 48, 0.0, 0, 0, 1), 1),
    ((18, 0.0, 33, 0.0, 36, 0.0, 0, 0, 0), 1), ((300, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0), 1), ((11, 0.0, 64, 0.0, 2, 1.0, 0, 0, 0), 1),
    ((2, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0), 0), ((3, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0), 0), ((9, 0.7, 5, 1.0, 4, 1.0, 0, 0, 0), 0),
    ((4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0), 0), ((6, 0.0, 4, 0.0, 2, 1.0, 0, 0, 0), 0), ((3, 0.0, 1, 1.0, 5, 0.0, 0, 0, 0), 0),
    ((14, 0.6, 50, 0.0, 6, 1.0, 0, 0, 0), 0), ((2, 0.0, 3, 0.0, 2, 0.0, 0, 0, 1), 0), ((35, 0.9, 10, 0.0, 40, 0.9, 0, 0, 0), 0),
    # paragraphs of links inside articles stand between texts, link lists between links
    ((41, 0.98, 50, 0.0, 45, 0.0, 0, 1, 0), 1), ((12, 0.9, 70, 0.0, 60, 0.0, 0, 1, 0), 1), ((6, 1.0, 60, 0.0, 70, 0.0, 0, 1, 0), 1), ((6, 1.0, 50, 0.0, 60, 0.0, 0, 1, 0), 1), ((90, 1.0, 40, 0.1, 30, 0.0, 0, 1, 0), 1),
    ((41, 0.98, 0, 0.0, 50, 0.0, 0, 1, 0), 1), ((30, 1.0, 20, 0.0, 0, 0.0, 0, 1, 0), 1), ((30, 1.0, 50, 0.0, 35, 1.0, 0, 1, 0), 1), ((35, 1.0, 30, 1.0, 60, 0.0, 0, 1, 0), 1),
    ((25, 0.95, 0, 0.0, 30, 0.0, 0, 1, 0), 1), ((45, 1.0, 25, 0.0, 0, 0.0, 0, 1, 0), 1), ((28, 0.9, 70, 0.0, 28, 0.95, 0, 1, 0), 1),
    ((9, 1.0, 50, 0.0, 0, 0.0, 0, 1, 0), 0), ((10, 1.0, 9, 1.0, 0, 0.0, 0, 1, 0), 0), ((12, 1.0, 60, 0.0, 10, 1.0, 0, 1, 0), 0),
    ((7, 1.0, 60, 0.0, 6, 1.0, 0, 1, 0), 0), ((40, 1.0, 38, 1.0, 42, 1.0, 0, 1, 0), 0), ((6, 1.0, 7, 1.0, 30, 0.0, 0, 1, 0), 0), ((7, 1.0, 6, 1.0, 60, 0.0, 0, 1, 0), 0), ((5, 1.0, 6, 1.0, 90, 0.0, 0, 1, 0), 0),
    # short texts among texts
    ((9, 0.0, 20, 0.0, 18, 0.0, 0, 1, 0), 1), ((4, 0.0, 9, 0.0, 8, 0.0, 0, 1, 0), 1), ((6, 0.1, 11, 0.0, 5, 0.0, 0, 1, 0), 1), ((12, 0.0, 6, 0.0, 4, 0.0, 0, 1, 0), 1),
    ((3, 0.0, 12, 0.0, 40, 0.0, 0, 1, 1), 1), ((7, 0.0, 25, 0.0, 9, 0.0, 0, 0, 0), 1), ((15, 0.0, 22, 0.0, 13, 0.0, 0, 0, 0), 1), ((5, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0), 1),
    ((10, 0.2, 30, 0.0, 25, 0.0, 0, 1, 0), 1), ((8, 0.0, 8, 0.0, 0, 0.0, 0, 1, 0), 1), ((2, 0.0, 15, 0.0, 20, 0.0, 0, 1, 0), 1), ((11, 0.0, 3, 0.0, 12, 0.0, 0, 1, 0), 1),
    # texts beside links stay texts
    ((50, 0.0, 0, 0.0, 41, 0.98, 0, 1, 0), 1), ((60, 0.0, 41, 0.98, 0, 0.0, 0, 1, 0), 1), ((45, 0.0, 30, 0.0, 12, 0.9, 0, 1, 0), 1), ((80, 0.02, 9, 0.0, 5, 1.0, 0, 1, 0), 1),
    ((35, 0.0, 70, 0.0, 4, 1.0, 0, 1, 0), 1), ((28, 0.1, 5, 1.0, 60, 0.0, 0, 1, 0), 1), ((6, 0.0, 0, 0.0, 5, 1.0, 0, 1, 1), 1), ((14, 0.0, 40, 0.0, 3, 1.0, 0, 1, 0), 1),
    ((70, 0.0, 0, 0.0, 6, 1.0, 0, 0, 0), 1), ((35, 0.0, 20, 0.0, 2, 1.0, 0, 0, 0), 1), ((50, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0), 1), ((25, 0.05, 10, 0.0, 4, 1.0, 0, 0, 0), 1),
    ((5, 0.0, 3, 1.0, 0, 0.0, 0, 1, 0), 1), ((9, 0.0, 6, 1.0, 8, 1.0, 0, 1, 0), 1), ((2, 0.0, 4, 0.0, 6, 1.0, 0, 1, 0), 1), ((20, 0.3, 12, 0.9, 15, 0.8, 0, 1, 0), 1),
    # the same few words among texts and among links, without article tags
    ((10, 0.0, 12, 0.0, 14, 0.0, 0, 0, 0), 1), ((10, 0.0, 12, 1.0, 14, 1.0, 0, 0, 0), 0), ((9, 0.0, 30, 0.0, 14, 0.0, 0, 0, 0), 1), ((9, 0.0, 30, 0.9, 14, 0.9, 0, 0, 0), 0),
    # wrappers with a weak name: whole articles in them, and what the name says
    ((80, 0.0, 60, 0.0, 70, 0.0, 1, 0, 0), 1), ((45, 0.05, 80, 0.0, 90, 0.0, 1, 0, 0), 1), ((120, 0.1, 8, 0.0, 50, 0.0, 1, 0, 0), 1), ((50, 0.0, 40, 0.1, 0, 0.0, 1, 1, 0), 1),
    ((6, 0.0, 5, 1.0, 4, 1.0, 1, 0, 0), 0), ((3, 0.0, 60, 0.0, 2, 1.0, 1, 1, 0), 0), ((12, 0.6, 10, 0.7, 11, 0.6, 1, 0, 0), 0), ((15, 0.2, 3, 0.0, 5, 1.0, 1, 0, 0), 0), ((40, 0.9, 50, 0.0, 6, 1.0, 1, 1, 0), 0),
    # notices and comments stay furniture whatever their neighbours
    ((45, 0.0, 60, 0.0, 70, 0.0, 2, 0, 0), 0), ((90, 0.05, 100, 0.0, 120, 0.0, 2, 1, 0), 0),
]
DEPTH = 8


def _impurity(labels: list[int]) -> float:
    p = sum(labels) / len(labels)
    return len(labels) * 2 * p * (1 - p)


def train(table: list[tuple[tuple, int]], depth: int = DEPTH):
    """A binary tree by least Gini impurity: a label, or (feature, limit, tree up to it, tree beyond)."""
    labels = [y for _, y in table]
    if depth == 0 or len(set(labels)) == 1:
        return int(2 * sum(labels) >= len(labels))
    best = None
    for f in range(len(table[0][0])):
        values = sorted({x[f] for x, _ in table})
        for low, high in zip(values, values[1:]):
            limit = (low + high) / 2
            left = [y for x, y in table if x[f] <= limit]
            right = [y for x, y in table if x[f] > limit]
            cost = _impurity(left) + _impurity(right)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, limit)
    if best is None:
        return int(2 * sum(labels) >= len(labels))
    _, f, limit = best
    return (f, limit, train([r for r in table if r[0][f] <= limit], depth - 1), train([r for r in table if r[0][f] > limit], depth - 1))


@lru_cache(maxsize=1)
def tree():
    return train(LABELLED)


def main_text(page: str | None) -> str:
    """The blocks of main text, joined by blank lines."""
    found = blocks(page or "")
    kept = []
    for i, b in enumerate(found):
        before, after = (found[i - 1] if i else None), (found[i + 1] if i + 1 < len(found) else None)
        x = (b.words, b.links, before.words if before else 0, before.links if before else 0.0, after.words if after else 0,
             after.links if after else 0.0, b.furniture, b.article, b.heading)
        node = tree()
        while not isinstance(node, int):
            node = node[2] if x[node[0]] <= node[1] else node[3]
        if node:
            kept.append(b.text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Replace the page by its main text."""
    return map_column(pages, html_col, f"`{text_col}` string", lambda many: {text_col: [main_text(p) for p in many]})
