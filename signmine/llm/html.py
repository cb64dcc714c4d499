"""Operator 8: main text of web pages, by a tree-structured graphical model over DOM nodes."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their parsing and layout.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Nothing in these is markup but their own end, and none of it is shown.
RAW = frozenset("script style textarea title iframe noembed noframes".split())
#: Parsed, but never shown as text of the page; buttons and selections are forms' parts wherever they stand.
UNSEEN = frozenset("button select datalist template desc metadata annotation annotation-xml defs symbol".split())
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big button canvas cite code data datalist del dfn em font i img ins kbd label map mark meter nobr object output picture progress q rp rt ruby s samp select slot small span strike strong sub sup template time tt u var video "
    "svg g path rect circle ellipse line polyline polygon text tspan textpath defs use symbol marker stop mask pattern filter image desc metadata lineargradient radialgradient clippath foreignobject animate animatetransform "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics annotation annotation-xml".split()
)
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: An element of the key's name ends when one of these begins.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}} | {h: HEADINGS for h in HEADINGS}
#: Ends of elements outside don't reach through these.
SCOPES = frozenset(("table", "td", "th", "caption"))
_CELLS, _ROW_GROUPS = ("td", "th", "caption"), ("tbody", "thead", "tfoot")

# Words in class, id and role that may speak against content, by what they name; what else such a name may hold; and words for content.
FAMILIES = {
    "navigation": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar skip toc",
    "header": "header masthead banner hero",
    "footer": "footer foot contentinfo copyright colophon",
    "sidebar": "sidebar aside complementary rail widget widgets",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion promotions dfp adsense",
    "notice": "cookie cookies consent gdpr notice notices alert alerts popup modal dialog overlay toast announcement",
    "comments": "comment comments reply replies respond disqus commentlist discussion",
    "form": "form forms search searchform login signup signin subscribe subscription newsletter register",
    "social": "share sharing shares social follow addthis",
    "related": "related recommended recommendations recommend similar popular trending",
    "other": "tag tags legal meta byline author tagcloud",
}
_FAMILY = {word: i for i, words in enumerate(FAMILIES.values()) for word in words.split()}
FOR = frozenset("article articlebody content contents main post posts entry story body text blog blogpost prose document markdown".split())
#: Parts of a name that change nothing in what it names.
_PLAIN = frozenset("area bar block bottom box btn button buttons card column container footer global group header inner item items left links list main outer page panel primary right row secondary section site slot top unit wrap wrapper wrapping zone".split())
#: A name that begins so tells of a page's state or kind and not of an element's.
_STATES = frozenset("has is no not with without type category format status single hide show js".split())
#: Words that short notices, adverts and the like hold; as evidence these are weak.
_CUES = re.compile(r"(?i)\b(?:cookies?|copyright|all rights reserved|subscribe|sign (?:up|in)|log ?in|advert(?:isement)?|sponsored|share (?:this|on)|related|comments?|repl(?:y|ies)|newsletter|javascript|privacy policy|terms of)\b|©")

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_NAME = re.compile(r"[\s/]*+(?:(>)|(=?[^\s/>=]*+)\s*+(?:(=)\s*+)?+)")
_BARE = re.compile(r"[^\s>]*+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
_COMMENT_END = re.compile(r"--!?>")
_NOT_SHOWN = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

TAGS = ("html", "body", "article", "main", "section", "div", "p", "h1", "h2", "heading", "list", "li", "nav", "header", "footer", "aside", "form", "table", "cell", "quote", "figure", "noscript", "details", "other")
_TAG_GROUP = {t: t for t in TAGS} | dict.fromkeys(("h3", "h4", "h5", "h6", "hgroup"), "heading") | dict.fromkeys(("ul", "ol", "dl", "menu", "dir"), "list") | dict.fromkeys(("dt", "dd"), "li") | dict.fromkeys(("tr", "tbody", "thead", "tfoot", "caption"), "table") | dict.fromkeys(("td", "th"), "cell") | dict.fromkeys(("blockquote", "pre"), "quote") | {"figcaption": "figure", "summary": "details"} | dict.fromkeys(("fieldset", "legend", "dialog", "search"), "form") | {"address": "footer"}
_TAG_NUMBER = {t: i for i, t in enumerate(TAGS)}
_TEXT_GROUPS = frozenset(("p", "h1", "h2", "heading", "list", "li", "table", "cell", "quote", "figure", "details"))
_PLACES = ("text", "holder", "box")
#: Features of names: by family whole names in class or role and in id, by the element's place; then weak ones, and names for content.
_N_FAMILIES = len(FAMILIES)
_AT_CLASS, _AT_ID = len(TAGS), len(TAGS) + _N_FAMILIES * len(_PLACES)
_AT_WEAK = _AT_ID + _N_FAMILIES * len(_PLACES)
_AT_FOR = _AT_WEAK + len(_PLACES)
_AT_LINKS = _AT_FOR + len(_PLACES) + 2
_AT_TEXT = _AT_LINKS + 4
_AT_OWN = _AT_TEXT + 6
_AT_SHARE = _AT_OWN + 6
_AT_PARAGRAPHS = _AT_SHARE + 5
_AT_WHERE = _AT_PARAGRAPHS + 4
N_FEATURES = _AT_WHERE + 7
#: Kinds of edges, each with a table of 2 x 2 potentials, by what the child is.
_KINDS = ("plain", "text", "against", "named", "for", "header", "footer", "boilerplate")
EDGE_KINDS = len(_KINDS)


@dataclass
class Page:
    """Block nodes in document order, a parent before its children; and the runs of text between block borders, with the node that holds each."""

    tags: list[str] = field(default_factory=list)
    hints: list[tuple[str, str]] = field(default_factory=list)  # class and role, id
    parents: list[int] = field(default_factory=list)
    text: list[tuple[int, str]] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)  # of data-label, for pages to learn from


def attributes(source: str, place: int, missing: set[str]) -> tuple[dict[str, str] | None, bool, int]:
    """(attributes, whether the tag ends itself, place after it) of a tag whose name ends at place; None for attributes if the page ends in it.

    Each character is passed over once, and a quote that nothing closes is looked for once: missing keeps it. Of repeated names the first counts.
    """
    found: dict[str, str] = {}
    n = len(source)
    while True:
        m = _NAME.match(source, place)
        place = m.end()
        if m[1]:
            return found, source[place - 2] == "/", place
        if place >= n:
            return None, False, n
        value = ""
        if m[3]:
            quote = source[place]
            end = source.find(quote, place + 1) if quote in "\"'" and quote not in missing else -1
            if end >= 0:
                value, place = source[place + 1 : end], end + 1
            else:
                if quote in "\"'":
                    missing.add(quote)
                bare = _BARE.match(source, place)
                value, place = bare[0], bare.end()
        found.setdefault(m[2].lower(), value)


def hidden(found: dict[str, str]) -> bool:
    """Whether an element has the attribute hidden, aria-hidden of true, or a style that doesn't show it; other attributes' values say nothing."""
    return "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or _NOT_SHOWN.search(found.get("style", "")) is not None


class _Block:
    """An open block element with the inline elements that are open in it."""

    __slots__ = ("counts", "inline", "links", "node", "off", "scope", "tag", "unseen")

    def __init__(self, tag: str, node: int, off: bool, links: int, scope: Counter):
        self.tag, self.node, self.off, self.links, self.scope = tag, node, off, links, scope
        self.inline: list[tuple[str, bool]] = []
        self.counts: dict[str, int] = {}
        self.unseen = 0


def parse(source: str) -> Page:
    """Lenient, in time linear in the page: unknown ends are passed over, missing ends are supplied, as browsers mostly do.

    Comments, scripts, styles, titles, buttons, selections and hidden elements leave nothing; a hidden element ends where others of its name do.
    """
    page = Page(["html"], [("", "")], [-1], [], [0], [0], [0])
    scopes: list[Counter] = [Counter()]  # open blocks by name, from the innermost table, cell or page on
    owners = ["html"]  # what began each scope
    stack = [_Block("html", 0, False, 0, scopes[0])]
    run: list[str] = []
    missing: set[str] = set()
    place, size, has_body = 0, len(source), False

    def flush() -> None:
        if run:
            body = _SPACE.sub(" ", "".join(run)).strip()
            if body:
                node = stack[-1].node
                page.text.append((node, body))
                page.chars[node] += len(body)
            run.clear()

    def say(text: str) -> None:
        top = stack[-1]
        if not top.off and not top.unseen:
            text = html.unescape(text)
            run.append(text)
            if top.links:
                page.links[top.node] += len(text)

    def pop() -> None:
        flush()
        top = stack.pop()
        top.scope[top.tag] -= 1
        if top.tag in SCOPES:
            scopes.pop()
            owners.pop()

    def close(tag: str) -> None:
        """The innermost open block of that name, with all that is open in it; it must be in the scope."""
        while stack[-1].tag != tag:
            pop()
        pop()

    def close_inline(tag: str) -> None:
        top = stack[-1]
        if top.counts.get(tag):
            while True:
                name, unseen = top.inline.pop()
                top.counts[name] -= 1
                top.unseen -= unseen
                top.links -= name == "a"
                if name == tag:
                    break

    def implied_ends(tag: str) -> None:
        if stack[-1].unseen and tag != "div":
            close_inline("button")
            close_inline("select")
        if tag in ("tr", *_CELLS, *_ROW_GROUPS) and len(scopes) > 1:
            if owners[-1] in _CELLS:
                close(owners[-1])
            if tag in ("tr", *_ROW_GROUPS) and stack[-1].tag == "tr":
                pop()
            if tag in _ROW_GROUPS and stack[-1].tag in _ROW_GROUPS:
                pop()
            return
        if stack[-1].tag == "p" and tag in CLOSES_P:
            pop()
        if stack[-1].tag == "p" and len(stack) > 1 and tag in SIBLINGS.get(stack[-2].tag, ()):
            pop()
        if tag in SIBLINGS.get(stack[-1].tag, ()):
            pop()

    while place < size:
        at = source.find("<", place)
        if at < 0:
            at = size
        if at > place:
            say(source[place:at])
        if at >= size:
            break
        m = _OPEN.match(source, at)
        if m is None:
            if source.startswith("<!--", at):
                short = next((x for x in (">", "->") if source.startswith(x, at + 4)), "")
                ending = None if short else _COMMENT_END.search(source, at + 4)
                place = at + 4 + len(short) if short else ending.end() if ending else size
            elif source.startswith("<![CDATA[", at):
                end = source.find("]]>", at)
                say(source[at + 9 : end if end >= 0 else size])
                place = end + 3 if end >= 0 else size
            elif source.startswith(("<!", "<?", "</"), at):
                end = source.find(">", at)
                place = end + 1 if end >= 0 else size
            else:
                say("<")
                place = at + 1
            continue
        tag = m[2].lower()
        found, itself, place = attributes(source, m.end(), missing)
        if found is None:  # the page ends in the tag
            break
        if m[1] and tag != "br":
            if tag in INLINE:
                close_inline(tag)
            elif tag in ("body", "html"):
                while len(stack) > 1 and stack[-1].tag != "body":
                    pop()
            else:
                if tag in ("table", "tr", *_ROW_GROUPS) and owners[-1] in _CELLS:
                    close(owners[-1])
                if scopes[-1][tag] > 0 or tag in SCOPES and tag == owners[-1]:
                    close(tag)
            continue
        if tag in VOID or tag == "br":
            if tag == "hr":
                flush()
            elif tag != "wbr" and not stack[-1].off and not stack[-1].unseen:
                run.append(" ")
            continue
        if tag in RAW:
            ending = _RAW_END[tag].search(source, place)
            place = ending.end() if ending else size
            continue
        if tag in ("html", "head"):
            continue
        off = bool(found) and hidden(found)
        if tag in INLINE:
            if not itself:
                top = stack[-1]
                if tag in ("a", "select"):
                    close_inline(tag)
                unseen = off or tag in UNSEEN
                top.inline.append((tag, unseen))
                top.counts[tag] = top.counts.get(tag, 0) + 1
                top.unseen += unseen
                top.links += tag == "a"
            continue
        if tag == "body":
            if has_body or len(stack) > 1:
                continue
            has_body = True
        implied_ends(tag)
        flush()
        top = stack[-1]
        off = off or top.off or top.unseen > 0 or tag == "dialog" and "open" not in found
        node = top.node
        if not off:
            node = len(page.tags)
            page.tags.append(tag)
            page.hints.append((f"{found.get('class', '')} {found.get('role', '')} {found.get('itemprop', '')}".strip(), found.get("id", "")) if found else ("", ""))
            page.parents.append(top.node)
            page.links.append(0)
            page.chars.append(0)
            page.labels.append(int(found.get("data-label") == "1"))
        if itself and tag not in CLOSES_P:
            continue
        scopes[-1][tag] += 1
        stack.append(_Block(tag, node, off, top.links, scopes[-1]))
        if tag in SCOPES:
            scopes.append(Counter())
            owners.append(tag)
    flush()
    return page


@lru_cache(maxsize=100_000)
def _names(classes: str, ids: str) -> tuple[frozenset[int], frozenset[int], bool, bool, bool]:
    """(families that whole names of class and role are of, those of id, whether a name only holds such a word, whether one is for content, whether one holds a word for content)."""
    strong: list[set[int]] = [set(), set()]
    weak = good = some = False
    for which, names in enumerate((classes, ids)):
        for name in names.split()[:20]:
            parts = [x.lower() for x in _WORDS.findall(name)]
            hit = [x for x in parts if x in _FAMILY]
            if hit and all(x in _FAMILY or x in _PLAIN or x in FOR or x.isdigit() for x in parts) and (parts[-1] not in FOR or hit[0] in ("comment", "comments", "reply")):
                strong[which].update(_FAMILY[x] for x in hit)
            elif hit:
                weak = True
            elif parts and parts[0] not in _STATES and any(x in FOR for x in parts):
                if all(x in FOR or x in _PLAIN or x.isdigit() for x in parts):
                    good = True
                else:
                    some = True
    return frozenset(strong[0]), frozenset(strong[1]), weak, good, some


@lru_cache(maxsize=100_000)
def _static(tag: str, classes: str, ids: str) -> tuple[tuple[int, ...], int]:
    """(features, kind of the edge to the parent) that an element's tag and names give."""
    group = _TAG_GROUP.get(tag, "other")
    place = 0 if group in _TEXT_GROUPS else 1 if group in ("article", "main", "body", "html") else 2
    by_class, by_id, weak, good, some = _names(classes, ids)
    out = [_TAG_NUMBER[group]]
    out += [_AT_CLASS + place * _N_FAMILIES + f for f in by_class] + [_AT_ID + place * _N_FAMILIES + f for f in by_id]
    if weak:
        out.append(_AT_WEAK + place)
    if good:
        out.append(_AT_FOR + place)
    if some:
        out.append(_AT_FOR + len(_PLACES))
    if classes or ids:
        out.append(_AT_FOR + len(_PLACES) + 1)
    kind = "header" if group == "header" else "footer" if group == "footer" else "boilerplate" if group in ("nav", "aside", "form") else "for" if place == 1 or good and not by_class else "against" if by_class and place == 2 else "named" if by_class or by_id else "text" if place == 0 else "plain"
    return tuple(out), _KINDS.index(kind)


def describe(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, feature) of the features that are there, and the kind of each node's edge to its parent."""
    n = len(page.tags)
    own = np.array(page.chars, float)
    total, links = page.chars.copy(), page.links.copy()
    paragraphs, inside, kinds, at, feature = [0] * n, [False] * n, [], [], []
    for i in range(n - 1, 0, -1):
        above = page.parents[i]
        total[above] += total[i]
        links[above] += links[i]
        if page.tags[i] == "p" and page.chars[i] > 40:
            paragraphs[above] += 1
    for i, (tag, (classes, ids), parent) in enumerate(zip(page.tags, page.hints, page.parents, strict=True)):
        found, kind = _static(tag, classes, ids)
        at += [i] * len(found)
        feature += found
        kinds.append(kind)
        inside[i] = tag in ("article", "main") or parent >= 0 and inside[parent]
    cued = sorted({i for i, body in page.text if len(body) < 250 and _CUES.search(body)})
    at += cued
    feature += [_AT_WHERE + (3 if own[i] < 80 else 4) for i in cued]
    rows, chars = np.arange(n), np.array(total, float)
    share = np.where(chars > 0, np.array(links) / np.maximum(chars, 1), 0)
    parts = [
        (rows, _AT_LINKS + np.minimum(3, (share * 4).astype(int))),
        (rows, _AT_TEXT + np.minimum(5, (np.log10(chars + 1) * 1.5).astype(int))),
        (rows, _AT_OWN + np.minimum(5, (np.log10(own + 1) * 2).astype(int))),
        (rows, _AT_SHARE + np.minimum(4, (chars / max(1.0, chars[0]) * 5).astype(int))),
        (rows, _AT_PARAGRAPHS + np.minimum(3, (np.array(paragraphs) + 1) // 2)),
        (rows, np.full(n, _AT_WHERE + 5)),
    ]
    among = np.array(inside)
    parts.append((rows[among], np.full(among.sum(), _AT_WHERE)))
    if among.any():
        parts.append((rows[~among], np.full((~among).sum(), _AT_WHERE + 1)))
    empty = (own == 0) & (chars > 0)
    parts.append((rows[empty], np.full(empty.sum(), _AT_WHERE + 2)))
    outer = np.array([i for i in rows[:3] if own[i] and page.tags[i] in ("html", "body")], int)
    parts.append((outer, np.full(len(outer), _AT_WHERE + 6)))
    return np.concatenate([np.array(at, int), *(a for a, _ in parts)]), np.concatenate([np.array(feature, int), *(f for _, f in parts)]), np.array(kinds)


@dataclass
class Forest:
    """Nodes of several pages, by depth; their features as (node, feature) pairs."""

    at: np.ndarray
    features: np.ndarray
    kinds: np.ndarray
    parents: np.ndarray
    levels: list[np.ndarray]

    @classmethod
    def of(cls, pages: Iterable[Page]) -> Forest:
        at, features, kinds, parents, depths, start = [], [], [], [], [], 0
        for page in pages:
            mine, feature, kind = describe(page)
            depth = [0]
            for p in page.parents[1:]:
                depth.append(depth[p] + 1)
            above = np.array(page.parents) + start
            above[0] = -1
            at.append(mine + start)
            features.append(feature)
            kinds.append(kind)
            parents.append(above)
            depths.append(np.array(depth))
            start += len(depth)
        depth = np.concatenate(depths)
        order = np.argsort(depth, kind="stable")
        return cls(np.concatenate(at), np.concatenate(features), np.concatenate(kinds), np.concatenate(parents), np.split(order, np.flatnonzero(np.diff(depth[order])) + 1))

    @property
    def x(self) -> np.ndarray:
        """node x feature, dense."""
        out = np.zeros((len(self.parents), N_FEATURES))
        out[self.at, self.features] = 1
        return out


@dataclass
class Model:
    """Log potentials: of content (1) against not (0) for each feature, and [kind of edge, parent's label, child's label]."""

    unary: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    pair: np.ndarray = field(default_factory=lambda: np.zeros((EDGE_KINDS, 2, 2)))

    def infer(self, forest: Forest) -> tuple[np.ndarray, np.ndarray, float]:
        """Sum-product upward, then downward: marginals of nodes (n x 2) and of edges (n x parent x child), and the log partition function."""
        n = len(forest.parents)
        up, message = np.zeros((n, 2)), np.zeros((n, 2))
        up[:, 1] = np.bincount(forest.at, self.unary[forest.features], n)
        edge = self.pair[forest.kinds]
        for level in reversed(forest.levels[1:]):
            message[level] = np.logaddexp(edge[level, :, 0] + up[level, 0, None], edge[level, :, 1] + up[level, 1, None])
            np.add.at(up, forest.parents[level], message[level])
        top = forest.levels[0]
        total = np.logaddexp(up[top, 0], up[top, 1]).sum()
        belief, both = np.zeros((n, 2)), np.zeros((n, 2, 2))
        belief[top] = up[top]
        for level in forest.levels[1:]:
            outside = belief[forest.parents[level]] - message[level]
            joint = outside[:, :, None] + edge[level] + up[level, None, :]
            both[level] = joint
            belief[level] = np.logaddexp(joint[:, 0], joint[:, 1])
        belief -= np.logaddexp(belief[:, :1], belief[:, 1:])
        both -= np.logaddexp(np.logaddexp(both[:, 0, 0], both[:, 0, 1]), np.logaddexp(both[:, 1, 0], both[:, 1, 1]))[:, None, None]
        return np.exp(belief), np.exp(both), float(total)


def fit(pages: list[tuple[Page, list[int]]], steps: int = 120, rate: float = 0.15, l2: float = 0.01) -> Model:
    """Maximum likelihood on labelled pages (a label for each node), by Adam on the exact gradient: observed less expected features."""
    forest, labels = Forest.of(p for p, _ in pages), np.concatenate([np.array(y) for _, y in pages])
    model, edges = Model(), np.flatnonzero(forest.parents >= 0)
    kinds, size = forest.kinds[edges], len(pages)
    seen_unary = np.bincount(forest.features, labels[forest.at], N_FEATURES)
    seen_pair = np.bincount(kinds * 4 + labels[forest.parents[edges]] * 2 + labels[edges], minlength=EDGE_KINDS * 4).reshape(EDGE_KINDS, 2, 2)
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (model.unary, model.pair)]
    for step in range(1, steps + 1):
        node, both, _ = model.infer(forest)
        expected = np.stack([np.bincount(kinds, both[edges, a, b], EDGE_KINDS) for a in (0, 1) for b in (0, 1)], axis=1).reshape(EDGE_KINDS, 2, 2)
        gradients = ((seen_unary - np.bincount(forest.features, node[forest.at, 1], N_FEATURES)) / size - l2 * model.unary, (seen_pair - expected) / size - l2 * model.pair)
        for w, g, (m, v) in zip((model.unary, model.pair), gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def labelled_pages(n: int = 700, seed: int = 11) -> list[tuple[Page, list[int]]]:
    """Pages to train on, with a label for each block node: 1 in the article, but for boilerplate that stands in it.

    They are drawn from layouts of the common kinds: semantic elements, divs with names, tables, forms about the whole page, or no container at all; headers, sections, figures, lists, tables, code and notes in
    the article; menus, adverts, notices, forms, related links, comments about it or in it. Names mislead at times: an article's classes, and ids of its headings and sections, hold words that elsewhere name
    boilerplate, and boilerplate may have no name. The label travels in the attribute data-label, of which no feature is made.
    """
    rng = random.Random(seed)
    letters = "aeioubcdfglmnprst"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
    say = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    chance = lambda p: rng.random() < p
    pick = lambda *options: rng.choice(options)
    doubtful = sorted(_FAMILY)
    #: What a heading, a paragraph or an article's section may well be about.
    topics = "legal search share related similar tags tag notice notices comment reply follow advert sponsor promotion menu header footer widget popular subscription alert trending author meta form cookies consent".split()

    def el(tag: str, label: int, body: str, names: str = "", ids: str = "") -> str:
        named = (f' class="{names}"' if names else "") + (f' id="{ids}"' if ids else "")
        return f'<{tag}{named} data-label="{label}">{body}</{tag}>'

    def boiler(tag: str, body: str, *names: str) -> str:
        """With one of these names, as class or id, or with none."""
        name = pick(*names, "") if names else ""
        return el(tag, 0, body, "", name) if chance(0.35) else el(tag, 0, body, f"{name} {word()}".strip() if name and chance(0.3) else name)

    def misleading() -> str:
        """A class that holds such a word, but isn't one."""
        return pick(f"tag-{pick(word(), *doubtful)}", f"category-{pick(*doubtful)}", f"has-{pick(*doubtful)}", f"no-{pick(*doubtful)}", f"{pick(*doubtful)}-{word()}", f"{word()}-{pick(*doubtful)}", f"{pick(*doubtful)}s-open", "type-post", "hentry", word())

    def about() -> str:
        return pick(f"{pick(*topics)}-{word()}", f"{word()}-{pick(*topics)}", pick(*topics), word())

    def links(k: int, label: int = 0) -> str:
        return el(pick("ul", "ol"), label, "".join(el("li", label, f'<a href="/{word()}">{say(1, 3)}</a>') for _ in range(k)))

    def cue(*words: str) -> str:
        return f"{pick(*words)} {say(1, 8)}" if chance(0.6) else say(2, 12)

    def furniture(inside: bool = False) -> str:
        kind = rng.randrange(9 if inside else 13)
        p = lambda a, b: el("p", 0, say(a, b))
        if kind == 0:
            return el("nav", 0, pick(links(rng.randint(2, 9)), el("h2", 0, say(1, 3)) + links(4)), pick("", "menu", "toc"))
        if kind == 1:
            return boiler("div", links(rng.randint(2, 9)), "nav", "menu", "main-menu", "breadcrumb", "navbar", "toc")
        if kind == 2:
            return el("div", 0, pick(say(2, 20), el("p", 0, say(4, 40)), el("p", 0, cue("Advertisement", "Sponsored"))), pick("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement", "ad-container", "banner-ad"), pick("", "", word()))
        if kind == 3:
            return el("aside", 0, pick(say(3, 25), p(3, 40), el("h3", 0, say(1, 3)) + pick(links(4), p(5, 50))), pick("", "", "sidebar", word()))
        if kind == 4:
            return boiler(pick("div", "section"), pick(say(5, 25), p(5, 25), el("p", 0, cue("We use cookies", "cookies"))) + "<button>" + say(1, 2) + "</button>", "cookie-banner", "cookie-notice", "notice", "consent", "alert", "gdpr") if not chance(0.3) else el("div", 0, pick(say(5, 25), p(5, 25)), pick("cookie-banner", "notice", "alert alert-info", "popup", "modal"))
        if kind == 5:
            return el("form", 0, pick("<label>" + say(1, 4) + "</label>", p(2, 10), el("fieldset", 0, say(1, 4)), el("div", 0, say(1, 5))) + "<input>" + "<button>" + say(1, 1) + "</button>", pick("", "search", "newsletter", "subscribe-form"))
        if kind == 6:
            tag = pick("div", "li", "article", "div")
            name = pick("comment", "reply", "comment-body", "comment even thread-even")
            one = lambda: el(tag, 0, pick(p(3, 60), p(3, 40) + p(3, 40), el("div", 0, say(3, 50), pick("", "comment-text")), el("h4", 0, say(1, 2)) + p(3, 40)), name)
            many = "".join(one() for _ in range(rng.randint(1, 6)))
            many = el(pick("ol", "ul"), 0, many, pick("", "comment-list")) if tag == "li" else many
            return el(pick("section", "div"), 0, (el(pick("h2", "h3"), 0, pick(say(1, 3), f"{rng.randint(1, 40)} comments")) if chance(0.7) else "") + many, *(("", pick("comments", "disqus_thread", "respond")) if chance(0.5) else (pick("comments", "comment-list", "comments-area", "responses comments"),)))
        if kind == 7:
            return el(pick("div", "section"), 0, (el("h3", 0, say(1, 3)) if chance(0.4) else "") + links(rng.randint(2, 5)), pick("related", "related-posts", "share", "social", "recommended", "share-buttons", "sharing", "tags", "tag-links"))
        if kind == 8:
            return el("footer", 0, pick(p(2, 12), links(3), say(2, 8)), pick("", "entry-footer", "post-footer", "post-meta"))
        if kind == 9:
            return el("header", 0, pick(say(1, 5), el("div", 0, say(1, 6), pick("", "site-title", "logo")), el("h1", 0, f'<a href="/">{say(1, 3)}</a>'), el("p", 0, say(2, 8))) + (pick(links(4), el("nav", 0, links(5))) if chance(0.5) else ""), pick("", "site-header", "page-header"))
        if kind == 10:
            return el("footer", 0, pick(f"&copy; {say(1, 15)}", p(3, 30), links(3), el("div", 0, links(4)) + p(2, 20)), pick("", "site-footer"))
        if kind == 11:
            return boiler(pick("div", "aside"), el("h3", 0, say(1, 3)) + pick(links(4), p(5, 50), p(5, 30) + links(3)), "sidebar", "side-bar", "widget", "widget-area") if chance(0.8) else el("div", 0, pick(say(1, 15), links(5), p(3, 20)), pick("footer", "header", "site-footer", "masthead", "copyright", "top-bar"))
        return pick(el("noscript", 0, pick("", "Please enable JavaScript ") + say(2, 8)), el("div", 0, "&copy; " + say(2, 10)), el("p", 0, f"Copyright {say(2, 8)}"), el("div", 0, f'<a href="#x">{say(1, 3)}</a>', pick("", "skip-link")))

    def block() -> str:
        kind = rng.random()
        odd = lambda p: (misleading() if chance(p) else "", about() if chance(p) else "")
        text = lambda a, b: say(a, b) + (f' {pick("comments", "cookies", "newsletter", "share this", "copyright")} {say(1, 8)}' if chance(0.06) else "") + (f' <a href="/x">{say(1, 4)}</a> {say(0, 6)}' if chance(0.15) else "")
        if kind < 0.62:
            return el("p", 1, text(1, 90) if chance(0.7) else say(1, 6), *odd(0.06))
        if kind < 0.74:
            return el(pick("h2", "h2", "h3", "h4"), 1, say(1, 7), *odd(0.35))
        if kind < 0.79:
            item = lambda: el("li", 1, pick(text(1, 14), el("p", 1, text(2, 20)), f'<a href="/x">{say(1, 3)}</a> {say(3, 12)}'), *odd(0.03))
            return el(pick("ul", "ol"), 1, "".join(item() for _ in range(rng.randint(2, 6))), *odd(0.08))
        if kind < 0.83:
            return el("blockquote", 1, pick(say(4, 40), el("p", 1, say(4, 40))), *odd(0.08))
        if kind < 0.86:
            return el("div", 1, pick(say(5, 60), el("p", 1, say(1, 60)), el("p", 1, say(5, 60)) + el("p", 1, say(5, 60))), pick("", "", misleading(), "text", word()), pick("", "", about()))
        if kind < 0.89:
            return el("table", 1, "".join(el("tr", 1, "".join(el(pick("td", "td", "th"), 1, say(1, 4)) for _ in range(2))) for _ in range(rng.randint(1, 4))), *odd(0.1))
        if kind < 0.92:
            return el("figure", 1, "<img src=x>" + el("figcaption", 1, say(2, 15)), *odd(0.1))
        if kind < 0.94:
            return el("pre", 1, f"<code>{say(2, 30)}</code>", *odd(0.1))
        if kind < 0.96:
            return el("dl", 1, "".join(el("dt", 1, say(1, 3)) + el("dd", 1, say(2, 15)) for _ in range(rng.randint(1, 3))))
        if kind < 0.97:
            return el("details", 1, el("summary", 1, say(1, 5)) + el("p", 1, say(4, 30)))
        if kind < 0.98:
            return el("noscript", 1, el("p", 1, say(4, 30)))
        return el("section", 1, el("h2", 1, say(1, 6)) + "".join(el("p", 1, say(5, 60)) for _ in range(rng.randint(1, 3))), *odd(0.5))

    def title() -> str:
        heading = el(pick("h1", "h1", "h2"), 1, say(2, 12), pick("", "", "entry-title", misleading()))
        if chance(0.25):
            return el("header", 1, heading + pick("", el("p", 1, say(3, 15)), el("h2", 1, say(2, 10))), pick("", "article-header", "entry-header", "post-header"))
        return heading

    def article() -> str:
        blocks = [title()] if chance(0.8) else []
        for _ in range(rng.choice((1, 2, 3)) if chance(0.3) else rng.randint(1, 12)):
            blocks.append(block() if chance(0.95) else furniture(inside=True))
        if chance(0.2):
            at = rng.randint(0, len(blocks))
            blocks[at:] = [el("section", 1, "".join(blocks[at:]) or block(), misleading() if chance(0.3) else "", about() if chance(0.5) else "")]
        if chance(0.15):
            blocks.append(el("footer", 0, pick(say(2, 10), links(3), el("p", 0, say(2, 20)))))
        if chance(0.1):
            blocks.append(furniture(inside=True))
        return "".join(blocks)

    def names(*good: str) -> str:
        """Of an article or its container: names for content, others, and at times one that speaks against it."""
        some = [pick(*good)] if chance(0.6) else []
        some += [misleading() for _ in range(rng.choice((0, 0, 0, 1, 2, 4)))]
        if some and chance(0.12):
            some.append(pick("legal", "widget", "related", "share", "notice", "search", "promo", "tags", "sponsored", "alert"))
        rng.shuffle(some)
        return " ".join(some)

    out = []
    for _ in range(n):
        kind, holder = rng.random(), 0
        inner = article()
        if kind < 0.4:
            inner = el("article", 1, inner, names("post", "entry", "article"), pick("", "", f"post-{rng.randint(1, 999)}", about()))
            inner = el("main", 0, inner, pick("", "", "site-main")) if chance(0.3) else inner
            if chance(0.1):
                inner += el("article", 1, article(), names("post", "entry"))
        elif kind < 0.57:
            inner = el(pick("div", "section"), 1, inner, pick("content", "article-body", "post-content", "entry-content", "story", "main-content", "post", "body", "text") + (f" {misleading()}" if chance(0.3) else ""), pick("", "", about()))
            if chance(0.1):
                inner = el("article", 1, inner, names("post", "entry"))
        elif kind < 0.66:
            inner = el("main", 1, inner, names("content", "main"), pick("", "content", "main"))
        elif kind < 0.77:
            inner = el("div", 1, inner, pick("", misleading()), pick("", about()))
        elif kind < 0.81:
            inner = el("table", 0, el("tr", 0, el("td", 0, links(5)) + el("td", 1, inner)))
        elif kind < 0.84:
            inner = el(pick("div", "div", "body-text"), 1, "<br><br>".join(say(10, 60) for _ in range(rng.randint(1, 6))))
        elif kind < 0.88:
            holder, inner = 1, "<br><br>".join(say(10, 60) for _ in range(rng.randint(1, 6)))
        else:
            holder = 1
        tiny = chance(0.08)
        if tiny:  # hardly anything, but all of it content
            holder, inner = pick((1, say(1, 6)), (1, el("p", 1, say(1, 3))), (1, el("h1", 1, say(1, 3)) + el("p", 1, say(1, 3))), (0, el(pick("article", "main"), 1, el("p", 1, say(1, 3)))), (0, el("div", 1, el("p", 1, say(1, 3)))))
        most = 0 if holder and len(inner) < 100 or chance(0.12) else 4
        before, after = "".join(furniture() for _ in range(rng.randint(0, most))), "".join(furniture() for _ in range(rng.randint(0, most)))
        body = before + inner + after
        if not holder:
            for _ in range(rng.choice((0, 0, 0, 1, 2, 3))):
                body = el("div", 0, body, pick("", "wrapper", "container", "page", "site", "has-sidebar", "header-fixed", misleading()), pick("", "", "page", "wrapper", "root"))
            if chance(0.04):
                body = el("form", 0, body)
        bare = chance(0.5 if tiny else 0.15)
        page = parse(body if bare else f'<html><body{pick("", "", f" class={chr(34)}{misleading()} {misleading()}{chr(34)}")} data-label="{holder}">{body}</body></html>')
        page.labels[0] = int(bare and holder)
        out.append((page, page.labels))
    return out


def extract(sources: list[str | None], model: Model, least: float = 0.5) -> list[str]:
    """The main text of each page: blocks whose node's marginal of content is `least` or more, in page order, one a line."""
    pages = [parse(x if isinstance(x, str) else "") for x in sources]
    out = []
    for at in range(0, len(pages), 500):
        some = pages[at : at + 500]
        node, _, _ = model.infer(Forest.of(some))
        start = 0
        for page in some:
            content = node[start : start + len(page.tags), 1] >= least
            out.append("\n".join(body for i, body in page.text if content[i]))
            start += len(page.tags)
    return out


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """A row for each row of pages: page_id, url, text, n_chars (code points). model: fit() on labelled pages; by default on labelled_pages().

    Null or empty html, and pages without content, give an empty text and 0. Broken markup is read leniently, as parse() has it: what a tag that never ends, or a comment or script
    that does not, has swallowed is lost, as in browsers. A header in an article is its own, with its title, and stays; the page's goes; so does a footer in either. Hidden elements
    aren't shown and so are no part of the article; text in math, svg, noscript, tables and code is. Repeated rows count each; an empty table gives no rows; other columns play no part.
    """
    model = model or fit(labelled_pages())

    @F.pandas_udf("string")
    def text_of(sources: pd.Series) -> pd.Series:
        return pd.Series(extract(list(sources), model), dtype=object)

    return pages.select("page_id", "url", text_of(F.col("html")).alias("text")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
