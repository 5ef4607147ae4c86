"""Operator 6: main text of web pages as the maximum-scoring subsequence of words and tags.

A page is a sequence of tags and runs of words. Words score by the element that holds them, tags by their
name: running text scores positive, tags and the words of links, menus and marked boilerplate negative. One linear scan finds the
contiguous part with the largest sum. Where most of its words lie in elements that pages use for an article (``article``,
``main``, ``articleBody``), these elements are the region, each of them whole, so lists of links and tables inside stay;
elsewhere the part itself is. The region's text, without elements that are no article text
wherever they stand (menus, forms, adverts, notices, comments and so on), is the result.

The weights come from labelled pages: pages that mark their article (``article``, ``main`` or
``articleBody``) say which tokens lie inside; all of them are counted, and a few counts by hand
(``BY_HAND``) stand in where pages have no marks. A weight is the logarithm of the ratio of inside to
outside counts; tags are held below zero and words of plain paragraphs above.

Defined results: null, empty or textless html gives the empty string. Unclosed and misnested tags
are tolerated. White space inside a block becomes one space, blocks are joined by a line feed.
Repeated rows are extracted alike; other columns of the input are not touched, and an empty table gives no rows. Of equally good
parts the first is taken. Time is linear in the page's length, however many elements are open or nested.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolake.llm.common import as_text

_RAW = "script|style|noscript|template|textarea|svg|iframe|object|title|select|canvas"
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^<>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*)(?P<attributes>(?:[^<>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<[a-zA-Z/!?][^<>]*>?|(?P<text><?[^<]*)""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|["'][^"']*["']?""")
_PARTS = re.compile(r"[a-z]{2,}")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt "
                    "ruby s samp small span strike strong sub sup time tt u var wbr").split())
#: Elements that are never article text; ``header`` only outside an article.
APART = frozenset("nav footer aside form menu dialog button head option datalist fieldset noframes".split())
#: Words of class, id and role attributes that mark no article text: alone, or beside words of layout only.
MARKS = frozenset(("ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion sidebar "
                   "widget menu nav navbar navigation breadcrumb breadcrumbs footer header masthead contentinfo complementary "
                   "comment comments disqus respond replies reply reader cookie cookies consent gdpr notice notices alert newsletter "
                   "subscribe subscription signup login share sharing social related recommended popup modal overlay "
                   "pagination pager toolbar search skip copyright dialog form").split())
#: Words of layout: ``left-sidebar`` and ``comment-list`` are marks, ``has-sidebar`` and ``related-work`` are none.
LAYOUT = frozenset(("area articles article bar block body bottom box btn button buttons center column container content desktop entry "
                    "fixed floating footer global group header icons inner item items js left link links list main mobile module "
                    "outer page panel posts post primary right row secondary section site slot sticky stories title top unit "
                    "wrap wrapper zone").split())
#: Words before ``header`` that make it an article's own.
_OWN_HEADER = frozenset("article entry post content main section".split())
_HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
_CONTENT = frozenset("article main".split())
_CLOSED_BY = {"p": frozenset(("p div ul ol dl table section article aside nav header footer form blockquote pre "
                              "figure h1 h2 h3 h4 h5 h6 hr main").split()),
              "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
              "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
              "option": frozenset(["option"]), "head": frozenset(["body"])}

#: (inside, outside) counts of a few pages labelled by hand: words by holding element, then tags by name.
BY_HAND = {"w:p": (200, 10), "w:div": (40, 20), "w:li": (60, 20), "w:td": (24, 20), "w:a": (5, 120), "w:h": (20, 10),
           "w:apart": (0, 200), "w:other": (30, 20), "w:blockquote": (20, 1), "w:pre": (20, 2), "t:apart": (0, 200),
           "t:p": (40, 5), "t:br": (10, 5), "t:a": (8, 60), "t:li": (20, 40), "t:ul": (6, 12), "t:div": (6, 40),
           "t:section": (3, 5), "t:h1": (3, 1), "t:h2": (4, 3), "t:b": (6, 2), "t:span": (6, 20), "t:nav": (0, 20),
           "t:footer": (0, 20), "t:header": (1, 10), "t:aside": (1, 20), "t:form": (0, 20), "t:td": (3, 10)}
KNOWN_TAGS = frozenset(("p br a li ul ol div section article main h1 h2 h3 h4 h5 h6 b i em strong span nav footer header aside "
                        "form table tr td th blockquote pre code figure figcaption img hr body html head meta link input button").split())
_PARAGRAPH, _TAG = 0.2, -0.2  # least weight of a paragraph's word, most of a tag
_APART = -0.3  # least weight inside elements that are left out anyway: they part regions, but not at once
_LARGEST = 3.0
_TAG_KINDS = {n: f"t:{n}" for n in KNOWN_TAGS}


def _is_mark(token: str) -> bool:
    """Whether a class, id or role names boilerplate as a whole, not just in one of its words."""
    parts = _PARTS.findall(token)
    if "header" in parts and len(parts) > 1 and parts[0] in _OWN_HEADER:
        return False
    return any(w in MARKS for w in parts) and all(w in MARKS or w in LAYOUT for w in parts)


@lru_cache(maxsize=4096)
def _marks(attributes: str, heading: bool = False) -> tuple[bool, bool, bool]:
    """Whether attributes mark an element as apart, as hidden and as an article's body; ids of headings are made from their text."""
    marked = apart = body = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            marked = marked or (not (heading and name == "id") and any(_is_mark(t) for t in value.split()))
        elif name == "itemprop":
            body = body or value == "articlebody"
            marked = marked or value == "comment"
        elif name == "style":
            apart = apart or "display:none" in value.replace(" ", "")
        elif name == "hidden":
            apart = apart or value in ("", "hidden")
        elif name == "aria-hidden":
            apart = apart or value == "true"
    return marked, apart, body


_HOLDERS = {n: f"w:{n}" for n in ("p", "div", "li", "blockquote", "pre", "a", "td")} | {
    "th": "w:td"} | {f"h{i}": "w:h" for i in range(1, 7)}
_CLOSERS = frozenset().union(*_CLOSED_BY.values())
_OUTSIDE = ("", False, False, "w:other")


class _Open:
    """Open elements, and where those of a name and those that are no inline elements stand, so that ending them takes no search."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool, str]] = []  # element, apart, inside an article, class of its words
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, entry: tuple[str, bool, bool, str]) -> None:
        self.places.setdefault(entry[0], []).append(len(self.stack))
        if entry[0] not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(entry)

    def close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.places[self.stack.pop()[0]].pop()
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()

    def end(self, name: str) -> None:
        """Ends the innermost open element of that name and those in it; a stray end tag ends nothing."""
        if self.places.get(name):
            self.close_to(self.places[name][-1])

    def end_before(self, name: str) -> None:
        """Ends the elements that a start tag ends by itself, such as an open paragraph before a list."""
        while self.blocks and name in _CLOSED_BY.get(self.stack[self.blocks[-1]][0], ()):
            self.close_to(self.blocks[-1])


def _add_open(found: set[int], around: list[tuple[int, int]]) -> None:
    """Adds the positions of open elements; those below one that has been added were added with it."""
    for _, at in reversed(around):
        if at in found:
            return
        found.add(at)


def tokens(html: str, regions: list[tuple[int, int]] | None = None) -> list[tuple[str, int, str, bool, bool, bool]]:
    """(class, words, text, is apart, is inside a marked article, begins a block) for each tag and text.

    An element that holds ``main`` is not apart; nor is one that holds an article, unless the page has another article
    outside of all elements that are apart (then it is a list of teasers or comments). Hidden elements always are.
    ``regions`` gets the first and last token (exclusive) of each article element that is not apart.
    """
    held: set[int] = set()
    own: list[tuple[int, int]] = []
    found = list(_tokens(html, frozenset(), held, own))
    if held:
        own.clear()
        found = list(_tokens(html, frozenset(held), set(), own))
    if regions is not None:
        regions += own
    return found


def _tokens(html: str, spared: frozenset[int], held: set[int], regions: list[tuple[int, int]]):
    """The tokens; elements at the positions ``spared`` are not apart. ``held`` gets those that should be spared."""
    elements = _Open()
    stack = elements.stack
    around: list[tuple[int, int]] = []  # (depth, position) of open elements that are apart by themselves
    articles: list[tuple[int, int]] = []  # (depth, first token) of open article elements
    late: set[int] = set()
    hidden_from = -1  # depth of the outermost hidden element
    clean = False
    top = _OUTSIDE
    count = 0
    for m in _TOKEN.finditer(html):
        _, end, name, attributes, text = m.groups()
        if name is None:
            if text:
                text = unescape(text) if "&" in text else text
                words = len(text.split())
                count += 1
                yield ("w:apart" if top[1] else top[3]) if words else "", words, text, top[1], top[2], False
            continue
        name = name.lower()
        if end:
            elements.end(name)
        else:
            if name in _CLOSERS:
                elements.end_before(name)
            if name not in VOID and not attributes.endswith("/"):
                _, was_apart, was_inside, holder = stack[-1] if stack else _OUTSIDE
                marked, hidden, body = _marks(attributes, name in _HEADINGS) if attributes and name not in ("html", "body") else (
                    False, False, False)
                depth = len(stack)
                while around and around[-1][0] >= depth:
                    around.pop()
                while articles and articles[-1][0] >= depth:
                    regions.append((articles.pop()[1], count))
                if hidden_from >= depth:
                    hidden_from = -1
                spare = m.start() in spared
                marked = marked and name != "main" and not spare
                own = marked or (not spare and (name in APART or (name == "header" and not was_inside)))
                if (body or name in _CONTENT) and not (own or hidden) and hidden_from < 0:
                    if not around:
                        clean = True
                    else:
                        _add_open(held if name == "main" else late, around)
                if own:
                    around.append((depth, m.start()))
                if hidden and hidden_from < 0:
                    hidden_from = depth
                if (body or name in _CONTENT) and not (was_apart or own or hidden):
                    articles.append((depth, count))
                elements.push((name, was_apart or own or hidden, (was_inside or body or name in _CONTENT) and not (marked or hidden),
                               _HOLDERS.get(name, holder if name in INLINE else "w:other")))
        while articles and articles[-1][0] >= len(stack):
            regions.append((articles.pop()[1], count))
        top = stack[-1] if stack else _OUTSIDE
        kind = "t:apart" if top[1] else _TAG_KINDS.get(name, "t:other")
        count += 1
        yield kind, 0, " ", top[1], top[2], name not in INLINE
    regions += [(first, count) for _, first in articles]
    if not clean and not held:
        held.update(late)


def _count(htmls: pa.Array) -> Counter:
    counts: Counter = Counter()
    for html in htmls.to_pylist():
        found = tokens(html)
        if any(inside for *_, inside, _ in found):
            for kind, words, _, apart, inside, _ in found:
                if kind:
                    counts[kind, inside and not apart] += words or 1
    return counts


def learn_weights(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Weight of each token class, from all pages that mark their article; there is a fixed number of classes."""
    def read(batches):
        counts: Counter = Counter()
        for batch in batches:
            counts += _count(batch.column(0))
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in counts]), pa.array([i for _, i in counts]), pa.array(counts.values(), pa.int64())],
                names=["kind", "inside", "many"])

    rows = (pages.select(as_text(html).alias("html")).mapInArrow(read, "kind string, inside boolean, many long")
            .groupBy("kind", "inside").agg(F.sum("many").alias("many")).collect())
    counts = {k: list(v) for k, v in BY_HAND.items()}
    for r in rows:
        counts.setdefault(r["kind"], [0, 0])[0 if r["inside"] else 1] += r["many"]
    weights = {}
    for kind, (inside, outside) in counts.items():
        w = max(-_LARGEST, min(_LARGEST, log((inside + 1) / (outside + 1))))
        weights[kind] = min(w, _TAG) if kind.startswith("t:") else w
    for kind in ("w:apart", "t:apart"):
        weights[kind] = max(weights[kind], _APART)
    for kind in ("w:p", "w:blockquote", "w:pre", "w:h"):
        weights[kind] = max(weights[kind], _PARAGRAPH)
    return weights


def best_span(scores: list[float]) -> tuple[int, int]:
    """The contiguous part with the largest positive sum; of equal ones the one that ends first, as long as it can be."""
    best, span, total, begin = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        total += score
        if total < 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, span = total, (begin, i + 1)
    return span


def _region(found: list, span: tuple[int, int], articles: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a page that belong to its best span: the article elements with most of its words, or the span itself."""
    of, open_, total, within = set(), [], 0, 0
    starts: dict[int, list[tuple[int, int]]] = {}
    for first, last in articles:
        starts.setdefault(first, []).append((last, first))
    for i in range(span[1]):
        while open_ and open_[-1][0] <= i:
            open_.pop()
        open_ += sorted(starts.get(i, ()), reverse=True)  # the widest first
        _, words, _, apart, *_ = found[i]
        if i >= span[0] and words and not apart:
            total += words
            if open_:
                within += words
                of.add(open_[-1][::-1])
    if not of or 2 * within <= total:
        return [span]
    merged: list[tuple[int, int]] = []
    for first, last in sorted(of, key=lambda r: (r[0], -r[1])):
        if not merged or first >= merged[-1][1]:
            merged.append((first, last))
    return merged


def main_text(html: str, weights: dict[str, float]) -> str:
    """Text of the region around the best contiguous part."""
    articles: list[tuple[int, int]] = []
    found = tokens(html, articles)
    span = best_span([weights.get(kind, weights["w:other"] if words else _TAG) * (words or 1) if kind else 0.0
                      for kind, words, *_ in found])
    blocks = []
    for first, last in _region(found, span, articles):
        part: list[str] = []
        for kind, words, text, apart, _, block in found[first:last]:
            if block:
                blocks.append("".join(part))
                part = []
            elif not apart:
                part.append(text if words or not kind or kind == "t:br" else "")
        blocks.append("".join(part))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def extract_text(pages: DataFrame, weights: dict[str, float], html: str = "html", key: str = "page_id",
                 url: str = "url") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    def extract(htmls: pa.Array) -> pa.Array:
        return pa.array([main_text(h or "", weights) for h in htmls.to_pylist()], pa.string())

    out = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                       F.arrow_udf(extract, "string")(as_text(html)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
