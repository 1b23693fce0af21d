"""Main text of web pages by composite text density.

For every DOM node the link-adjusted density is characters per tag, weighted down the
more of them stand in links; a node's density sum adds its children's densities.  The
node of the largest sum holds the article.  The least density on its path to the body is
the threshold: what else stands in the same article is kept if it is as dense or not mostly
links; without an article, what else stands in the body if it is a heading beside the subtree,
or as dense, by composite or plain characters per tag, and not mostly links.

Names don't decide, they weigh: an element whose tag, role, class or id speaks of a menu,
header, footer, sidebar, notice, advert, form or reader comments counts a fiftieth
(``NAMED``) of its density, unless the densest text itself stands in it.  Only what is never
shown as text has no density at all: scripts, styles, controls, hidden elements.

Defined results
---------------
* null or empty html, or a page without text: ``""`` and 0 characters.
* a page is processed whole, whatever its length and depth: nothing is recursive, and each
  tag costs the same however many elements are open.
* unclosed and misnested tags: paragraphs, list items and cells end where HTML says.
* repeated rows are processed alike; an empty table gives an empty result; extra columns
  are kept by ``extract``, which adds main_text under a free name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never shown as text; and elements that seldom hold an article's.
GONE = frozenset("head title script style noscript template button select textarea iframe svg canvas object audio video".split())
BESIDE = frozenset("nav footer aside form dialog menu".split())
#: The share of its density that a named block counts.
NAMED = 0.02
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: An open element of the first kind ends when one of the second kind starts.
ENDS = {
    "p": frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
#: Elements that hold implied ends within themselves.
SCOPE = frozenset("html body div article section main table ul ol dl td th blockquote header footer aside nav form button object".split())
#: Elements that hold one block of text; the subtree chosen is the one around them.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead pre figcaption caption address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidebars aside comment comments commentlist disqus respond reply replies "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription social share sharing related recommended breadcrumb breadcrumbs pagination pager "
    "menu menus nav navbar navigation topbar toolbar footer masthead login signup signin search widget widgets skip hidden".split()
)
#: Only noise where the name doesn't also speak of the article.
WEAK = frozenset(["header", "head", "meta", "byline"])
OWN = frozenset("article post entry content main story body page".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in GONE:
        return True
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and (value or "").lower() == "true") or (name == "style" and _HIDDEN.search(value or "")):
            return True
    return False


def _named(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in BESIDE:
        return True
    for name, value in attrs:
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            names = {x.lower() for x in _NAME.findall(value or "")}
            if names & NOISE or (names & WEAK and not names & OWN):
                return True
        elif name == "role" and (value or "").lower() in ROLES:
            return True
    return False


class Dom(HTMLParser):
    """Nodes as parallel lists, in document order; parents come before children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.gone, self.top = ["#root"], [-1], [False], [False]
        self.weight = [1.0]  # NAMED at and below a named element
        self.within = [False]  # in an article or main, at any depth
        self.open = [0]
        self.stops = []  # places in ``open`` of elements that may end by implication or hold such ends
        self.places: dict[str, list[int]] = {}  # tag -> its places in ``open``
        self.walls = []  # places in ``open`` beyond which an inline end tag has no effect
        self.events: list[tuple[int, str | None]] = []  # a node's text, or None where a block begins or ends

    def handle_starttag(self, tag, attrs):
        self._end_implied(tag)
        up = self.open[-1]
        weight = NAMED if self.weight[up] < 1 or _named(tag, attrs) or (tag == "header" and not self.within[up]) else 1.0
        self.tag.append(tag), self.parent.append(up), self.gone.append(self.gone[up] or _hidden(tag, attrs)), self.weight.append(weight)
        self.top.append(tag == "header" or self.top[up])  # in a header of the article, where headings alone are kept
        self.within.append(tag in ("article", "main") or self.within[up])
        node = len(self.tag) - 1
        if tag == "br":
            self.events.append((up, " "))
        elif tag not in INLINE:
            self.events.append((node, None))
        if tag not in VOID:
            place = len(self.open)
            self.open.append(node)
            self.places.setdefault(tag, []).append(place)
            if tag in ENDS or tag in SCOPE:
                self.stops.append(place)
            if tag in ("article", "main", "body"):
                self.walls.append(place)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _end_implied(self, tag):
        for k in range(len(self.stops) - 1, -1, -1):
            at = self.tag[self.open[self.stops[k]]]
            if tag in ENDS.get(at, ()):
                self._pop(self.stops[k])
                return self._end_implied(tag) if at in ("td", "th") and tag == "tr" else None
            if at in SCOPE:
                return None

    def _pop(self, k):
        for node in self.open[k:]:
            if self.tag[node] not in INLINE:
                self.events.append((node, None))
                break
        for node in self.open[k:]:
            self.places[self.tag[node]].pop()
        del self.open[k:]
        for places in (self.stops, self.walls):
            while places and places[-1] >= k:
                places.pop()

    def handle_endtag(self, tag):
        if places := self.places.get(tag):
            if not (tag in INLINE and self.walls and self.walls[-1] > places[-1]):
                self._pop(places[-1])

    def handle_data(self, data):
        self.events.append((self.open[-1], data))


def densities(dom: Dom) -> tuple[list[float], list[float], list[float]]:
    """(composite densities, plain characters per tag, share of the characters in links).

    A named block counts by its weight in the elements around it, and in full within itself.
    """
    n = len(dom.tag)
    tag, parent, gone, weight = dom.tag, dom.parent, dom.gone, dom.weight
    link = [False] * n
    for i in range(1, n):
        link[i] = link[parent[i]] or tag[i] == "a"
    chars, tags, link_chars, link_tags = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for node, text in dom.events:
        if text is not None and not gone[node]:
            m = len("".join(text.split()))
            chars[node] += m
            if link[node]:
                link_chars[node] += m
    for i in range(n - 1, 0, -1):
        p = parent[i]
        if not gone[i]:
            part = weight[i] / weight[p]
            chars[p] += part * chars[i]
            tags[p] += part * (tags[i] + 1)
            link_chars[p] += part * link_chars[i]
            link_tags[p] += part * (link_tags[i] + (tag[i] == "a"))
    share = link_chars[0] / (chars[0] or 1)

    def composite(i: int) -> float:
        c, t, lc, lt = chars[i], tags[i] or 1, link_chars[i], link_tags[i]
        if gone[i] or not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0) + 1) / max(math.log(base), 0.1)

    plain = [c / (t or 1) for c, t in zip(chars, tags)]  # unlike the composite one it doesn't grow with a block's size
    return [composite(i) for i in range(n)], plain, [lc / (c or 1) for c, lc in zip(chars, link_chars)]


def _select(dom: Dom) -> list[bool]:
    """Which nodes' texts are the article's."""
    n = len(dom.tag)
    tag, parent, gone, weight = dom.tag, dom.parent, dom.gone, dom.weight
    for i in range(1, n):
        if dom.top[i] and weight[i] == 1 and not gone[i] and tag[i] not in HEADINGS and tag[i] != "header":
            gone[i] = tag[parent[i]] == "header" and tag[i] not in ("div", "hgroup") or gone[parent[i]]
    dense, plain, linked = densities(dom)
    total = [0.0] * n
    for i in range(1, n):
        total[parent[i]] += weight[i] * dense[i]
    best = max((i for i in range(n) if not gone[i]), key=lambda i: (total[i], -i), default=0)
    if not total[best]:  # text without any element around it
        best = 0
    while best and (tag[best] in INLINE or tag[best] in LEAF):
        best = parent[best]
    least, thin, at, home, body, path = dense[best], plain[best], best, None, 0, set()
    while at > 0:
        if not body:
            least, thin = min(least, dense[at]), min(thin, plain[at])
        if tag[at] in ("article", "main") and not body:
            home = at
        body = body or (at if tag[at] == "body" else 0)
        at = parent[at]
        path.add(at)
    keep, near, beside, cut = [False] * n, [False] * n, [False] * n, [False] * n
    keep[best] = True
    near[home if home is not None else body] = True
    beside[parent[best] if best else 0] = True
    for i in range(1, n):
        p = parent[i]
        near[i], beside[i], cut[i] = near[i] or near[p], beside[i] or beside[p], cut[p]
        if i == best or i in path:
            continue
        own = min(1.0, weight[i] / weight[best])
        if weight[i] < weight[p]:  # a named block
            cut[i] = cut[i] or own * dense[i] < least or linked[i] > 0.5
        if cut[i]:
            continue
        if keep[p]:
            keep[i] = True
        elif near[p]:
            if home is not None:
                keep[i] = own * dense[i] >= least or linked[i] <= 0.5
            else:
                keep[i] = beside[i] and tag[i] in HEADINGS or (own * dense[i] >= least or own * plain[i] >= thin) and linked[i] <= 0.5
    if home is not None:
        for node in path:  # text of the article's own nodes around the subtree
            keep[node] = keep[node] or near[node]
    return [k and not g for k, g in zip(keep, gone)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    dom = Dom()
    dom.feed(html)
    dom.close()
    keep = _select(dom)
    blocks, now = [], []
    for node, text in dom.events:
        if text is None:
            if now:
                blocks.append(" ".join("".join(now).split()))
                now = []
        elif keep[node]:
            now.append(text)
    blocks.append(" ".join("".join(now).split()))
    return "\n\n".join(b for b in blocks if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column(0).to_pylist()]
        yield pa.record_batch([*batch.columns[1:], pa.array(texts, pa.string())], names=[*batch.schema.names[1:], "main_text"])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the column main_text, the last one."""
    named = pages.select(F.col(html).alias("h"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(pages.columns)])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema[1:])
    return named.mapInArrow(_extract, f"{fields}, main_text string").toDF(*pages.columns, column_of(pages, "main_text"))


def page_texts(pages: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    own = pages.select(F.col("html").alias("_h"), "page_id", "url")
    out = own.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, main_text string")
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
