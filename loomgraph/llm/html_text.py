"""Main-text extraction by minimum-cut labelling of text blocks.

A page is cut into blocks at block-level tags. Each block has a price for being called boilerplate and
one for being called content, from a linear classifier over its tags, class and id tokens, length
and links: these are its capacities to the two terminals. Neighbours in page order, and blocks under one
parent (through a node of that parent, and of its parents), are joined by smoothness capacities. Max-flow (Dinic) gives the
cheapest labelling; blocks on the source side are the main text, joined in page order.

Capacities are log-odds. A smoothness capacity is log((1 - e) / e) for the share e of neighbours of that
kind that differ in label: one in eight of adjacent siblings, one in four of a parent's children, four in
ten of other neighbours. So a short line or a line of links between paragraphs follows them, and a lone
sentence among links follows the links. An element that names a kind of boilerplate (nav, footer, a class
token like `comments` or `cookie-banner`) fences its blocks off: across a fence neighbours hardly count.

A class token names a kind by its last word, container words (`list`, `box`, `item`) left aside:
`comment-list` is comments, `legal-news` is news, `comments-open` and `has-sidebar` are states of a page.

Each page is worked on alone, so memory is bounded by a page. Defined results: null or empty html, or a
page without text: empty text, n_chars 0. Repeated rows give equal rows; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import deque
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|aria-label|hidden|itemprop|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never text of the page: code, styles, what isn't rendered, and controls of forms.
DEAD = frozenset("script style noscript template iframe select option datalist textarea button title head".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element of the first kind ends when one of the others starts.
ENDS = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
FENCE = frozenset("article aside body div footer form header main nav ol section table td th ul".split())
BAD_TAGS = {"nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "search": -9.0, "fieldset": -6.0, "address": -1.0}
GOOD_TAGS = {"article": 5.0, "main": 4.0}
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners sponsor sponsored promo promos promotion promoted cookie cookies consent gdpr notice notices "
    "alert toast menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars rail footer comment comments commentlist disqus respond reply replies discussion share sharing social "
    "related recommended recommendation popup modal overlay newsletter subscribe subscription signup login widget widgets pagination pager skip toolbar masthead copyright legal".split()
)
GOOD_WORDS = frozenset("article content post entry main story body text prose".split())
#: Words of a class token that say how its element is made or where it stands, not what is in it.
CONTAINERS = frozenset(
    "area bar block body bottom box button buttons card col column container content fixed global group holder icon info inner inline item items label large left link links list main "
    "message mobile outer panel primary right row secondary section site slot small sticky text thread title top unit wrap wrapper".split()
)
#: First words that name the kind whatever they stand before: `related-posts`.
KINDS = frozenset("related recommended recommendation sponsored promoted promo advert advertisement advertising".split())
#: First words of a token that says which state a page is in.
STATES = frozenset("has with without no is show hide not".split())
#: Capacities, as log-odds: adjacent siblings, children of one parent, other neighbours, neighbours across a fence.
SIBLINGS, FAMILY, NEXT, ACROSS = 1.95, 1.1, 0.4, 0.05
_SCALE = 100


class _Element:
    """score: log-odds that its text is content; fence: the nearest element around it that names a kind of boilerplate."""

    __slots__ = ("dead", "fence", "index", "parent", "score", "tag", "within")

    def __init__(self, tag, parent, score, within, dead, index, fence):
        self.tag, self.parent, self.score, self.within, self.dead, self.index, self.fence = tag, parent, score, within, dead, index, fence


def token_says(token: str, within: bool) -> tuple[bool, bool, bool]:
    """(names a kind of boilerplate, mentions one, names content) of one token of a class or id attribute."""
    words = [w.lower() for w in _WORD.findall(token) if len(w) > 1]
    bad = [w for w in words if w in BAD_WORDS or w == "header" and not within]
    if not bad:
        return False, False, any(w in GOOD_WORDS for w in words)
    while len(words) > 1 and words[-1] in CONTAINERS:
        words.pop()
    named = words[-1] in bad and words[0] not in STATES and not (words[-1] == "header" and GOOD_WORDS & set(words))
    named = named or words[0] in KINDS
    return named, not named, False


def _element(tag: str, attrs: str, parent: _Element, index: int) -> _Element:
    score, dead, fenced = 0.0, tag in DEAD, False
    within = parent.within or tag in GOOD_TAGS
    if tag in BAD_TAGS:
        score += BAD_TAGS[tag]
        fenced = BAD_TAGS[tag] <= -6.0
    elif tag == "header" and not parent.within:
        score -= 9.0
        fenced = True
    elif tag in GOOD_TAGS:
        score += GOOD_TAGS[tag]
    if attrs:
        tokens: list[str] = []
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), a or b or c
            if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                dead = True
            elif name == "role":
                if value.lower() in BAD_ROLES:
                    score -= 9.0
                    fenced = True
                elif value.lower() in ("main", "article"):
                    score += 4.0
                    within = True
            elif name in ("class", "id"):
                tokens += value.split()
            elif name == "itemprop" and value.lower() == "articlebody":
                score += 5.0
                within = True
        if tokens and tag not in ("html", "body", "main"):
            said = [token_says(t, within) for t in tokens]
            if any(named for named, _, _ in said):
                score -= 9.0
                fenced = True
            else:
                score += 2.0 * any(good for _, _, good in said) - 1.5 * any(mentions for _, mentions, _ in said)
    return _Element(tag, parent, parent.score + score, within, parent.dead or dead, index, index if fenced else parent.fence)


def blocks(html: str) -> list[tuple[str, float, int, _Element]]:
    """(text, share of it in links, words, element) of each block, in page order."""
    root = top = _Element("", None, 0.0, False, False, 0, 0)
    out: list = []
    parts: list[str] = []
    linked, count, links = 0, 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text and not top.dead:
                out.append((text, min(1.0, linked / len(text)), text.count(" ") + 1, top))
            parts.clear()
        linked = 0

    def add(text):
        nonlocal linked
        if text and not top.dead:
            parts.append(text)
            if links:
                linked += len(text)

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[1] or m[4])
        attrs = m[3] or m[6] or ""
        if tag == "a":
            links = 0 if closing else 1
            continue
        known = tag in BLOCK or tag in DEAD or tag in FENCE
        if not known and ("class" in attrs or "id" in attrs or "hidden" in attrs or "style" in attrs or "-" in tag):
            known = "-" in tag or tag == "span" and bool(re.search(r"hidden|display\s*:\s*none", attrs, re.I))
        if not known and not (closing and ("-" in tag or tag == "span")):
            continue
        if tag in BLOCK:
            flush()
        if closing:
            e = top
            while e.parent and e.tag != tag and not (e.tag in FENCE and tag not in FENCE):
                e = e.parent
            if e.parent and e.tag == tag:
                flush()
                top = e.parent
            continue
        if tag in VOID:
            continue
        while top.parent and tag in ENDS.get(top.tag, ()):
            flush()
            top = top.parent
        if attrs.endswith("/") and tag in DEAD:
            continue
        flush()
        count += 1
        top = _element(tag, attrs, top, count)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(html, at)
            at = end.start() if end else n
    flush()
    return out


def costs(block) -> float:
    """The classifier's log-odds that the block is content."""
    text, linked, words, e = block
    score = e.score + 0.6 * math.log(words + 1) - 1.5 - 4.0 * linked
    if e.tag in ("p", "blockquote", "pre", "h1", "h2", "h3", "h4"):
        score += 1.0
    if not e.within and words < 6 and not re.search(r"[.!?…]$", text):
        score -= 1.0
    return max(-12.0, min(12.0, score))


class Flow:
    """Dinic's max-flow on integer capacities."""

    def __init__(self, n: int):
        self.to: list[int] = []
        self.cap: list[int] = []
        self.of: list[list[int]] = [[] for _ in range(n)]

    def edge(self, a: int, b: int, there: int, back: int = 0) -> None:
        self.of[a].append(len(self.to))
        self.to.append(b)
        self.cap.append(there)
        self.of[b].append(len(self.to))
        self.to.append(a)
        self.cap.append(back)

    def levels(self, s: int) -> list[int]:
        level = [-1] * len(self.of)
        level[s] = 0
        todo = deque([s])
        while todo:
            u = todo.popleft()
            for e in self.of[u]:
                if self.cap[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[u] + 1
                    todo.append(self.to[e])
        return level

    def run(self, s: int, t: int) -> list[bool]:
        """Push the maximum; returns the side of s of the minimum cut."""
        while (level := self.levels(s))[t] >= 0:
            at, path = [0] * len(self.of), []
            u = s
            while True:
                if u == t:
                    least = min(self.cap[e] for e in path)
                    for e in path:
                        self.cap[e] -= least
                        self.cap[e ^ 1] += least
                    u, path = s, []
                    continue
                while at[u] < len(self.of[u]):
                    e = self.of[u][at[u]]
                    if self.cap[e] and level[self.to[e]] == level[u] + 1:
                        break
                    at[u] += 1
                if at[u] < len(self.of[u]):
                    path.append(self.of[u][at[u]])
                    u = self.to[path[-1]]
                elif path:
                    u = self.to[path.pop() ^ 1]
                    at[u] += 1
                else:
                    break
        return [x >= 0 for x in level]


def label(found: list) -> list[bool]:
    """Whether each block is content: the minimum cut."""
    n = len(found)
    if not n:
        return []
    odds = [costs(b) for b in found]
    homes: dict[int, tuple[int, _Element]] = {}
    for b in found:
        p = b[3].parent or b[3]
        while p and p.index not in homes:
            homes[p.index] = (n + 2 + len(homes), p)
            p = p.parent
    g, s, t = Flow(n + 2 + len(homes)), n, n + 1
    for node, p in homes.values():  # a parent leans to what its own parent is
        if p.parent:
            tie = round(_SCALE * (FAMILY if p.fence == p.parent.fence else ACROSS))
            g.edge(node, homes[p.parent.index][0], tie, tie)
    for i, (b, x) in enumerate(zip(found, odds, strict=True)):
        c = round(abs(x) * _SCALE)
        if x >= 0:
            g.edge(s, i, c)
        else:
            g.edge(i, t, c)
        e = b[3]
        p = e.parent or e
        tie = round(_SCALE * (FAMILY if e.fence == p.fence else ACROSS))
        g.edge(i, homes[p.index][0], tie, tie)
        if i:
            a = found[i - 1][3]
            near = ACROSS if a.fence != e.fence else SIBLINGS if (a.parent or a).index == p.index else NEXT
            near = round(_SCALE * near)
            g.edge(i - 1, i, near, near)
    return g.run(s, t)[:n]


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    return " ".join(b[0] for b, keep in zip(found, label(found), strict=True) if keep)


def _run(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_run, "page_id long, url string, text string, n_chars long")
