"""Main text of web pages: a minimum cut between blocks that look like content and the rest."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",
    re.S,
)
_HEAD_END = re.compile(r"</head\s*>|<body\b", re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
#: Their content is not text of the page.
SKIPPED = {"script", "style", "noscript", "template", "svg", "head", "title", "iframe", "object", "canvas",
           "textarea", "select", "math", "audio", "video"}
#: What can stand in a head; anything else ends it.
HEADED = {"base", "basefont", "bgsound", "link", "meta", "title", "style", "script", "noscript", "template",
          "head", "html"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: An opening one of these closes an open one.
CLOSED_BY = {
    "p": {"p", "div", "article", "section", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6",
          "footer", "header", "nav", "aside", "form", "blockquote", "pre", "main", "hr", "address",
          "fieldset", "dl", "figure"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"},
}
#: Log-odds of being content, by element and by part of a class, id or role.
TAG_COST = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -8.0, "form": -9.0,
            "header": -5.0, "button": -9.0, "label": -5.0, "dialog": -8.0, "menu": -8.0,
            "fieldset": -6.0, "figcaption": -0.5}
NAME_COST = {
    **dict.fromkeys("article content story entry main post prose".split(), 1.5),
    **dict.fromkeys(
        "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
        "cookie cookies copyright disqus dropdown foot footer gdpr header legal login masthead menu "
        "modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
        "promotion recommended related reply replies search share sharing sidebar signup skip social "
        "sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split(), -8.0,
    ),
}
BLOCK_COST = {"p": 1.0, "blockquote": 1.0, "pre": 1.0, "h1": 0.8, "h2": 0.6, "h3": 0.6, "li": -0.3}
#: Strength of the edges between neighbours, and what a shared parent adds.
NEXT, SIBLING = 0.5, 0.7
#: An element with this share of a page's text is the page, whatever it is called.
WHOLE = 0.9


class Block:
    __slots__ = ("text", "links", "tag", "prior", "parent", "path")

    def __init__(self, text, links, tag, prior, parent, path):
        self.text, self.links, self.tag, self.prior = text, links, tag, prior
        self.parent, self.path = parent, path


def element_cost(tag: str, attributes: str, inside: float, named: bool = True) -> float:
    """What an element adds to the log-odds of all in it; content cues don't undo others.

    Classes of html and body tell of the whole page. ``named``: whether the element's do of its text.
    """
    if tag in ("html", "body"):
        return 0.0
    cost = TAG_COST.get(tag, 0.0)
    if tag == "header" and inside > 2:
        cost = -1.0
    if attributes and not named:
        # What hides it still counts, but not as a class.
        attributes = _NAMES.sub("", attributes)
    if attributes:
        if _HIDDEN.search(attributes):
            cost -= 8.0
        parts = {p.lower() for m in _NAMES.finditer(attributes) for g in m.groups() if g for p in _PART.findall(g)}
        costs = [NAME_COST[p] for p in parts if p in NAME_COST]
        if costs:
            cost += min(costs) if min(costs) < 0 else max(costs)
    return cost


def wholes(blocks: list[Block], elements: list[tuple[str, str, int]]) -> set[int]:
    """Elements with nearly all of the page's text, unless the article or heading is outside."""
    size, proper, heads = Counter(), Counter(), Counter()
    for block in blocks:
        inside = any(elements[e][0] in ("article", "main") for e in block.path)
        for e in {-1, *block.path}:
            size[e] += len(block.text)
            proper[e] += inside
            heads[e] += block.tag == "h1"
    return {
        e for e in size
        if size[e] >= WHOLE * size[-1] and proper[e] == proper[-1] and (proper[e] or heads[e] or not heads[-1])
    }


def blocks_of(page: str) -> list[Block]:
    """Stretches of text between block elements, in page order, with where they lie.

    Unclosed and misplaced tags, comments and entities are taken as browsers do, roughly: an end
    tag closes up to its element if that is open, and is ignored if not.
    """
    out: list[Block] = []
    stack = [("html", 0)]
    elements = [("html", "", 0)]
    buffer: list[str] = []
    links = at = 0
    in_link = False
    skip = ""

    def flush():
        nonlocal links
        text = " ".join("".join(buffer).split())
        if text:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), 0)
            tag, own = stack[place]
            parent = stack[place - 1][1] if tag in BLOCK_COST and place else own
            out.append(Block(text, links, tag, 0.0, parent, [s[1] for s in stack[: place + 1]]))
        buffer.clear()
        links = 0

    def say(piece):
        nonlocal links
        if "&" in piece:
            piece = html.unescape(piece)
        buffer.append(piece)
        if in_link:
            links += len(piece.strip())

    for m in _MARKUP.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            if skip and page[at : m.start()].strip():
                skip = ""
            if not skip:
                say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if skip:
            if closing or tag in HEADED:
                if closing and tag == skip:
                    skip = ""
                elif not closing and tag in SKIPPED and tag != skip:
                    end = re.compile(rf"</{tag}\s*>", re.I).search(page, at) or _HEAD_END.search(page, at)
                    at = len(page) if not end else end.end() if end[0][2:].lower().startswith(tag) else end.start()
                continue
            skip = ""
        if tag not in INLINE:
            flush()
        if tag in SKIPPED:
            if not closing:
                if tag == "head":
                    skip = tag
                else:
                    end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                    at = end.end() if end else len(page)
        elif closing:
            if tag == "a":
                in_link = False
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
        elif tag in VOID:
            if tag in ("br", "hr"):
                buffer.append(" ")
        else:
            if tag not in INLINE:
                # An inline element left open ends with its block.
                while len(stack) > 1 and (stack[-1][0] in INLINE or tag in CLOSED_BY.get(stack[-1][0], ())):
                    stack.pop()
                in_link = False
            elif tag == "a":
                in_link = True
            elements.append((tag, m[3] or m[6] or "", stack[-1][1]))
            stack.append((tag, len(elements) - 1))
    if at < len(page) and not (skip and not page[at:].strip()):
        say(page[at:])
    flush()
    whole, priors = wholes(out, elements), [0.0]
    for i, (tag, attributes, parent) in enumerate(elements[1:], 1):
        priors.append(priors[parent] + element_cost(tag, attributes, priors[parent], i not in whole))
    for block in out:
        block.prior = priors[block.path[-1]]
    return out


def log_odds(block: Block) -> float:
    """That a block is content, from where it lies, its length, links and ending."""
    size = len(block.text)
    score = max(min(block.prior, 5.0), -9.0) + BLOCK_COST.get(block.tag, 0.0) - 1.0
    score += 0.6 * min(math.log1p(size / 40), 3.0) - 4.0 * min(block.links / size, 1.0)
    if block.text[-1] in ".!?\"'”’»…:":
        score += 0.4
    if size < 200 and ("©" in block.text or "rights reserved" in block.text.lower()):
        score -= 3.0
    return score


def source_side(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes the minimum cut leaves with the source.

    A node's score is its capacity from the source, or, if negative, to the sink; edges carry their
    weight both ways. Flow is pushed along shortest paths, level by level, until none is left.
    """
    n = len(scores)
    to: list[int] = []
    room: list[float] = []
    near: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append(len(to))
        to.append(b)
        room.append(w)
        near[b].append(len(to))
        to.append(a)
        room.append(w)
    supply = [max(s, 0.0) for s in scores]
    demand = [max(-s, 0.0) for s in scores]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i] > tiny)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            a = queue.popleft()
            reached = reached or demand[a] > tiny
            for e in near[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        next_edge = [0] * n
        for start in range(n):
            if supply[start] <= tiny:
                continue
            path: list[int] = []
            a = start
            while True:
                if demand[a] > tiny:
                    flow = min([supply[start], demand[a], *(room[e] for e in path)])
                    supply[start] -= flow
                    demand[a] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    if supply[start] <= tiny:
                        break
                    path, a = [], start
                    continue
                while next_edge[a] < len(near[a]):
                    e = near[a][next_edge[a]]
                    if room[e] > tiny and level[to[e]] == level[a] + 1:
                        break
                    next_edge[a] += 1
                else:
                    if not path:
                        break
                    a = to[path.pop() ^ 1]
                    next_edge[a] += 1
                    continue
                path.append(near[a][next_edge[a]])
                a = to[path[-1]]


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours on the page, by how much of their paths they share, and siblings."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            other = blocks[i - 1]
            shared = 0
            for x, y in zip(block.path, other.path):
                if x != y:
                    break
                shared += 1
            edges.append((i - 1, i, NEXT * shared / max(len(block.path), len(other.path))))
        if block.parent in last:
            edges.append((last[block.parent], i, SIBLING))
        last[block.parent] = i
    return edges


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by empty lines; empty if there are none."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    keep = source_side([log_odds(b) for b in blocks], edges_of(blocks))
    return "\n\n".join(b.text for b, kept in zip(blocks, keep) if kept)


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per row: id, url, text (empty if none) and n_chars (its code points).

    A null or empty page has no text. Character references are decoded, white space within a
    block is one space, blocks are joined by an empty line; nothing is cut, however long. Rows are
    independent: repeated rows, null ids and urls pass through; other columns are not read.
    """
    rows = pages.select(id_col, url_col, html_col)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2])

    def extracted(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                [id_col, url_col, "text", "n_chars"],
            )

    return rows.mapInArrow(extracted, f"{kinds}, text string, n_chars bigint")
