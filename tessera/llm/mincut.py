"""Main text of web pages by minimum-cut labelling (operator 12).

A page is cut into blocks: the text between two tags that break a line. Each
block has a linear score from its tags and their names (``NAMED``), its share
of linked text, its length and its punctuation. The score is the capacity of the
block's edge from the source (content) or to the sink (boilerplate). Two kinds
of edges make the labels smooth: between neighbouring blocks, stronger under the
same parent, and between a block and its parent element and each element and
its own parent, so that what is near in the document tree is near in the graph.
The graph grows linearly with the page. Its minimum cut, by blocking flows,
labels the blocks: those the source still reaches are content.

Text in scripts, styles, forms, comments and the like is not text of the page and
never a block. Character references are decoded; white space inside a block is
one space; blocks are joined by a line feed.

Defined cases: a null or empty page, or one without content, gives an empty
text; broken markup (unclosed or stray tags, quotes, comments) is read to the
end; rows that repeat are read one by one; an empty table gives an empty
result; extra columns are not read. A page costs memory in proportion to its size.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import quoted

# Element names of HTML by what they do to text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math textarea title canvas audio video noframes".split())
HIDDEN = frozenset("form select button fieldset datalist dialog head".split())
# A start tag of the left closes an open element of the right, up to a scope's edge.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "main menu nav ol p pre section table ul".split())
SCOPE = frozenset("article aside body div dl footer form header html main nav ol section table ul".split())

# What an element's tag or the words of its class, id and role say: score units
# added to every block under it (positive: content). Plain weights of a linear
# classifier; the nearest elements count most (see ``_inherited``).
TAGS = {"article": 4.0, "main": 4.0, "nav": -8.0, "header": -4.0, "footer": -8.0, "aside": -8.0, "menu": -6.0,
        "blockquote": 1.0, "pre": 1.0, "p": 1.0, "h1": 2.0, "h2": 0.5, "h3": 0.5, "li": -0.5, "address": -2.0, "figcaption": 0.5}
NAMED = {
    8.0: "articlebody",
    4.0: "article content main post entry story body text maincontent hentry",
    -6.0: "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner popup modal overlay",
    -7.0: "nav navigation navbar menu breadcrumb breadcrumbs pagination pager sidebar aside footer masthead topbar toolbar "
          "widget rail skip complementary contentinfo colophon copyright legal",
    -8.0: "comment comments commentlist disqus reply replies respond discussion feedback reader readers",
    -6.5: "cookie cookies consent gdpr notice alert subscribe subscription newsletter signup login signin register paywall "
          "share sharing social related recommended recommendations trending popular more teaser search form",
    -3.0: "header meta byline tags tag caption author date print hidden",
}
WEIGHT = {word: w for w, words in NAMED.items() for word in words.split()}

_TOKEN = re.compile(r"""<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?;:,](?=\s|$)")

SCALE = 100          # capacities are integers: score units times this
NEIGHBOUR, SIBLING, PARENT = 0.6, 0.9, 0.7


def names_weight(tag: str, attrs: str) -> float:
    """Score units that one element gives to the blocks under it."""
    own = TAGS.get(tag, 0.0)
    if not attrs or ("=" not in attrs and "hidden" not in attrs):
        return own
    best = 0.0
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return -20.0
        if name in ("class", "id", "role"):
            for word in _WORDS.findall(value):
                w = WEIGHT.get(word.lower(), 0.0)
                # boilerplate names win over content names: "article-comments", "main-nav"
                best = min(best, w) if w < 0 or best < 0 else max(best, w)
    return own + best


class Block:
    __slots__ = ("parts", "linked", "parent", "tag")

    def __init__(self, parent: int):
        self.parts, self.linked, self.parent, self.tag = [], 0, parent, ""


def blocks_of(html: str) -> tuple[list[tuple[str, float, int]], list[tuple[int, str, float]]]:
    """(text, share of linked text, element) of each block and (parent, tag,
    weight) of each element."""
    elements: list[tuple[int, str, float]] = [(-1, "", 0.0)]
    stack, links, hidden = [0], 0, 0
    out: list[tuple[str, float, int]] = []
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append((text, min(1.0, linked / len(text)), stack[-1]))
            parts.clear()
            linked = 0

    def close(upto: int):
        """Close open elements down to a stack position."""
        nonlocal hidden
        while len(stack) > upto:
            if elements[stack.pop()][1] in HIDDEN:
                hidden -= 1

    at, n, low = 0, len(html), None
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and not hidden:
            text = unescape(html[at:lt]) if "&" in html[at:lt] else html[at:lt]
            parts.append(text)
            if links:
                linked += len(_SPACE.sub(" ", text).strip())
        if lt >= n:
            break
        m = _TOKEN.match(html, lt)
        if m is None:  # a stray "<" is text
            if not hidden:
                parts.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                continue
            flush()
            for k in range(len(stack) - 1, 0, -1):
                name = elements[stack[k]][1]
                if name == tag:
                    close(k)
                    links = 0 if tag in SCOPE else links
                    break
                if tag not in SCOPE and name in SCOPE:
                    break
            continue
        if tag in RAW:
            if low is None:
                low = html.lower()
            end = low.find(f"</{tag}", at) if not m[3].endswith("/") else at
            if end < 0 and tag in ("script", "style", "title", "textarea"):
                break
            if end >= 0:
                at = end
            continue
        if tag == "a":
            links = 1
        if tag in INLINE:
            continue
        flush()
        if tag in ENDS_P or tag in CLOSES:
            shut = CLOSES.get(tag, frozenset()) | ({"p"} if tag in ENDS_P else frozenset())
            for k in range(len(stack) - 1, 0, -1):
                name = elements[stack[k]][1]
                if name in shut:
                    close(k)
                elif name in SCOPE:
                    break
        if tag in VOID or m[3].endswith("/"):
            continue
        elements.append((stack[-1], tag, names_weight(tag, m[3])))
        stack.append(len(elements) - 1)
        if tag in HIDDEN:
            hidden += 1
    flush()
    return out, elements


def _inherited(elements: list[tuple[int, str, float]]) -> list[float]:
    """Each element's own weight and three quarters of what its parent has; a
    clear boilerplate name (-5 or less) is not outvoted by an element below it."""
    total: list[float] = []
    for parent, _, own in elements:
        above = total[parent] if parent >= 0 else 0.0
        value = own + 0.75 * above
        total.append(min(value, above) if above <= -5.0 else value)
    return total


def scores(blocks, elements) -> list[float]:
    """Linear score of every block: positive speaks for content."""
    weight, out = _inherited(elements), []
    for text, linked, element in blocks:
        words = text.count(" ") + 1
        marks = len(_SENTENCE.findall(text))
        tag = elements[element][1]
        own = weight[element] - 5.0 * linked + 0.08 * min(words, 40) + 0.3 * min(marks, 5) - 0.4
        if words < 4 and tag not in ("p", "h1", "h2", "h3", "h4", "li", "pre", "blockquote"):
            own -= 1.0
        if text[0] in "©®":
            own -= 4.0
        out.append(own)
    return out


class Network:
    """Undirected and terminal edges with integer capacities."""

    def __init__(self, n: int):
        self.n, self.head, self.to, self.room, self.next = n, [-1] * (n + 2), [], [], []

    def edge(self, u: int, v: int, there: int, back: int) -> None:
        for a, b, c in ((u, v, there), (v, u, back)):
            self.to.append(b)
            self.room.append(c)
            self.next.append(self.head[a])
            self.head[a] = len(self.to) - 1

    def cut(self) -> list[bool]:
        """True for vertices on the source's side of a minimum cut, by blocking
        flows. The source is n, the sink n + 1."""
        source, sink = self.n, self.n + 1
        head, to, room, following = self.head, self.to, self.room, self.next
        while True:
            level = [-1] * (self.n + 2)
            level[source] = 0
            queue = deque([source])
            while queue and level[sink] < 0:
                u = queue.popleft()
                e = head[u]
                while e >= 0:
                    if room[e] and level[to[e]] < 0:
                        level[to[e]] = level[u] + 1
                        queue.append(to[e])
                    e = following[e]
            if level[sink] < 0:
                return [x >= 0 for x in level[:self.n]]
            here, path, u = list(head), [], source
            while True:
                if u == sink:
                    flow = min(room[e] for e in path)
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    k = next(i for i, e in enumerate(path) if not room[e])
                    u = to[path[k] ^ 1]
                    del path[k:]
                    continue
                e = here[u]
                while e >= 0 and not (room[e] and level[to[e]] == level[u] + 1):
                    e = following[e]
                here[u] = e
                if e >= 0:
                    path.append(e)
                    u = to[e]
                elif u == source:
                    break
                else:
                    level[u] = -1
                    u = to[path.pop() ^ 1]


def label(values: list[float], parents: list[int], above: list[int]) -> list[bool]:
    """Content or not for each block, by the minimum cut. ``parents`` is the
    element of each block, ``above`` the parent of each element (-1: none)."""
    n, m = len(values), len(above)
    net = Network(n + m)
    for i, v in enumerate(values):
        c = round(SCALE * v)
        if c > 0:
            net.edge(net.n, i, c, 0)
        elif c < 0:
            net.edge(i, net.n + 1, -c, 0)
    smooth = lambda w: round(SCALE * w)
    used = [False] * m
    for i, p in enumerate(parents):
        if i:
            near = smooth(NEIGHBOUR + (SIBLING if parents[i - 1] == p else 0.0))
            net.edge(i - 1, i, near, near)
        net.edge(i, n + p, smooth(PARENT), smooth(PARENT))
        while p >= 0 and not used[p]:
            used[p] = True
            if above[p] >= 0:
                net.edge(n + p, n + above[p], smooth(PARENT) // 2, smooth(PARENT) // 2)
            p = above[p]
    return net.cut()[:n]


def main_text(html: str | None) -> str:
    """The text of the content blocks, joined by line feeds."""
    if not html:
        return ""
    blocks, elements = blocks_of(html)
    if not blocks:
        return ""
    keep = label(scores(blocks, elements), [b[2] for b in blocks], [e[0] for e in elements])
    return "\n".join(b[0] for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of every page in place of its html."""
    others = [c for c in pages.columns if c != html_col]
    if text_col in others:
        raise ValueError(f"column {text_col!r} exists")
    rows = pages.select(*[F.col(quoted(c)) for c in others], F.col(quoted(html_col)).cast("string").alias(html_col))

    def work(batches):
        import pyarrow as pa
        for batch in batches:
            texts = pa.array([main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*others, text_col])

    from pyspark.sql.types import StringType, StructField, StructType
    shape = StructType([*rows.schema.fields[:-1], StructField(text_col, StringType())])
    return rows.mapInArrow(work, shape)
