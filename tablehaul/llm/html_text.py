"""HTML extraction by minimum-cut labelling.

A page's text is cut into blocks at block-level tags. A small logistic classifier (fixed weights on the
elements and names around a block, its links, length and punctuation) gives each block the cost of calling
it content or boilerplate; these are the capacities to the two terminals. Smoothness edges join blocks that
follow each other (stronger the nearer they are in the DOM) and blocks under one parent. The minimum cut
splits content from boilerplate. Where nothing is left, the page is taken to be short: what no boilerplate element holds and isn't
mostly links is its text. Scripts, styles, comments, templates, drawings and the head never become blocks; formulas do. Within
an article only the narrow names of adverts, comments, sharing and related pieces mark boilerplate, on elements of text those of adverts alone.

Scale: a map over the pages, no shuffle; one page is in memory at a time beside its Arrow batch. Blocks
whose terminal outweighs all their edges are settled before the flow runs, which changes no minimum, so
the flow graph stays small on long pages.

Defined cases: null or empty html, and pages without content, give an empty text. Repeated rows are handled
alike. Broken markup is read as browsers do: unclosed paragraphs and drawings end with the next block, an unclosed
script, comment or tag takes the rest. White space in a block (br included) becomes one space. Columns
named like an added one are replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                   r"""|</?[a-zA-Z][^>]*>|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
NAMED_WITH = re.compile(r"\b(?:has|no|with|without|hide|show)[-_]+\w+")
NAME = re.compile(r"[a-z0-9]+")
WORD = re.compile(r"\w")

# Elements by what they do to the text; fixed values of the HTML standard.
RAW = frozenset("script style template textarea title iframe noembed noframes xmp".split())
# Their text is not shown; unlike RAW ones they have elements in them.
MUTE = frozenset("svg annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option
p pre search section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption option optgroup legend".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table div section article aside nav header footer main body form blockquote".split())

# What the classifier looks at.
BOILER_TAGS = frozenset("nav footer aside form menu select button dialog fieldset search head".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion
banner banners nav navbar navigation menu breadcrumb breadcrumbs sidebar side rail widget widgets footer foot masthead
header topbar toolbar cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay newsletter
subscribe subscription signup login paywall share sharing social comment comments commentlist respond reply replies
discussion disqus review reviews related recommended recommendations teaser trending popular tags pagination pager
search copyright legal skip complementary contentinfo hidden""".split())
# Within an article: of the elements that hold others, and of those that hold text.
ARTICLE_BOILER_NAMES = frozenset("""ad ads adv advert adverts advertisement sponsor sponsored promo comment comments reply replies
review reviews related recommended share sharing social teaser""".split())
AD_NAMES = frozenset("ad ads adv advert adverts advertisement sponsor sponsored".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary span em strong b i u small sup sub".split())
CONTENT_NAMES = frozenset("article content post entry story main body text prose".split())

# Log-odds of content.
BIAS, IN_CONTENT, IN_BOILER, CONTENT_NAMED, LINKED, LONG, ENDS_SENTENCE, HEADING, SHORT = -0.6, 3.5, -7.0, 0.8, -3.0, 0.9, 0.6, 0.4, -0.5
# Smoothness: for neighbours with one parent, for others by the steps between them in the DOM, for siblings.
SAME_PARENT, NEIGHBOUR, SIBLING = 0.7, 0.5, 0.35


class Frame:
    __slots__ = ("tag", "parent", "depth", "boiler", "content", "named", "link", "heading", "mute")

    def __init__(self, tag: str, parent: Frame | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.boiler = parent.boiler if parent else False
        self.content = parent.content if parent else False
        self.named = parent.named if parent else False
        self.link = parent.link if parent else False
        self.heading = parent.heading if parent else False
        self.mute = parent.mute if parent else False


def _open(tag: str, attributes: str, parent: Frame) -> Frame:
    f = Frame(tag, parent)
    if tag in BOILER_TAGS or (tag in ("header", "noscript") and not parent.content):
        f.boiler = True
    elif tag in CONTENT_TAGS:
        f.content = True
    elif tag in MUTE:
        f.mute = True
    elif tag == "a":
        f.link = True
    elif tag[0] == "h" and tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        f.heading = True
    if len(attributes) > 5 and tag not in ("html", "body", "a"):
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                f.boiler = True
            elif name == "style":
                f.boiler = f.boiler or "display:none" in value.replace(" ", "")
            else:
                words = set(NAME.findall(NAMED_WITH.sub(" ", value)))
                names = (BOILER_NAMES if not parent.content and tag != "article" else AD_NAMES if tag in TEXT_TAGS else ARTICLE_BOILER_NAMES)
                if tag != "main" and words & names:
                    f.boiler = True
                elif words & CONTENT_NAMES:
                    f.named = True
    return f


def blocks(page: str) -> list[tuple[str, Frame, int, int]]:
    """Text blocks in page order: text (white space as it was), its innermost block element, letters in links, all."""
    out: list[tuple[str, Frame, int, int]] = []
    root = Frame("", None)
    at, holder = root, root  # the innermost element, and the innermost block-level one
    parts: list[str] = []
    linked = total = position = 0

    def flush() -> None:
        nonlocal linked, total
        if parts:
            text = "".join(parts)
            if not text.isspace():
                out.append((text, holder, linked, total))
            parts.clear()
        linked = total = 0

    def say(raw: str) -> None:
        nonlocal linked, total
        if at.mute:
            return
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        total += len(text)
        if at.link:
            linked += len(text)

    def block_of(f: Frame) -> Frame:
        while f.parent and f.tag not in BLOCK:
            f = f.parent
        return f

    size = len(page)
    while position < size:
        m = TOKEN.search(page, position)
        if not m:
            say(page[position:])
            break
        if m.start() > position:
            say(page[position:m.start()])
        position = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # an end tag closes up to its element, if that is open
            f = at
            while f.parent and f.tag != tag:
                f = f.parent
            if f.parent:
                if tag in BLOCK:
                    flush()
                at = f.parent
                holder = block_of(at)
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, position)
                position = end.end() if end else size
            continue
        if tag in VOID:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                flush()
            continue
        if at.mute:
            if tag in BLOCK:  # a block ends a drawing that was not closed
                while at.mute and at.parent:
                    at = at.parent
            elif m[3].endswith("/"):
                continue
        elif tag in MUTE and m[3].endswith("/"):
            continue
        if tag in BLOCK:
            flush()
            ends = CLOSED_BY.get(tag, ())
            f = at
            while f.parent and f.tag not in SCOPE:
                if f.tag in ends or (f.tag == "p" and tag in CLOSES_P):
                    at = f.parent
                f = f.parent
        at = _open(tag, m[3], at)
        holder = block_of(at)
    flush()
    return out


def log_odds(text: str, frame: Frame, linked: int, total: int) -> float:
    """The classifier: log-odds that a block is content."""
    words = text.count(" ") + 1
    s = BIAS + IN_CONTENT * frame.content + CONTENT_NAMED * frame.named + HEADING * frame.heading
    s += IN_BOILER * frame.boiler + LINKED * linked / max(1, total)
    s += LONG * min(2.0, math.log1p(words / 8))
    if text[-1:] in ".!?\"»”":
        s += ENDS_SENTENCE
    if words < 3:
        s += SHORT
    return s


def _distance(a: Frame, b: Frame) -> int:
    """Steps between two elements in the DOM."""
    steps = 0
    while a is not b and (a.parent or b.parent):
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges_of(frames: list[Frame]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in page order by DOM distance, and next siblings."""
    out, last = [], {}
    for i, f in enumerate(frames):
        parent = f.parent or f
        if i:
            before = frames[i - 1]
            if before.parent is f.parent:
                out.append((i - 1, i, SAME_PARENT))
            else:
                out.append((i - 1, i, NEIGHBOUR / (1 + _distance(before, f))))
        j = last.get(id(parent))
        if j is not None and j != i - 1:
            out.append((j, i, SIBLING))
        last[id(parent)] = i
    return out


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the content side of a minimum cut.

    A node's terminal capacities are its costs of either label; only their difference, the log-odds, matters.
    """
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    score, label = list(odds), [None] * n
    queue = deque(range(n))
    while queue:  # a terminal heavier than all edges decides; its edges then pull the neighbours
        i = queue.popleft()
        if label[i] is None and abs(score[i]) >= sum(near[i].values()):
            label[i] = score[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                score[j] += w if label[i] else -w
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _max_flow(rest, score, near)):
            label[i] = side
    return label


def _max_flow(nodes: list[int], score: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Source side of a minimum cut (Dinic): positive scores hang on the source, negative ones on the sink."""
    number = {v: k for k, v in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    heads: list[list[int]] = [[] for _ in range(len(nodes) + 2)]
    to, room = [], []

    def arc(a: int, b: int, forth: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(forth)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for v in nodes:
        if score[v] > 0:
            arc(source, number[v], score[v], 0.0)
        elif score[v] < 0:
            arc(number[v], sink, -score[v], 0.0)
        for u, w in near[v].items():
            if number[u] > number[v]:
                arc(number[v], number[u], w, w)
    while True:
        level = [-1] * len(heads)
        level[source] = 0
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for e in heads[v]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(len(nodes))]
        nxt = [0] * len(heads)
        path: list[int] = []
        v = source
        while True:  # depth first along the levels, without recursion
            if v == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                k = next(k for k, e in enumerate(path) if room[e] <= 1e-12)
                v = to[path[k] ^ 1]
                del path[k:]
                continue
            while nxt[v] < len(heads[v]):
                e = heads[v][nxt[v]]
                if room[e] > 1e-12 and level[to[e]] == level[v] + 1:
                    break
                nxt[v] += 1
            if nxt[v] < len(heads[v]):
                path.append(heads[v][nxt[v]])
                v = to[path[-1]]
            elif path:
                v = to[path.pop() ^ 1]
                nxt[v] += 1
            else:
                break


def main_text(page: str | None) -> str:
    """The content blocks of a page, one per line."""
    found = [(" ".join(text.split()), f, linked, total) for text, f, linked, total in blocks(page or "")]
    found = [b for b in found if b[0]]
    label = min_cut([log_odds(*b) for b in found], edges_of([b[1] for b in found]))
    if not any(label):  # a page of a few words: what no boilerplate element holds, and is not mostly links
        label = [not f.boiler and 2 * linked <= total and WORD.search(text) is not None for text, f, linked, total in found]
    return "\n".join(b[0] for b, content in zip(found, label) if content)


def extract(pages: DataFrame, column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` (all columns but the html, or those in ``keep``) with text."""
    keep = [c for c in keep or pages.columns if c not in (column, "text")]
    schema = ", ".join(f"`{c}` {dict(pages.dtypes)[c]}" for c in keep) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())],
                                             names=[*keep, "text"])

    return pages.select(*keep, column).mapInArrow(run, schema)
