"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks, the nodes of a graph. A classifier gives each block the log
odds that it is content, from the elements it lies in, their classes and ids, its length and its
share of linked text; they become the capacity of its edge to the source or to the sink. Adjacent
blocks, and blocks with the same parent, are tied by smoothness edges that grow with how much of the
tree they share. The maximum flow from source to sink gives the cheapest labelling: blocks left on
the source's side are content. A doubtful block so follows its surroundings.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")

# Elements of HTML by what they mean here.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td"
    " tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style head template noscript iframe svg math object canvas audio video textarea select button title datalist".split()
)
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices"
    " comment comments disqus reply replies sidebar menu nav navigation navbar footer breadcrumb breadcrumbs related"
    " recommended share sharing social newsletter subscribe subscription popup modal overlay widget login signup search toolbar"
    " pagination pager masthead topbar copyright disclaimer".split()
)
GOOD_NAMES = frozenset("content article post story entry main text body".split())
# Elements that a start tag closes when they are open: name -> what closes it.
_CLOSES = {
    "p": BLOCKS - {"body", "html"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_SCOPES = frozenset("table ul ol dl body article section div main".split())


@dataclass
class Node:
    name: str
    depth: int
    parent: Node | None
    odds: float  # log odds that its elements give to what is inside
    article: bool
    link: bool


@dataclass
class Block:
    parent: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _enter(parent: Node | None, name: str, attributes: str) -> Node:
    odds, article = (parent.odds, parent.article) if parent else (0.0, False)
    if name in ("article", "main"):
        odds, article = odds + 3.0, True
    elif name in BOILERPLATE or name == "header" and not article:
        odds -= 8.0
    if attributes:
        names = {w for m in _NAMES.findall(attributes) for w in _WORD.findall(m.lower())}
        heading = "header" in names and not article and not names & GOOD_NAMES
        if (names & BAD_NAMES or heading) and name not in ("html", "body"):
            odds -= 8.0
        elif names & GOOD_NAMES and not article:
            odds += 1.5
    return Node(name, parent.depth + 1 if parent else 0, parent, odds, article, name == "a" or bool(parent and parent.link))


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order. Elements that are left open, or closed unopened, do no harm."""
    at = top = _enter(None, "html", "")
    done: list[Block] = []
    now = Block(top)

    def flush(parent: Node) -> None:
        nonlocal now
        now.text = " ".join("".join(now.parts).split())
        if now.text:
            done.append(now)
        now = Block(parent)

    def add(raw: str) -> None:
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            if not now.parts:
                now.parent = at
            now.parts.append(text)
            if at.link:
                now.linked += len(text.strip())

    place, size = 0, len(page)
    while place < size:
        m = _TAG.search(page, place)
        if not m:
            add(page[place:])
            break
        add(page[place : m.start()])
        place = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            node = at
            while node and node.name != name:
                node = node.parent
            if node and node.parent:
                at = node.parent
            if name in BLOCKS:
                flush(at)
            continue
        attributes = m[3] or m[6] or ""
        if name in SKIPPED and not attributes.rstrip().endswith("/"):
            if name == "head":
                # What may stand in a head is skipped by itself; its text, if any, goes with it.
                at = _enter(at, name, "")
                at.odds -= 100.0
                continue
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, place)
            place = end.end() if end else size if name in ("script", "style") else place
            if name in ("select", "textarea", "button"):
                add(" ")
            continue
        if name == "body":
            at = top
        for open_name, closers in _CLOSES.items():
            if name in closers:
                node = at
                while node and node.name != open_name and (node.name not in _SCOPES):
                    node = node.parent
                if node and node.name == open_name and node.parent:
                    at = node.parent
        if name in BLOCKS:
            flush(at)
        elif name == "br":
            add(" ")
        if name not in VOID and not attributes.rstrip().endswith("/"):
            at = _enter(at, name, attributes)
            if name in BLOCKS:
                now.parent = at
    flush(top)
    return done


def log_odds(block: Block) -> float:
    """The classifier: how much likelier a block is content than not."""
    size = len(block.text)
    odds = block.parent.odds + 0.3 + min(size / 100.0, 2.0) - 5.0 * min(1.0, block.linked / size)
    node, seen = block.parent, 0
    while node and seen < 4:
        if node.name == "p":
            odds += 0.5
        elif node.name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            odds += 0.5
        node, seen = node.parent, seen + 1
    return odds


def _container(node: Node) -> Node:
    """The element around the block's own element."""
    while node.parent and node.name not in BLOCKS:
        node = node.parent
    return node.parent or node


def _shared(a: Node, b: Node) -> float:
    """Share of the deeper path that two elements have in common."""
    deep = max(a.depth, b.depth, 1)
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a.depth / deep


def smoothness(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Edges between blocks: neighbours, and the next block with the same container."""
    edges: dict[tuple[int, int], float] = {}
    for i in range(1, len(blocks)):
        edges[i - 1, i] = 0.3 + 0.7 * _shared(_container(blocks[i - 1].parent), _container(blocks[i].parent))
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        key = id(_container(block.parent))
        if key in last:
            edge = last[key], i
            edges[edge] = edges.get(edge, 0.0) + 0.8
        last[key] = i
    return edges


def minimum_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay with the source in a cut of least capacity; ties go to the sink.

    Positive odds are capacities from the source, negative ones to the sink. A node whose terminal
    outweighs all its edges has that terminal's label in every minimum cut; such nodes are fixed
    first and their edges become terminal capacities of their neighbours. What is left is solved by
    augmenting level graphs.
    """
    terminal = list(odds)
    near: list[dict[int, float]] = [{} for _ in odds]
    for (a, b), capacity in edges.items():
        near[a][b] = near[a].get(b, 0.0) + capacity
        near[b][a] = near[b].get(a, 0.0) + capacity
    label: list[bool | None] = [None] * len(odds)
    work = deque(range(len(odds)))
    while work:
        i = work.popleft()
        if label[i] is None and abs(terminal[i]) > sum(near[i].values()):
            label[i] = terminal[i] > 0
            for j, capacity in near[i].items():
                terminal[j] += capacity if label[i] else -capacity
                del near[j][i]
                work.append(j)
            near[i] = {}
    rest = [i for i, known in enumerate(label) if known is None]
    for i, side in zip(rest, _source_side([terminal[i] for i in rest], rest, near)):
        label[i] = side
    return [bool(known) for known in label]


def _source_side(terminal: list[float], nodes: list[int], near: list[dict[int, float]]) -> list[bool]:
    number = {n: i for i, n in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    residual: list[dict[int, float]] = [{} for _ in range(len(nodes) + 2)]
    for i, capacity in enumerate(terminal):
        if capacity > 0:
            residual[source][i], residual[i][source] = capacity, 0.0
        elif capacity < 0:
            residual[i][sink], residual[sink][i] = -capacity, 0.0
    for n, i in number.items():
        for m, capacity in near[n].items():
            residual[i][number[m]] = capacity
    while True:
        # Levels from the source; then paths along them, until none is left.
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for b, capacity in residual[a].items():
                if capacity > 1e-9 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return [i in level for i in range(len(nodes))]
        following = [iter(list(r)) for r in residual]
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                flow = min(residual[x][y] for x, y in zip(path, path[1:]))
                for x, y in zip(path, path[1:]):
                    residual[x][y] -= flow
                    residual[y][x] = residual[y].get(x, 0.0) + flow
                cut = next(k for k, (x, y) in enumerate(zip(path, path[1:])) if residual[x][y] <= 1e-9)
                del path[cut + 1 :]
                following[path[-1]] = iter([b for b in residual[path[-1]]])
                continue
            for b in following[a]:
                if residual[a][b] > 1e-9 and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
            else:
                level[a] = -1
                path.pop()


def main_text(page: str | None) -> str:
    """Content blocks in page order, joined by an empty line; empty if there are none."""
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    content = minimum_cut([log_odds(b) for b in blocks], smoothness(blocks))
    return "\n\n".join(b.text for b, kept in zip(blocks, content) if kept)


def _main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p) for p in pages], dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and its length ``n_chars`` in code points, from the whole ``html``.

    A null or empty page has an empty text. Columns named ``text`` or ``n_chars`` are replaced.
    """
    kept = [pages[c] for c in pages.columns if c not in ("text", "n_chars")]
    found = F.pandas_udf(_main_text, "string")
    return pages.select(*kept, found(pages["html"]).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def extraction_query(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return extract(pages.select(pages["page_id"], pages["url"], pages["html"])).drop("html")
