"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut at its block-level tags into blocks of text. What is known about a block, the elements around it and their
names, its length and how much of it is links, becomes a cost for either label: the log-odds of a logistic regression, fitted
on labelled pages (:mod:`daybook.llm.layouts`), are the capacities of its edges to the terminals. Edges to the
next block and to the element both stand in make it costly to part neighbours. The minimum cut separates content from
boilerplate. Blocks whose own cost outweighs all their edges are settled beforehand, which changes no minimum; a
maximum flow decides the rest.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm.common import pick
from daybook.llm.layouts import labelled_pages

#: Fixed values of HTML: a comment, a declaration, or a tag with its attributes; a quoted value may hold ``>``.
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
VOID = frozenset(["hr"])
#: Elements whose inside is never text of the page.
SKIPPED = frozenset("script style noscript template title iframe object svg canvas select textarea button audio video".split())
RAW = frozenset("script style title textarea".split())
#: Elements that a start tag of another closes: a paragraph ends at any block, an item at the next.
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
#: How far up the closing looks: not beyond these.
SCOPES = frozenset("ul ol menu dl table body html article section div main aside nav".split())

#: Elements that may tell what their inside is, and parts of names that tell how a page is set up, not what an element holds.
TELLING = frozenset("nav footer aside form menu dialog fieldset article main header table".split())
STATES = frozenset("has no not with without is js enabled enable disabled off on open opened closed hide hidden show visible active".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Short blocks that read like a site's small print.
SMALL_PRINT, SMALL_WORDS = re.compile(r"©|\(c\) ?\d|copyright|all rights reserved|privacy policy|terms of (?:use|service)", re.I), 25
#: Words beyond which a block is long; labelled pages, the seed that makes them, and the weights' prior variance.
MOST_WORDS, LABELLED, SEED, SPREAD = 60, 1500, 11, 9.0
#: Cost of a block that is not shown.
UNSHOWN = -1e6
#: Costs of parting neighbours: next to each other in one element or not, a block and its element, an element and its own.
BESIDE, NEXT, WITHIN, UP, CONTRAST = 1.0, 0.6, 0.7, 0.6, 0.8


@dataclass
class Element:
    tag: str
    number: int
    parent: int
    told: frozenset[str] | None


@dataclass
class Block:
    text: str
    element: int
    told: frozenset[str] | None
    linked: int
    tag: str


def _told(tag: str, attributes: str, above: frozenset[str] | None) -> frozenset[str] | None:
    """What an element and those around it tell about its inside, as features; nothing (None) if it is not shown."""
    if above is None:
        return None
    found = {f"in:{tag}" if tag != "header" or not above & {"in:article", "in:main"} else "in:header of text"} if tag in TELLING else set()
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        value, name = "".join(values), name.lower()
        if name in ("class", "id", "role"):
            if tag not in HEADINGS and tag not in ("html", "body"):
                for given in value.split():
                    parts = [part.lower() for part in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", given)]
                    if not STATES.intersection(parts):
                        found.update(f"name:{part}" for part in parts)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or "display:none" in value.replace(" ", "").lower():
            return None
    return above | found if found else above


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """The blocks of a page that hold text, in order, and its elements."""
    elements = [Element("", 0, -1, frozenset())]
    stack, blocks, run = [elements[0]], [], []
    linked = links = 0
    open_tags: Counter[str] = Counter()
    unended: set[str] = set()

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            top = stack[-1]
            blocks.append(Block(text, top.number, top.told, linked, top.tag))
        run.clear()
        linked = 0

    def put(text: str) -> None:
        nonlocal linked
        if text:
            run.append(text)
            linked += len(text) if links else 0

    at, end = 0, len(page)
    while at < end:
        match = TAG.search(page, at)
        if not match:
            put(page[at:])
            break
        put(page[at:match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag in BLOCKS:
                close()
                while open_tags[tag]:
                    shut = stack.pop().tag
                    open_tags[shut] -= 1
                    if shut == tag:
                        break
            elif tag == "a":
                links = 0
        elif tag in SKIPPED:
            stop = None if tag in unended else re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            if stop:
                at = stop.end()
            elif tag in RAW:
                break
            else:
                unended.add(tag)
        elif tag in BLOCKS:
            close()
            shut = CLOSED_BY.get(tag, set()) | {"p"}
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in shut:
                    open_tags.subtract(element.tag for element in stack[depth:])
                    del stack[depth:]
                    break
                if stack[depth].tag in SCOPES:
                    break
            if tag not in VOID:
                element = Element(tag, len(elements), stack[-1].number, _told(tag, match[3], stack[-1].told))
                elements.append(element)
                stack.append(element)
                open_tags[tag] += 1
        elif tag == "a":
            links = 1
        elif tag == "br":
            run.append(" ")
    close()
    return blocks, elements


def features(block: Block) -> dict[str, float]:
    """What is known about a block. Names count once more beside a tag that says that they are inside an article."""
    words = block.text.count(" ") + 1
    found = {"bias": 1.0, "words": math.log(min(words, MOST_WORDS)), "long": min(words, MOST_WORDS) / MOST_WORDS,
             "ends": float(block.text[-1] in ".!?:;…\"”»"), "links": _linked(block), "small print": float(_small(block)), f"tag:{block.tag}": 1.0}
    inside = bool(block.told & {"in:article", "in:main"})
    for told in block.told:
        found[told] = 1.0
        if inside and told.startswith("name:"):
            found[f"{told} of text"] = 1.0
    return found


@lru_cache(maxsize=1)
def fitted() -> dict[str, float]:
    """Weights of the features: a logistic regression with a normal prior on blocks of labelled pages, by Newton's method."""
    rows, labels = [], []
    for page, content in labelled_pages(LABELLED, SEED):
        for block in blocks_of(page)[0]:
            rows.append(features(block))
            labels.append(block.text in content)
    names = {name: i for i, name in enumerate(sorted({name for row in rows for name in row}))}
    x, y = np.zeros((len(rows), len(names))), np.array(labels, dtype=float)
    for i, row in enumerate(rows):
        x[i, [names[name] for name in row]] = list(row.values())
    weights = np.zeros(len(names))
    for _ in range(12):
        p = 1 / (1 + np.exp(-(x @ weights)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(names)) / SPREAD
        weights += np.linalg.solve(hessian, x.T @ (y - p) - weights / SPREAD)
    return {name: float(weights[i]) for name, i in names.items()}


def _cost(block: Block, weights: dict[str, float]) -> float:
    if block.told is None:
        return UNSHOWN
    return sum(value * weights.get(name, 0.0) for name, value in features(block).items())


def _tie(a: Block, b: Block, elements: list[Element]) -> float:
    """The cost of parting neighbours: less the more they differ in links, and if one is small print."""
    beside = a.element == b.element or elements[a.element].parent == elements[b.element].parent
    unlike = abs(_linked(a) - _linked(b))
    return (BESIDE if beside else NEXT) * (1 - CONTRAST * unlike) * (1 - CONTRAST * (_small(a) != _small(b)))


def _linked(block: Block) -> float:
    return min(1.0, block.linked / len(block.text))


def _small(block: Block) -> bool:
    return block.text.count(" ") < SMALL_WORDS and SMALL_PRINT.search(block.text) is not None


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the side of the source. A node's cost, if positive, is its capacity from the source, else to the sink."""
    n = len(costs)
    costs = list(costs)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, weight in edges:
        near[a][b] = near[a].get(b, 0.0) + weight
        near[b][a] = near[b].get(a, 0.0) + weight
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # what outweighs all its edges is settled, and turns them into costs of its neighbours
        i = todo.popleft()
        if side[i] is None and abs(costs[i]) >= sum(near[i].values()):
            side[i] = costs[i] > 0
            for j, weight in near[i].items():
                costs[j] += weight if side[i] else -weight
                del near[j][i]
                todo.append(j)
            near[i] = {}
    open_nodes = [i for i in range(n) if side[i] is None]
    if open_nodes:
        content = _flow(open_nodes, costs, near)
        for i in open_nodes:
            side[i] = i in content
    return side


def _flow(nodes: list[int], costs: list[float], near: list[dict[int, float]]) -> set[int]:
    """The nodes that the source still reaches after a maximum flow (shortest augmenting paths, level by level)."""
    source, sink = -1, -2
    room = {i: dict(near[i]) for i in nodes} | {source: {}, sink: {}}
    for i in nodes:
        if costs[i] > 0:
            room[source][i], room[i][source] = costs[i], 0.0
        elif costs[i] < 0:
            room[i][sink], room[sink][i] = -costs[i], 0.0
    tiny = 1e-9
    while True:
        level, todo = {source: 0}, deque([source])
        while todo:
            i = todo.popleft()
            for j, left in room[i].items():
                if left > tiny and j not in level:
                    level[j] = level[i] + 1
                    todo.append(j)
        if sink not in level:
            return set(level) - {source}
        ways = {i: iter(list(room[i])) for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                pushed = min(room[a][b] for a, b in zip(path, path[1:]))
                full = []
                for k, (a, b) in enumerate(zip(path, path[1:])):
                    room[a][b] -= pushed
                    room[b][a] += pushed
                    if room[a][b] <= tiny:
                        full.append(k)
                del path[full[0] + 1:]  # goes on from where the first full edge begins
                continue
            for j in ways[i]:
                if room[i][j] > tiny and level.get(j) == level[i] + 1:
                    path.append(j)
                    break
            else:
                path.pop()


def main_text(page: str | None, weights: dict[str, float] | None = None) -> str:
    """The content of a page, its blocks joined by blanks; empty for a page without any."""
    weights = fitted() if weights is None else weights
    blocks, elements = blocks_of(page or "")
    if not blocks:
        return ""
    n = len(blocks)
    used = {block.element for block in blocks}
    for number in sorted(used, reverse=True):
        while number > 0 and (number := elements[number].parent) not in used:
            used.add(number)
    place = {number: n + k for k, number in enumerate(sorted(used))}
    edges = [(i, place[block.element], WITHIN) for i, block in enumerate(blocks)]
    edges += [(i - 1, i, _tie(blocks[i - 1], blocks[i], elements)) for i in range(1, n)]
    edges += [(place[k], place[elements[k].parent], UP) for k in used if elements[k].parent in place]
    side = minimum_cut([_cost(block, weights) for block in blocks] + [0.0] * len(place), edges)
    return " ".join(block.text for block, content in zip(blocks, side) if content)


def _extract(batches: Iterator[pa.RecordBatch], weights: dict[str, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, weights) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string()),
             pa.array(map(len, texts), type=pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id``, ``url``, ``html``).

    Null html counts as empty and gives an empty text, as a page without content does. Null ids and urls are kept; repeated
    rows come out as often. Broken markup is read as far as it goes: what is not a tag is text, an element left open ends
    with its parent, a script left open takes the rest. Pages of any length are read whole; an empty table gives an empty one.
    """
    frame = pick(pages, {"page_id": "long", "url": "string", "html": "string"})
    return frame.mapInArrow(partial(_extract, weights=fitted()), "page_id long, url string, text string, n_chars long")
