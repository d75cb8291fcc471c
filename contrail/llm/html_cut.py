"""Main text of web pages by a minimum cut between content and boilerplate.

A page is read into blocks of text with the elements around them. A linear
classifier of a block's own text gives a cost for either label; the costs are the
capacities to the two terminals. Blocks next to each other, and those next to each
other under one parent, are joined by smoothness edges, the stronger the nearer they
are in the tree. The minimum cut is the labelling with the least total cost: a
one-word paragraph between paragraphs stays, a sentence among links goes. Blocks
whose own cost outweighs all their edges are settled at once, maximum flow decides
the rest.

All of it is learned from a bounded sample of pages (``SAMPLE_PAGES`` in a seeded
order, ``SAMPLE_BLOCKS`` of each). Elements and names that say what they are label
the sample's blocks. The classifier does not see them: it learns from words, links,
sentence ends and the length of the blocks beside it. How often blocks at a distance in
the tree agree gives the edges.
What a declared role weighs is learned against the cut by text and edges alone, on
pages that its classifier was not trained on; it weighs ``LEAST_HINT`` at least, since
what is declared a menu, a form or comments is by definition not main text.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.session import cut_lineage, discard

SAMPLE_PAGES = 400
SAMPLE_BLOCKS = 500
SEED = 5
# bounds of what is learned: a block's cost by its text, an edge, a declared role
MOST_COST, MOST_EDGE = 3.0, 3.0
LEAST_HINT, MOST_HINT = 4.5, 8.0
# steps in the tree from which on blocks are not joined
FAR = 6
# between blocks of which one only is inside a boilerplate element
CONTRAST = 0.1

# Elements and name parts of HTML pages.
SKIPPED = {"script", "style", "noscript", "template", "iframe", "head", "title"}
RAW = {"script", "style", "noscript", "template", "iframe", "title", "textarea"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details",
         "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
         "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p",
         "pre", "search", "section", "select", "summary", "table", "tbody", "td", "textarea", "tfoot", "th",
         "text", "thead", "tr", "ul"}
# an opening tag ends these open elements
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "menu", "article", "section", "div", "body", "main", "td", "svg", "object"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option",
                    "textarea", "fieldset", "search"}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus footer form gdpr header legal login masthead "
    "menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion "
    "recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription teaser toolbar topbar widget".split())
CONTENT_NAMES = set("article articlebody content entry main maincontent post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


@dataclass(eq=False)
class Element:
    tag: str
    number: int
    boilerplate: int
    content: int
    over: Element | None = None
    depth: int = 0


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    element: Element
    parent: int
    boilerplate: int
    content: int
    before: float = 0.0
    behind: float = 0.0
    edges: dict[int, float] = field(default_factory=dict)


def name_parts(attributes: str) -> set[str]:
    found = set()
    for m in _NAMES.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        found.update(p.lower() for p in _PART.findall(value))
        found.add(value.lower())
    return found


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order; markup, scripts and the head are left out."""
    blocks: list[Block] = []
    root = Element("", 0, 0, 0)
    stack, count = [root], 0
    text: list[str] = []
    linked: list[str] = []
    skipping, link = 0, 0

    def flush() -> None:
        nonlocal link
        body = " ".join("".join(text).split())
        if body:
            at = len(stack) - 1
            while at > 0 and stack[at].tag not in BLOCK:
                at -= 1
            here, over = stack[at], stack[max(0, at - 1)]
            blocks.append(Block(body, len("".join("".join(linked).split())), here.tag, here, over.number,
                                here.boilerplate, here.content))
        text.clear()
        linked.clear()
        link = 0

    def add(piece: str) -> None:
        if piece and not skipping:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if link:
                linked.append(piece)

    def close_to(at: int) -> None:
        nonlocal skipping
        skipping -= sum(e.tag in SKIPPED for e in stack[at:])
        del stack[at:]

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "br":
            text.append(" ")
            continue
        if tag == "a":
            link = 0 if closing else 1
            continue
        if tag in BLOCK:
            flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close_to(i)
                    break
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            # a block ends an open paragraph, an item its predecessor
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" or stack[i].tag in CLOSES.get(tag, ()):
                    close_to(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        if tag == "body":
            # text of a head without an end is not the page's
            close_to(next((i for i, e in enumerate(stack) if e.tag == "head"), len(stack)))
        over, parts = stack[-1], name_parts(m[3]) if m[3] else set()
        names_bad = len(parts & BOILERPLATE_NAMES) > 0
        names_good = len(parts & CONTENT_NAMES) > 0
        count += 1
        bad = tag in BOILERPLATE_TAGS or names_bad or tag == "header" and not over.content
        element = Element(tag, count, over.boilerplate + bad,
                          over.content + (tag in CONTENT_TAGS or names_good and not names_bad),
                          over, over.depth + 1)
        if m[3].endswith("/") and tag not in BLOCK and tag not in SKIPPED:
            continue
        if tag in RAW:
            end = _ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(element)
        skipping += tag in SKIPPED
    flush()
    plain = [0.0, *(np.log1p((b.text.count(" ") + 1) * (1 - b.linked / len(b.text))) for b in blocks), 0.0]
    for i, b in enumerate(blocks):
        b.before, b.behind = plain[i], plain[i + 2]
    return blocks


# --- costs ---------------------------------------------------------------

class Model(NamedTuple):
    """Weights of a block's text, edges by distance in the tree, weights of declared roles."""

    weights: np.ndarray
    edges: tuple[float, ...]
    boilerplate: float
    content: float


# bias, words (log), share of linked text, sentence end, heading, share of other signs than letters,
# words without links of the block before and of the one behind (log)
INITIAL = Model(np.array([-3.0, 1.0, -4.0, 0.6, 0.8, -1.0, 0.3, 0.3]), (3.0, 2.0, 2.0, 0.5, 0.2, 0.0), -6.0, 2.0)


def features(b: Block) -> list[float]:
    """What the classifier sees: text, links, whether it is a heading, the blocks beside it."""
    letters = sum(map(str.isalpha, b.text))
    spaces = b.text.count(" ")
    return [1.0, min(np.log1p(spaces + 1), 5.0), b.linked / len(b.text), float(b.text[-1] in ".!?:;…»”\""),
            float(b.tag in {"h1", "h2", "h3", "h4"}), 1 - letters / max(1, len(b.text) - spaces),
            min(b.before, 5.0), min(b.behind, 5.0)]


def declared(b: Block) -> int:
    """What the elements around a block say: -1 boilerplate, 1 content, 0 nothing."""
    return -1 if b.boilerplate else int(b.content > 0)


def costs_of(blocks: list[Block], model: Model) -> list[float]:
    by_text = np.clip(np.array([features(b) for b in blocks]) @ model.weights, -MOST_COST, MOST_COST)
    role = (0.0, model.content, model.boilerplate)
    return [c + role[declared(b)] for c, b in zip(by_text.tolist(), blocks)]


def fit(rows: list[list[float]], labels: list[float], pull: float = 0.002, steps: int = 800) -> np.ndarray:
    """Logistic weights of labelled blocks, both labels weighing the same, pulled to the initial ones."""
    w = INITIAL.weights.copy()
    if not rows or len(set(labels)) < 2:
        return w
    x, y = np.array(rows), np.array(labels)
    balance = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - 0.5 * (x.T @ (balance * (p - y)) + pull * (w - INITIAL.weights))
    return w


# --- edges and minimum cut -----------------------------------------------

def distance(a: Element, b: Element) -> int:
    """Steps from one element to the other through the tree, ``FAR`` at most."""
    steps = 0
    while a is not b and steps < FAR:
        if a.depth < b.depth:
            a, b = b, a
        a, steps = a.over, steps + 1
    return steps


def pairs(blocks: list[Block]) -> Iterator[tuple[int, int, int]]:
    """(block, later block, distance): the next one, and the next one under the same parent."""
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        for k in {i - 1, last.get(b.parent, i - 1)} - {-1}:
            steps = distance(blocks[k].element, b.element)
            if steps < FAR:
                yield k, i, steps
        last[b.parent] = i


def connect(blocks: list[Block], edges: tuple[float, ...]) -> None:
    """Smoothness edges by distance, weaker over the border of a boilerplate element."""
    for a, b, steps in pairs(blocks):
        capacity = edges[steps]
        if bool(blocks[a].boilerplate) != bool(blocks[b].boilerplate):
            capacity *= CONTRAST
        if capacity:
            blocks[a].edges[b] = blocks[b].edges[a] = capacity


def edges_of(agree: np.ndarray, differ: np.ndarray) -> tuple[float, ...]:
    """Log odds that two blocks agree, by distance; never stronger than at a smaller one."""
    odds = np.log((agree + 1) / (differ + 1)).clip(0, MOST_EDGE)
    # distances that were not seen keep their initial edge
    odds = np.where(agree + differ > 0, odds, INITIAL.edges)
    return tuple(np.minimum.accumulate(odds).tolist())


def settle(costs: list[float], edges: list[dict[int, float]]) -> list[bool | None]:
    """Labels of nodes whose cost outweighs their open edges, again and again."""
    cost, label = list(costs), [None] * len(costs)
    weight = [sum(e.values()) for e in edges]
    todo = deque(range(len(costs)))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(cost[i]) < weight[i] or cost[i] == 0:
            continue
        label[i] = cost[i] > 0
        for j, c in edges[i].items():
            if label[j] is None:
                cost[j] += c if label[i] else -c
                weight[j] -= c
                todo.append(j)
    return label


def minimum_cut(costs: list[float], edges: list[dict[int, float]]) -> list[bool]:
    """True for nodes on the source's side of a minimum cut.

    A positive cost is the capacity from the source, a negative one that to the
    sink. Shortest augmenting paths; of several minimum cuts the one with the
    fewest nodes on the source's side.
    """
    n = len(costs)
    source, sink = n, n + 1
    room: list[dict[int, float]] = [dict(e) for e in edges] + [{}, {}]
    for i, c in enumerate(costs):
        if c > 0:
            room[source][i], room[i][source] = c, 0.0
        elif c < 0:
            room[i][sink], room[sink][i] = -c, 0.0
    while True:
        before = {source: source}
        queue = deque([source])
        while queue and sink not in before:
            a = queue.popleft()
            for b, c in room[a].items():
                if c > 1e-9 and b not in before:
                    before[b] = a
                    queue.append(b)
        if sink not in before:
            return [i in before for i in range(n)]
        path, b = [], sink
        while b != source:
            path.append((before[b], b))
            b = before[b]
        least = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= least
            room[b][a] = room[b].get(a, 0.0) + least


def labelled(costs: list[float], edges: list[dict[int, float]]) -> list[bool]:
    """The least-cost labelling: settled nodes first, a cut for the others."""
    label = settle(costs, edges)
    open_nodes = [i for i, x in enumerate(label) if x is None]
    if open_nodes:
        place = {i: k for k, i in enumerate(open_nodes)}
        rest = [costs[i] + sum((c if label[j] else -c) for j, c in edges[i].items() if label[j] is not None)
                for i in open_nodes]
        inner = [{place[j]: c for j, c in edges[i].items() if j in place} for i in open_nodes]
        for i, side in zip(open_nodes, minimum_cut(rest, inner)):
            label[i] = side
    return [bool(x) for x in label]


def labels_of(blocks: list[Block], model: Model) -> list[bool]:
    """True for the blocks of the main text."""
    if not blocks:
        return []
    for b in blocks:
        b.edges.clear()
    connect(blocks, model.edges)
    return labelled(costs_of(blocks, model), [b.edges for b in blocks])


def main_text(page: str | None, model: Model) -> str:
    """Content blocks of a page, one per line."""
    blocks = blocks_of(page) if page else []
    return "\n".join(b.text for b, keep in zip(blocks, labels_of(blocks, model)) if keep)


# --- training ------------------------------------------------------------

def examples(page: str) -> tuple[list[list[float]], list[float], list[float], list[float]]:
    """Features and labels of declared blocks, and how many pairs of them agree and differ by distance."""
    blocks = blocks_of(page)
    agree, differ = [0.0] * FAR, [0.0] * FAR
    for a, b, steps in pairs(blocks):
        if declared(blocks[a]) and declared(blocks[b]):
            (agree if declared(blocks[a]) == declared(blocks[b]) else differ)[steps] += 1
    known = [b for b in blocks if declared(b)]
    known = known[::-(-len(known) // SAMPLE_BLOCKS) or 1]
    return [features(b) for b in known], [float(declared(b) > 0) for b in known], agree, differ


def role_counts(page: str, model: Model) -> list[float]:
    """Blocks by label of the cut without roles and by role: boilerplate's -1, 0, 1, content's -1, 0, 1."""
    counts = [0.0] * 6
    blocks = blocks_of(page)
    for b, keep in zip(blocks, labels_of(blocks, model._replace(boilerplate=0.0, content=0.0))):
        counts[3 * keep + 1 + declared(b)] += 1
    return counts


def role_weights(counts: np.ndarray) -> tuple[float, float]:
    """Log likelihood ratios of the roles, boilerplate and content."""
    share = (counts.reshape(2, 3) + 0.5) / (counts.reshape(2, 3) + 0.5).sum(axis=1, keepdims=True)
    boilerplate, _, content = np.log(share[1] / share[0]).tolist()
    return (-min(max(-boilerplate, LEAST_HINT), MOST_HINT), min(max(content, 0.0), LEAST_HINT))


def learned(rows: list[tuple]) -> Model:
    """Weights and edges from ``examples`` of pages, roles left as they are."""
    if not rows:
        return INITIAL
    order = sorted(z for x, y, _, _ in rows for z in zip(map(list, x), y))
    agree, differ = (np.sum([r[k] for r in rows], axis=0) for k in (2, 3))
    return INITIAL._replace(weights=fit([x for x, _ in order], [y for _, y in order]),
                            edges=edges_of(agree, differ))


# --- Spark ---------------------------------------------------------------

def _examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([(half, *examples(page)) for half, page in zip(batch["half"], batch["html"])],
                           columns=["half", "x", "y", "agree", "differ"])


def train(pages: DataFrame) -> Model:
    """A model from a bounded sample of pages, one row of an id."""
    ids = (pages.where("html is not null and page_id is not null").select("page_id").distinct()
           .orderBy(F.xxhash64(F.lit(SEED), "page_id"), "page_id").limit(SAMPLE_PAGES))
    sample = cut_lineage(
        pages.select("page_id", "html").join(F.broadcast(ids), "page_id")
        .groupBy("page_id").agg(F.min("html").alias("html"))
        .select((F.xxhash64(F.lit(SEED + 1), "page_id") % 2 == 0).alias("half"), "html"))
    rows = [tuple(r) for r in sample.mapInPandas(
        _examples, "half boolean, x array<array<double>>, y array<double>, agree array<double>, "
                   "differ array<double>").collect()]
    halves = {half: learned([r[1:] for r in rows if r[0] != half]) for half in (True, False)}

    def _roles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [role_counts(page, halves[bool(half)])
                                      for half, page in zip(batch["half"], batch["html"])]})

    counts = [r["n"] for r in sample.mapInPandas(_roles, "n array<double>").collect()]
    discard(sample)
    if not counts:
        return INITIAL
    boilerplate, content = role_weights(np.sum(counts, axis=0))
    return learned([r[1:] for r in rows])._replace(boilerplate=boilerplate, content=content)


def extracted(model: Model, page: str = "html") -> Column:
    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, model) for p in pages], dtype=object)
    return text(page)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A null or empty page, and one without content, has an empty text. Repeated rows
    each get their row; an empty table gives an empty result; other columns are
    ignored. No text is dropped for its length, nor any part of a content block.
    """
    model = train(pages)
    return (pages.select("page_id", "url", extracted(model).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
