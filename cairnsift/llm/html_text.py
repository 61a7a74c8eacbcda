"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks with features. A logistic classifier gives each block a cost of being called content
and one of being called boilerplate; these are the capacities of its edges to the two terminals. Neighbouring blocks, and
blocks that follow each other under one parent, are joined by smoothness edges. The minimum cut, found by maximum flow,
is the labelling of least total cost. Blocks whose own costs outweigh all their smoothness edges are settled first, which
changes no cut and leaves a small graph.

The classifier is fitted on blocks of at most ``SAMPLE_PAGES`` pages (those with the least hash of their id) which the
page's own markup labels: inside an article or main element, or inside menus, footers, adverts and the like. It starts
from fixed weights and is held near them, so that features which the sample lacks keep a sensible weight, and an empty
table leaves the fixed weights.

Null and empty pages have no text. Broken, cut-off or deeply nested markup is read as far as it goes. Pages are read one
by one: repeated rows and ids and other columns make no difference.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairnsift.llm.text_arrays import slices

SAMPLE_PAGES = 300
ADJACENT = 0.6
SIBLING = 0.6
HELD = 2.0  # how strongly fitted weights are held near the fixed ones, in blocks

# Element names, and words in class, id and role attributes that mark what is not the article.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math object button".split())
OFF = frozenset("nav header footer aside form menu dialog select search fieldset".split())
MAIN = frozenset("article main".split())
HINT = re.compile(r"(?<![a-z])(?:ads?|adverts?|advertisement|banner|promo|promotion|sponsor(?:ed)?|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|comments?|disqus|repl(?:y|ies)|respond|sidebar|side-?bar|menu|nav|navbar|navigation|footer|header|masthead|share|sharing|social|related|recommended|breadcrumbs?|subscribe|newsletter|login|signup|widget|pager|pagination|toolbar|hidden)(?![a-z])")
MAIN_HINT = re.compile(r"(?<![a-z])(?:article-?body|main-?content|post-?content|entry-?content|story-?body)(?![a-z])")

FEATURES = ("bias", "in_main", "in_off", "hint", "link_share", "log_words", "sentence", "item", "heading")
PRIOR = np.array([-0.5, 3.0, -6.0, -7.0, -3.0, 0.5, 0.8, -0.5, 0.5])

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(>|\Z)""", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)


@dataclass
class Block:
    text: str
    parent: int
    features: list[float]
    label: int | None  # what the markup says: 1 content, 0 boilerplate


@dataclass
class Element:
    name: str
    number: int
    main: bool
    off: bool
    hint: bool


def opened(name: str, attributes: str, above: Element, number: int) -> Element:
    main, off, hint = above.main or name in MAIN, above.off, above.hint
    if name in OFF and not (name == "header" and above.main):
        off = True
    if attributes and name not in ("html", "body"):
        for m in NAMES.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                hint = True
            elif key in ("class", "id", "role", "itemprop"):
                spaced = value.replace("_", "-")
                if MAIN_HINT.search(spaced) or (key == "role" and value == "main"):
                    main = True
                elif HINT.search(spaced):
                    hint = True
    return Element(name, number, main, off, hint)


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, white space inside each as single blanks."""
    out: list[Block] = []
    stack = [Element("", 0, False, False, False)]
    parts: list[str] = []
    linked = 0
    in_link = False
    count = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                e = stack[-1]
                words = text.count(" ") + 1
                share = min(1.0, linked / max(1, len(text)))
                out.append(Block(text, e.number, [1.0, float(e.main and not e.off), float(e.off), float(e.hint), share, math.log1p(words), float(text[-1] in ".!?…:;\"”»)"),
                                                  float(e.name in ("li", "td", "th", "dt", "dd")), float(len(e.name) == 2 and e.name[0] == "h" and e.name[1].isdigit())],
                                 0 if e.off or e.hint else 1 if e.main else None))
            parts.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        text = page[at: m.start() if m else end]
        if text:
            parts.append(text)
            if in_link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name, ending = m[2].lower(), bool(m[1])
        if not m[4]:
            break  # the page ends inside a tag
        if name in RAW and not ending:
            if not m[3].endswith("/"):
                over = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                at = over.end() if over else end
            parts.append(" ")
        elif name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = not ending
        elif name in BLOCK:
            close()
            in_link = False
            if ending:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        del stack[k:]
                        break
            elif name not in VOID:
                if stack[-1].name == "p" or (name == "li" and stack[-1].name == "li"):
                    stack.pop()
                count += 1
                stack.append(opened(name, m[3], stack[-1], count))
        # Inline elements open no block; one that is hidden or named as an advert is rare and stays part of its block.
    close()
    return out


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it is content: maximises the sum of the content nodes' ``gain`` less the weight of the edges
    between unlike nodes. ``gain`` is the cost of calling a node boilerplate less that of calling it content."""
    n = len(gain)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    pull = list(gain)
    weight = [sum(w for _, w in x) for x in near]
    label: list[bool | None] = [None] * n
    todo = [i for i in range(n) if abs(pull[i]) >= weight[i]]
    while todo:
        i = todo.pop()
        if label[i] is not None:
            continue
        label[i] = pull[i] > 0
        for j, w in near[i]:
            if label[j] is None:
                pull[j] += w if label[i] else -w
                weight[j] -= w
                if abs(pull[j]) >= weight[j]:
                    todo.append(j)
    free = [i for i in range(n) if label[i] is None]
    if free:
        content = max_flow_side(free, pull, [(a, b, w) for a, b, w in edges if label[a] is None and label[b] is None])
        for i in free:
            label[i] = i in content
    return [bool(x) for x in label]


def max_flow_side(nodes: list[int], pull: list[float], edges: list[tuple[int, int, float]]) -> set[int]:
    """The nodes on the source's side of a minimum cut, by shortest augmenting paths."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}} | {i: {} for i in nodes}
    for i in nodes:
        a, b, c = (source, i, pull[i]) if pull[i] > 0 else (i, sink, -pull[i])
        room[a][b] = room[a].get(b, 0.0) + c
        room[b].setdefault(a, 0.0)
    for a, b, w in edges:
        room[a][b] = room[a].get(b, 0.0) + w
        room[b][a] = room[b].get(a, 0.0) + w
    while True:
        back, line = {source: source}, deque([source])
        while line and sink not in back:
            a = line.popleft()
            for b, c in room[a].items():
                if c > 1e-9 and b not in back:
                    back[b] = a
                    line.append(b)
        if sink not in back:
            return set(back)
        path, b = [], sink
        while b != source:
            path.append((back[b], b))
            b = back[b]
        least = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= least
            room[b][a] += least


def extract(page: str | None, weights: np.ndarray = PRIOR) -> str:
    """The main text: content blocks joined by line breaks."""
    if not page:
        return ""
    found = blocks(page)
    if not found:
        return ""
    # log p - log (1 - p), the difference of the two costs.
    gain = (np.array([b.features for b in found]) @ weights).tolist()
    edges = [(i, i + 1, ADJACENT) for i in range(len(found) - 1)]
    latest: dict[int, int] = {}
    for i, b in enumerate(found):
        parent = b.parent
        if parent in latest:
            edges.append((latest[parent], i, SIBLING))
        latest[parent] = i
    return "\n".join(b.text for b, keep in zip(found, min_cut(gain, edges)) if keep)


def fit(pages: list[str | None]) -> np.ndarray:
    """Weights from the blocks which the markup labels, by Newton steps around the fixed weights."""
    rows = [(b.features, b.label) for p in pages if p for b in blocks(p) if b.label is not None]
    weights = PRIOR.copy()
    if not rows:
        return weights
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    balance = np.where(y == 1, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum())) * len(y)
    # Weights are per block, scaled to a sample of 100 blocks, so that a large sample does not drown the fixed values.
    balance *= 100 / len(y)
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (balance * (y - p)) - HELD * (weights - PRIOR)
        bend = (x * (balance * p * (1 - p))[:, None]).T @ x + HELD * np.eye(len(weights))
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def sampled(pages: DataFrame, page_id: str, page: str, limit: int) -> list[str | None]:
    ids = [r[0] for r in pages.where(F.col(page_id).isNotNull()).select(page_id).orderBy(F.xxhash64(page_id), page_id).limit(limit).collect()]
    return [r[0] for r in pages.where(F.col(page_id).isin(ids)).select(page).limit(2 * limit).collect()] if ids else []


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row."""
    weights = fit(sampled(pages, page_id, page, sample_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [extract(p, weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars bigint")
