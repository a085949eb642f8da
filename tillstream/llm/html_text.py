"""Main text of web pages by boosted trees over DOM nodes.

A page is read into a tree of block elements; inline elements belong to the text around them. Every block node
is described by its tag and attribute words, depth, place among its siblings, text density of its subtree,
share of link text, how much of the page comes before it, its size against its largest sibling, and the same of its parent. Boosted regression trees give the probability that a node lies
in the main content. A dynamic program over the tree then picks the most likely consistent labelling: below a
node that is left out everything is left out, and a frame around the content never lies inside it.

The trees are trained on a bounded sample of the pages that name a content element; where no page does, the density
of text stands in for them. Their nodes get labels from the words that name an
element's role (fixed lists below), and each sample page is also seen in other dress: roles named otherwise or
not at all (in most copies), and with comments, forms, notices and side columns put in from the page's own boilerplate.

Reading and labelling take time in proportion to the page, however deep or wide it is.

Defined cases: null html counts as empty; a page without content gives an empty text; unclosed and misnested
elements are closed by what follows; a tag cut off at the end is dropped; a page id or page that is repeated gives
equal rows; an empty table gives an empty result; columns of any other name are ignored.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.base import filled, written

SAMPLE_PAGES = 200
SCORED_TOGETHER = 100
DENSE = 10  # characters per element from which text is content where no page names a content element
TREES, DEPTH, RATE, BINS = 60, 4, 0.25, 32
DRESSED, BARE = 3, 0.6  # further copies of a sample page, and the share of those without any role names
DRESSED_DEPTH = 200  # sample pages nested deeper are learnt from as they are

# HTML element names by how they are read, and words that name an element's role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe template select option".split())
FORMULA = frozenset(
    "math maction annotation annotation-xml menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
DRAWING = frozenset(
    "svg circle clippath defs desc ellipse filter foreignobject g image line lineargradient marker mask metadata path pattern "
    "polygon polyline radialgradient rect stop symbol text textpath tspan use".split()
)
INLINE = FORMULA | DRAWING | frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
EMBEDDED = frozenset("audio button canvas noscript object video".split())  # nodes that may stand in a paragraph
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption caption summary address".split())
PLAIN = frozenset("#document html body ul ol dl table tr tbody thead".split())  # names that tell a form, not a role
CONTENT_TAGS = frozenset("article main".split())
ASIDE_TAGS = frozenset("nav aside footer header form fieldset dialog menu head figure-controls".split())
CONTENT_WORDS = frozenset("article content main post entry story body text".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner nav navigation navbar menu breadcrumb breadcrumbs footer "
    "header masthead sidebar side aside widget related recommended share sharing social comment comments reply replies "
    "respond disqus cookie cookies consent notice notices alert popup modal newsletter subscribe signup login search form "
    "toolbar pager pagination copyright legal".split()
)
CLOSES = {  # an open element of the value's kinds ends where the key's tag starts
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
_KEEP_OPEN = {
    "li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
}

# Comments, declarations, tags with quoted attributes, and tags whose quotes do not close.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
# Finds every page in which an element has a content tag or word, and some others.
_NAMES_CONTENT = (
    rf"(?i)<(?:{'|'.join(sorted(CONTENT_TAGS))})[\s/>]"
    r"|(?:class|id|role)\s*=\s*(?:\"[^\"]*|'[^']*|[^\s>]*)(?<![a-z])"
    rf"(?:{'|'.join(sorted(CONTENT_WORDS))})(?![a-z])"
)


@dataclass
class Node:
    tag: str
    words: frozenset[str]
    parent: int
    depth: int
    children: list = field(default_factory=list)  # numbers of nodes, and texts between them
    end: int = 0  # number after its last descendant


def parse(page: str) -> list[Node]:
    """Block elements in page order; node 0 is the document. Texts are (text, is inside a link)."""
    nodes = [Node("#document", frozenset(), -1, 0)]
    open_nodes, at, link = [0], 0, 0

    def say(text: str) -> None:
        if text:
            nodes[open_nodes[-1]].children.append((text, link > 0))

    opened: Counter[str] = Counter()  # by name, so that a tag is looked for only where it is

    def close(*names: str) -> None:
        """Ends the innermost open element of these names, and all inside it."""
        while True:
            tag = nodes[open_nodes.pop()].tag
            opened[tag] -= 1
            if tag in names:
                return

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            say(html.unescape(page[at:]))
            break
        if found.start() > at:
            say(html.unescape(page[at : found.start()]))
        at = found.end()
        ends, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if not ends and tag in RAW and not rest.endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if stop:
                close_at = page.find(">", stop.start())
                at = len(page) if close_at < 0 else close_at + 1
            elif tag in ("script", "style", "title", "textarea"):
                at = len(page)
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if ends else 1
            elif tag in ("br", "img", "wbr"):
                say(" ")
            continue
        if tag in VOID or tag in RAW:
            if tag == "hr":
                nodes[open_nodes[-1]].children.append(None)
            continue
        if ends:
            if opened[tag]:
                close(tag)
                link = 0
            continue
        link = 0
        while opened["p"] and tag not in EMBEDDED:  # a paragraph ends where a block starts
            close("p")
        if any(opened[name] for name in CLOSES.get(tag, ())):
            for number in reversed(open_nodes):
                name = nodes[number].tag
                if name in _KEEP_OPEN[tag]:
                    break
                if name in CLOSES[tag]:
                    close(name)
                    break
        words = frozenset(_WORD.findall(" ".join("".join(m.groups("")) for m in _ATTRIBUTE.finditer(rest)).lower()))
        nodes.append(Node(tag, words, open_nodes[-1], nodes[open_nodes[-1]].depth + 1))
        nodes[open_nodes[-1]].children.append(len(nodes) - 1)
        if not rest.endswith("/"):
            open_nodes.append(len(nodes) - 1)
            opened[tag] += 1
    for number in range(len(nodes) - 1, -1, -1):
        nodes[number].end = max(nodes[number].end, number + 1)
        if number:
            nodes[nodes[number].parent].end = max(nodes[nodes[number].parent].end, nodes[number].end)
    return nodes


N_OWN = 20


@functools.lru_cache(10_000)
def _role(tag: str, words: frozenset[str]) -> tuple[bool, ...]:
    """What an element's names say of it: content, aside, paragraph, page, list, heading."""
    content = tag in CONTENT_TAGS or bool(words & CONTENT_WORDS)
    aside = tag in ASIDE_TAGS or bool(words & ASIDE_WORDS)
    heading = tag.startswith("h") and tag[1:].isdigit()
    page = tag in ("html", "body", "#document")
    return content, aside, tag in PARAGRAPHS, page, tag in ("ul", "ol", "li"), heading


def node_features(nodes: list[Node]) -> np.ndarray:
    """A row per node: its own figures, then its parent's."""
    n = len(nodes)
    totals = text, linked, paragraphs, count = [[0.0] * n for _ in range(4)]
    said, place, width = [0.0] * n, [0] * n, [0] * n  # said: by the element itself
    for number in range(n - 1, -1, -1):
        node, elements = nodes[number], 0
        for child in node.children:
            if isinstance(child, int):
                place[child] = elements
                elements += 1
            elif child is not None:
                size = len(child[0].strip())
                said[number] += size
                linked[number] += size * child[1]
        width[number] = elements
        text[number] += said[number]
        count[number] += 1
        paragraphs[number] += node.tag in PARAGRAPHS
        if number:
            for total in totals:
                total[node.parent] += total[number]
    roles, inside = [_role(node.tag, node.words) for node in nodes], []
    for number, node in enumerate(nodes):  # a name of content, of an aside, of the element or of one around it
        content, aside = inside[node.parent] if number else (False, False)
        inside.append((content or roles[number][0], aside or roles[number][1]))
    parents = np.array([max(node.parent, 0) for node in nodes])
    text, linked, paragraphs, count, said, place, width = map(np.array, (*totals, said, place, width))
    largest = np.zeros(n)
    np.maximum.at(largest, parents[1:], text[1:])
    above, beside = text[parents], largest[parents]
    above[0] = beside[0] = text[0]
    own = np.column_stack(
        [
            roles, np.minimum([node.depth for node in nodes], 30), np.minimum(place, 64), np.minimum(width[parents], 64),
            np.log1p(text), np.log1p(text / count), linked / np.maximum(text, 1), np.log1p(paragraphs),
            text / np.maximum(above, 1), text / max(text[0], 1), inside,
            (np.cumsum(said) - said) / max(text[0], 1), text / np.maximum(beside, 1), np.minimum(width[parents] - place, 64),
        ]
    )
    return np.concatenate([own, own[parents, :13]], axis=1).astype(np.float32)


def taught(nodes: list[Node]) -> np.ndarray:
    """Whether each node lies in the content, by the words that name roles."""
    out = np.zeros(len(nodes), bool)
    for number, node in enumerate(nodes):
        inside = number > 0 and out[node.parent]
        content = node.tag in CONTENT_TAGS or bool(node.words & CONTENT_WORDS)
        aside = node.tag in ASIDE_TAGS or (bool(node.words & ASIDE_WORDS) and node.tag not in CONTENT_TAGS)
        above = number > 0 and getattr(nodes[node.parent], "left_out", False)
        node.left_out = above or (aside and node.tag not in ("html", "body"))
        out[number] = not node.left_out and (inside or (content and node.tag not in ("html", "body")))
    return out


def _dressed(page: str, rng: np.random.Generator) -> tuple[list[Node], np.ndarray] | None:
    """A sample page whose roles are named otherwise, with further boilerplate put in, and its nodes' labels."""
    nodes = parse(page)
    labels = taught(nodes)
    if not labels.any() or max(node.depth for node in nodes) > DRESSED_DEPTH:
        return None
    if rng.random() < BARE:
        return _bare(nodes, labels)
    texts = [text for node, inside in zip(nodes, labels) if not inside for text in _own_texts(node) if text.strip()]
    mode = rng.integers(3)
    blocks = []
    for _ in range(rng.integers(1, 4)):
        words = sorted(ASIDE_WORDS)[rng.integers(len(ASIDE_WORDS))]
        tag = ("div", "aside", "section", "form", "footer")[rng.integers(5)]
        said = [html.escape(texts[rng.integers(len(texts))]) for _ in range(rng.integers(1, 5))] if texts else []
        body = "".join(f"<p>{text}</p>" for text in said)
        linked = f"<ul><li><a href='#'>{words}</a></li></ul>" if rng.random() < 0.4 else ""
        blocks.append(f'<{tag} class="{words}">{body}{linked}</{tag}>')
    root = next(number for number, inside in enumerate(labels) if inside)
    out: list[str] = []

    def emit(number: int) -> None:
        node = nodes[number]
        tag, names = node.tag, " ".join(sorted(node.words))
        if number == root or node.tag in CONTENT_TAGS:
            names = sorted(CONTENT_WORDS)[rng.integers(len(CONTENT_WORDS))] if mode == 1 else "" if mode == 2 else names
            tag = "div" if mode else tag
        elif node.left_out and number and not nodes[node.parent].left_out and mode == 1:
            tag, names = "div", sorted(ASIDE_WORDS)[rng.integers(len(ASIDE_WORDS))]
        if number:
            out.append(f'<{tag} class="{names}">' if names else f"<{tag}>")
        for child in node.children:
            if isinstance(child, int):
                if child == root and rng.random() < 0.5 and blocks:
                    out.append(blocks.pop())
                emit(child)
            elif child is not None:
                text = html.escape(child[0])
                out.append(f"<a href='#'>{text}</a>" if child[1] else text)
        if number == root and blocks and rng.random() < 0.5:
            out.append(blocks.pop())
        if number:
            out.append(f"</{tag}>")
        if number == root:
            out.extend(blocks)
            blocks.clear()

    emit(0)
    again = parse("".join(out))
    # labels follow the names; without names (mode 2) the root is the node whose text starts the content
    want = taught(again)
    if mode == 2:
        opening = _opening(nodes, root)
        wide = (number for number, node in enumerate(again) if node.tag == "div" and _opening(again, number) == opening)
        first = next(wide, None)
        if first is None:
            return None
        for number in range(first, again[first].end):
            want[number] = not again[number].left_out
    return again, want


def _bare(nodes: list[Node], labels: np.ndarray) -> tuple[list[Node], np.ndarray]:
    """The page with no name that tells a role: containers are all alike, classes and ids are gone."""
    renamed = [
        Node(node.tag if node.tag in PARAGRAPHS or node.tag in PLAIN else "div", frozenset(), node.parent, node.depth, node.children, node.end)
        for node in nodes
    ]
    return renamed, labels


def _own_texts(node: Node) -> list[str]:
    return [child[0] for child in node.children if isinstance(child, tuple)]


def _opening(nodes: list[Node], number: int, size: int = 40) -> str:
    """The first characters of an element's text."""
    said = ""
    for node in nodes[number : nodes[number].end]:
        said += "".join(_own_texts(node))
        if len(said) >= size:
            break
    return said[:size]


@dataclass
class Trees:
    """Complete regression trees: split feature and cut of every inner node, and value of every leaf."""

    base: float
    split: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out, lines = np.full(len(rows), self.base), np.arange(len(rows))
        for split, cut, value in zip(self.split, self.cut, self.value):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[lines, split[at]] > cut[at])
            out += value[at - len(split)]
        return out


def boost(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Gradient boosting with the logistic loss; cuts lie between quantiles of a feature."""
    y, n_features = labels.astype(float), rows.shape[1]
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(edges[f], rows[:, f], side="left") for f in range(n_features)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base, inner, leaves = float(np.log(share / (1 - share))), 2**DEPTH - 1, 2**DEPTH
    margin, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        split, cut, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(leaves)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            best = 1e-6
            if len(here) > 1:
                g, h = slope[here], bend[here]
                whole = g.sum() ** 2 / (h.sum() + 1)
                for f in range(n_features):
                    if not len(edges[f]):
                        continue
                    size = len(edges[f]) + 1
                    left_g = np.cumsum(np.bincount(binned[here, f], g, size))[:-1]
                    left_h = np.cumsum(np.bincount(binned[here, f], h, size))[:-1]
                    gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - whole
                    if gain.max() > best:
                        best, split[node], cut[node] = gain.max(), f, edges[f][gain.argmax()]
            at[here] = 2 * node + 1 + (rows[here, split[node]] > cut[node])
        leaf = at - inner
        value = RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + 1)
        margin += value[leaf]
        trees.append((split, cut, value))
    return Trees(base, *(np.stack(part) for part in zip(*trees)))


def decode(nodes: list[Node], margin: np.ndarray) -> np.ndarray:
    """The most likely labelling: 0 frame, 1 content, 2 left out; frames only in frames, all left out below left out."""
    n = len(nodes)
    yes, no = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
    best = np.stack([no, yes, no], axis=1)
    for number in range(n - 1, 0, -1):
        up, own = best[nodes[number].parent], best[number]
        up[0] += own.max()
        up[1] += max(own[1], own[2])
        up[2] += own[2]
    label = np.zeros(n, np.int64)
    label[0] = 0 if best[0, 0] >= best[0, 1] else 1
    for number in range(1, n):
        above = label[nodes[number].parent]
        own = best[number]
        label[number] = 2 if above == 2 else own.argmax() if above == 0 else 1 if own[1] >= own[2] else 2
    return label


def blocks(nodes: list[Node], label: np.ndarray) -> list[str]:
    """Texts of the content nodes in page order, white space made single spaces, empty ones left out."""
    out: list[str] = []

    def finish(parts: list[str]) -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    waiting, todo = [], [(0, 0)]
    while todo:
        number, at = todo.pop()
        children = nodes[number].children
        while at < len(children):
            child = children[at]
            at += 1
            if isinstance(child, tuple):
                if label[number] == 1:
                    waiting.append(child[0])
                continue
            finish(waiting)
            if child is not None:
                todo.append((number, at))
                number, at, children = child, 0, nodes[child].children
        finish(waiting)
    return out


def fit(pages: DataFrame, size: int = SAMPLE_PAGES) -> Trees | None:
    """Trees learnt from `size` of the pages that name a content element; None if there is no such page.

    Those with the smallest hash of their id are taken. A page that seems to name one may not (it stands in a menu, or
    in a text); only when the whole sample is such, all pages are read for the sample.
    """
    named = pages.where(filled(F.col("html")).rlike(_NAMES_CONTENT))
    return _learnt(named, size) or _learnt(_naming_content(named), size)


def _naming_content(pages: DataFrame) -> DataFrame:
    def keep(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part[[bool(taught(parse(page)).any()) for page in part["html"]]]

    rows = pages.select("page_id", filled(F.col("html")).alias("html"))
    return rows.mapInPandas(keep, rows.schema)


def _learnt(pages: DataFrame, size: int) -> Trees | None:
    ids = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(size)
    ids = written(ids, "page-sample")
    some = pages.join(ids, "page_id").groupBy("page_id").agg(F.min(filled(F.col("html"))).alias("html"))
    sample = [row["html"] for row in some.orderBy("page_id").collect()]
    rng, rows, labels = np.random.default_rng(7), [], []
    for page in sample:
        nodes = parse(page)
        seen = [(nodes, taught(nodes))] if page else []
        seen += [dressed for dressed in (_dressed(page, rng) for _ in range(DRESSED)) if dressed]
        for tree, want in seen:
            rows.append(node_features(tree))
            labels.append(want)
    if not rows or not np.concatenate(labels).any():
        return None
    return boost(np.concatenate(rows), np.concatenate(labels))


def by_density(rows: np.ndarray) -> np.ndarray:
    """Margins without trees: characters outside links per element, of a paragraph's parent too, against a fixed number."""
    own = np.log1p(np.expm1(rows[:, 10]) * (1 - rows[:, 11]))
    above = np.log1p(np.expm1(rows[:, N_OWN + 10]) * (1 - rows[:, N_OWN + 11]))
    dense = np.where((rows[:, 2] > 0) & (rows[:, 11] < 0.5), np.maximum(own, above), own)
    return np.where(rows[:, 16] > 0, -3.0, dense - np.log1p(DENSE))


def extract(pages: list[str], trees: Trees | None) -> list[str]:
    """Main text of each page; the nodes of some pages go through the trees together. Without trees density decides."""
    out, score = [], trees.margin if trees else by_density
    for first in range(0, len(pages), SCORED_TOGETHER):
        parsed = [parse(page) for page in pages[first : first + SCORED_TOGETHER]]
        margins = score(np.concatenate([node_features(nodes) for nodes in parsed]))
        at = 0
        for nodes in parsed:
            label = decode(nodes, margins[at : at + len(nodes)])
            out.append("\n".join(blocks(nodes, label)))
            at += len(nodes)
    return out


def main_text(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """One row per page: page_id, url, text and its number of characters."""
    trees = trees or fit(pages)

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = extract(list(part["html"]), trees)
            ids, sizes = part["page_id"].astype("Int64"), [len(text) for text in texts]
            yield pd.DataFrame({"page_id": ids, "url": part["url"], "text": texts, "n_chars": sizes})

    page_id, url = F.col("page_id").cast("bigint"), F.col("url").cast("string")
    rows = pages.select(page_id.alias("page_id"), url.alias("url"), filled(F.col("html")).alias("html"))
    return rows.mapInPandas(read, "page_id bigint, url string, text string, n_chars bigint")
