"""Main text of web pages by a tree-structured graphical model.

The nodes are a page's block elements and its runs of text; each is content or not. A node's own features (tag, words of
its class names, length, links, punctuation) give it a potential, and each parent and child share one. Sum-product
messages, from the leaves up and from the root down, give the exact chance that a node is content; text that is more
likely content than not is kept. The weights are fitted to labelled pages by gradient steps on their likelihood, which
the same messages give. Pages are handled many at a time, level by level of their trees.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.llm.labelled_pages import labelled_pages

KEEP_FROM = 0.5

# Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Never text of a page. But for head and title they may stand within a line, which goes on after them.
SILENT = frozenset(
    "script style template noscript iframe object svg math head title button select textarea datalist audio video canvas"
    " progress meter rp".split()
)
RAW = frozenset("script style title textarea noscript iframe".split())  # read up to their end tag
HEAD = frozenset("base link meta title style script noscript template".split())  # what may stand in a head
DRAWN = frozenset("svg math".split())  # blocks of a page end them, but not inside these:
EMBEDS = frozenset("foreignobject annotation-xml desc".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"),
}
SCOPES = frozenset("ul ol dl table select body html article section div main aside nav".split())  # they stop CLOSES
KNOWN = tuple(
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th pre blockquote figure figcaption"
    " nav header footer aside form button select option textarea fieldset body html menu dialog details summary address".split()
)
# Elements that begin and end a block; all others, also unknown ones, are part of the line they stand in.
BLOCKS = frozenset(KNOWN) - SILENT | frozenset(
    "head title address center hr fieldset legend hgroup search thead tbody tfoot caption colgroup col optgroup dir listing"
    " plaintext xmp frameset frame noframes marquee".split()
)
WORDS = tuple(
    "content article post entry main body text story page"
    " nav menu sidebar footer header ad advert advertisement sponsor promo cookie consent notice banner comment share"
    " social related widget popup modal newsletter subscribe login search breadcrumb pagination pager tag author copyright"
    " alert disclaimer legal toolbar recommend reply respons discussion navigation complementary contentinfo masthead byline".split()
)

TOKEN = re.compile(
    r"""<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)""",
    re.DOTALL,
)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
NEXT, REST = re.compile(r"(?=<)|\Z"), re.compile(r"\Z")
BODY = re.compile(r"(?=</head\b|<body\b)|\Z", re.IGNORECASE)
MARK = re.compile(r'\by="([01])"')
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_LEAF = ("short", "line", "medium", "long", "linked", "half_linked", "marked", "many_words", "comma", "copyright", "loose")
FEATURES = {
    name: i
    for i, name in enumerate(
        ["element", "leaf", "hidden", "other_tag", *(f"tag:{t}" for t in KNOWN), *(f"word:{w}" for w in WORDS), *_LEAF, *(f"in:{t}" for t in KNOWN)]
    )
}


@dataclass
class Tree:
    """A parsed page: for each node its parent (-1: root), whether it is text, its features, its label if there is one."""

    parent: list[int] = field(default_factory=list)
    leaf: list[bool] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    text: dict[int, str] = field(default_factory=dict)


def _name_words(attributes: str) -> list[int]:
    found = set()
    for groups in NAMED.findall(attributes):
        for part in PARTS.findall("".join(groups)):
            low = part.lower()
            for form in (low, low.removesuffix("s")):
                if f"word:{form}" in FEATURES:
                    found.add(FEATURES[f"word:{form}"])
    return sorted(found)


def _leaf_features(text: str, linked: int, tag: str) -> list[int]:
    n = len(text)
    found = ["leaf", "short" if n < 25 else "line" if n < 80 else "medium" if n < 300 else "long"]
    if linked * 2 > n:
        found.append("linked")
    elif linked * 5 > n:
        found.append("half_linked")
    if text[-1] in ".!?:;\"'…»”)":
        found.append("marked")
    if text.count(" ") >= 9:
        found.append("many_words")
    if "," in text:
        found.append("comma")
    if "©" in text:
        found.append("copyright")
    found.append(f"in:{tag}" if f"in:{tag}" in FEATURES else "loose")
    return [FEATURES[f] for f in found]


def parse(html: str | None) -> Tree:
    """The tree of a page. Unclosed, unopened and wrongly nested tags are taken as browsers would, roughly. A head ends
    at the first thing that may not stand in it; a silent element that is still open where the page ends, such as a
    template without end tag, does not silence what follows it."""
    tree, unclosed = _parse(html or "", frozenset())
    return _parse(html, unclosed)[0] if unclosed else tree


def _parse(html: str, heard: frozenset[int]) -> tuple[Tree, frozenset[int]]:
    """The tree of a page, and where its unclosed silent elements begin; those that begin at ``heard`` are not silent."""
    tree = Tree()
    stack: list[tuple[str, int, int]] = []  # tag, node, label
    depths: dict[str, list[int]] = {}  # of the open elements, by tag
    opened: list[tuple[str, int, int]] = []  # of the silent elements on the stack: tag, depth, where they begin
    endless: set[str] = set()  # tags of raw text that have no end tag any more
    pieces: list[str] = []
    linked = links = 0
    quiet = 0  # the depth from which on nothing is text; 0 if everything is

    def node(parent: int, leaf: bool, features: list[int], label: int) -> int:
        tree.parent.append(parent)
        tree.leaf.append(leaf)
        tree.features.append(features)
        tree.label.append(label)
        return len(tree.parent) - 1

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                tag, parent, label = stack[quiet - 1 if quiet else -1]
                tree.text[node(parent, True, _leaf_features(text, linked, tag), label)] = text
            pieces.clear()
        linked = 0

    def push(tag: str, at: int, label: int) -> None:
        depths.setdefault(tag, []).append(len(stack))
        stack.append((tag, at, label))

    def cut(depth: int) -> None:
        nonlocal quiet
        while opened and opened[-1][1] >= depth:
            opened.pop()
        for tag, _, _ in stack[depth:]:
            depths[tag].pop()
        del stack[depth:]
        if quiet >= depth:
            quiet = 0

    def leave_head() -> None:
        if stack[-1][0] == "head":
            cut(len(stack) - 1)

    def add(data: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head" and data.strip():
            leave_head()
        if data and not quiet:
            data = unescape(data)
            pieces.append(data)
            if links:
                linked += len(data.strip())

    push("", node(-1, False, [FEATURES["element"]], 0), 0)
    at, size = 0, len(html)
    while at < size:
        match = TOKEN.search(html, at)
        if not match:
            add(html[at:])
            break
        add(html[at : match.start()])
        at = match.end()
        tag = (match.group(2) or "").lower()
        if not tag:
            continue
        if stack[-1][0] == "head" and tag not in HEAD and (not match.group(1) or tag in ("body", "html", "br")) and tag != "head":
            leave_head()
        if tag not in BLOCKS and tag not in SILENT and tag not in EMBEDS:
            if tag == "br":
                add(" ")
            elif tag == "a" and not quiet:
                links = 0 if match.group(1) else 1
            continue
        within = tag in SILENT and tag not in BLOCKS  # a line goes on after it
        if match.group(1):  # an end tag closes up to its start, if there is one
            if depths.get(tag):
                depth = depths[tag][-1]
                if not within and (not quiet or depth < quiet):
                    flush()
                    links = 0
                cut(depth)
            continue
        if tag in VOID:
            if not quiet:
                flush()
            continue
        if tag == "head" and stack[-1][0] not in ("", "html"):
            continue
        if opened and tag == "body" and opened[0][0] == "head":  # ends it, whatever is open in it
            cut(opened[0][1])
        elif opened and opened[-1][0] in DRAWN and f"tag:{tag}" in FEATURES and tag in BLOCKS:
            cut(opened[-1][1])
        if not within and not quiet:
            flush()
            links = 0
            # A block ends an open paragraph; items, cells and the like end their predecessors.
            while stack[-1][0] == "p":
                cut(len(stack) - 1)
            for depth in range(len(stack) - 1, 0, -1) if any(depths.get(t) for t in CLOSES.get(tag, ())) else ():
                if stack[depth][0] in CLOSES[tag]:
                    cut(depth)
                    break
                if stack[depth][0] in SCOPES:
                    break
        _, parent, label = stack[-1]
        attributes = match.group(3)
        silent = tag in SILENT and match.start() not in heard
        if not quiet and not silent and tag in BLOCKS:
            if found := MARK.search(attributes):
                label = int(found.group(1))
            features = [FEATURES["element"], FEATURES.get(f"tag:{tag}", FEATURES["other_tag"])]
            if attributes:
                features += _name_words(attributes)
                if HIDDEN.search(attributes):
                    features.append(FEATURES["hidden"])
            parent = node(parent, False, features, label)
        if tag in RAW:
            end = None if tag in endless else re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
            if not end:
                # Without an end tag a title ends at the next tag, other silent text where the body begins.
                endless.add(tag)
                end = (NEXT if tag == "title" else REST if tag == "textarea" else BODY).search(html, at)
            if not silent:
                add(html[at : end.start()])
            at = end.end()
        elif not attributes.endswith("/"):
            push(tag, parent, label)
            if silent and not quiet:
                quiet = len(stack) - 1
            if tag in SILENT or tag in EMBEDS:
                opened.append((tag, len(stack) - 1, match.start()))
    flush()
    return tree, frozenset(start for tag, _, start in opened if tag in SILENT) - heard


# Kinds of nodes with potentials of their own: elements that hold others, elements that hold prose, runs of text.
BOX, TEXT, PROSE = 0, 1, 2
PROSE_TAGS = frozenset(FEATURES[f"tag:{t}"] for t in "p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption".split())


@dataclass
class Forest:
    """Many trees side by side, parents before children, as arrays; ``levels`` lists the nodes of each depth but the
    first, ``kind`` is the potential that a node shares with its parent."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    rows: np.ndarray
    columns: np.ndarray
    starts: list[int]


def forest(trees: list[Tree]) -> Forest:
    starts, parent, kind, rows, columns, depth = [], [], [], [], [], []
    for tree in trees:
        first = len(parent)
        starts.append(first)
        for i, (p, leaf, features) in enumerate(zip(tree.parent, tree.leaf, tree.features, strict=True)):
            parent.append(p + first if p >= 0 else -1)
            depth.append(depth[p + first] + 1 if p >= 0 else 0)
            kind.append(TEXT if leaf else PROSE if any(f in PROSE_TAGS for f in features) else BOX)
            rows += [first + i] * len(features)
            columns += features
    deep = np.array(depth, dtype=np.int64)
    order = np.argsort(deep, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(deep))[:-1])[1:] if len(deep) else []
    arrays = (np.array(x, dtype=np.int64) for x in (parent, kind))
    return Forest(*arrays, levels, np.array(rows, dtype=np.int64), np.array(columns, dtype=np.int64), starts)


@dataclass
class Model:
    """Weights of the features (for content against not) and, for each kind of node, potentials [kind, parent, child]."""

    weight: np.ndarray
    pair: np.ndarray

    def beliefs(self, trees: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log beliefs of all nodes, what came up to each node, and the message each sent to its parent."""
        n = len(trees.parent)
        up = np.zeros((n, 2))
        up[:, 1] = np.bincount(trees.rows, self.weight[trees.columns], n)
        sent = np.zeros((n, 2))
        for level in reversed(trees.levels):
            ways = up[level][:, None, :] + self.pair[trees.kind[level]]  # [node, parent's state, own state]
            sent[level] = np.logaddexp(ways[:, :, 0], ways[:, :, 1])
            np.add.at(up, trees.parent[level], sent[level])
        belief = up.copy()
        for level in trees.levels:
            above = belief[trees.parent[level]] - sent[level]
            ways = above[:, :, None] + self.pair[trees.kind[level]]
            belief[level] = up[level] + np.logaddexp(ways[:, 0, :], ways[:, 1, :])
        return belief, up, sent

    def content(self, trees: Forest) -> np.ndarray:
        """The chance of each node to be content."""
        belief = self.beliefs(trees)[0]
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))


def fit(pages: list[str], steps: int = 500, rate: float = 0.15, damping: float = 0.001) -> Model:
    """Weights that make the labels of the pages likely, by gradient steps (Adam) on their log-likelihood."""
    parsed = [parse(p) for p in pages]
    trees = forest(parsed)
    label = np.array([y for t in parsed for y in t.label])
    model = Model(np.zeros(len(FEATURES)), np.zeros((3, 2, 2)))
    child = np.flatnonzero(trees.parent >= 0)
    seen = np.zeros((3, 2, 2))
    np.add.at(seen, (trees.kind[child], label[trees.parent[child]], label[child]), 1)
    observed = np.bincount(trees.columns, label[trees.rows], len(FEATURES))
    moment = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weight, model.pair)]
    for step in range(1, steps + 1):
        belief, up, sent = model.beliefs(trees)
        chance = 1 / (1 + np.exp(belief[:, 0] - belief[:, 1]))
        expected = np.bincount(trees.columns, chance[trees.rows], len(FEATURES))
        both = (belief[trees.parent[child]] - sent[child])[:, :, None] + model.pair[trees.kind[child]] + up[child][:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        both /= both.sum(axis=(1, 2), keepdims=True)
        pairs = np.stack([both[trees.kind[child] == k].sum(axis=0) for k in (BOX, TEXT, PROSE)])
        slopes = ((observed - expected) / len(pages) - damping * model.weight, (seen - pairs) / len(pages) - damping * model.pair)
        for x, slope, (first, second) in zip((model.weight, model.pair), slopes, moment, strict=True):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            x += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return model


def extract(pages: list[str | None], model: Model, keep_from: float = KEEP_FROM) -> list[str]:
    """The main text of each page; empty where there is none."""
    trees = [parse(p) for p in pages]
    if not trees:
        return []
    together = forest(trees)
    content = model.content(together)
    return [
        "\n\n".join(text for i, text in tree.text.items() if content[start + i] >= keep_from)
        for tree, start in zip(trees, together.starts, strict=True)
    ]


def main_text(html: Column, model: Model, keep_from: float = KEEP_FROM) -> Column:
    @pandas_udf("string")
    def compute(pages: pd.Series) -> pd.Series:
        return pd.Series(extract(pages.tolist(), model, keep_from), dtype=object)

    return compute(html)


def extracted(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` of all rows of ``pages`` (page_id, url, html, more). Null and empty pages have
    an empty text; repeated rows are read each, other columns left behind, and an empty table gives no rows. The work goes
    with the length of a page, however deep its elements are nested."""
    model = model or fit(labelled_pages())
    found = pages.select("page_id", "url", main_text(F.col("html"), model).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
