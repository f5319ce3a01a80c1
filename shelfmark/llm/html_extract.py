"""Main text of pages: gradient-boosted trees weigh DOM nodes, and a decoding over the tree keeps choices consistent."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.dom import NEVER_TEXT, Page, blocks, parse
from shelfmark.llm.text import Batches, in_batches, materialise, per_row, sliced

TRAINING_PAGES = 1500  # about as many pages are learned from, by hash
TREES, DEPTH = 12, 4
CLIP = 4.0  # the trees' margins, either way
NAMED = 6.0  # log odds against a node that is another part by its element or a whole name, or that isn't shown
MARKED = 3.0  # and against one that only a word within a name puts there, which the trees can outweigh

# Words in class, id and role attributes.
CONTENT_TOKENS = frozenset("article articlebody post postbody entry story content main maincontent body text".split())
OTHER_TOKENS = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promoted banner cookie cookies consent gdpr notice alert popup modal "
    "overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget related recommended recommendations share "
    "sharing social comment comments reply replies disqus newsletter subscribe subscription signup login footer masthead topbar "
    "toolbar pagination pager search complementary contentinfo hidden tags tagcloud copyright legal disclaimer toc skip".split()
)
PLAIN_TOKENS = frozenset(  # which say nothing of the part beside one of those
    "area article articles bar block bottom box button buttons col column container entry form group holder icon icons inner item items left "
    "link links list outer page panel post posts right row section site story top unit wrap wrapper".split()
)
OTHER_ELEMENTS = frozenset("nav footer aside form menu search".split())
MAIN_ELEMENTS = frozenset(["article", "main"])
ELEMENTS = ("p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "div", "section", "td", "table", "blockquote", "pre", "header", "dd")


@dataclass
class Marks:
    """What a node's name and attributes say, and its ancestors' do."""

    main: bool
    other: bool
    in_main: bool
    in_other: bool
    by_name: bool = False  # another part by its element, or not shown
    by_word: bool = False  # another part by a whole name in its attributes


def _names(node, in_main: bool) -> list[set[str]]:
    """The words of each name in attributes; in a main part without ids, which headings give, and classes of tags, categories and what isn't there."""
    text = " ".join(node.attributes.get(k, "") for k in ("class", "role", "itemprop") + (() if in_main else ("id",)))
    if in_main:
        text = re.sub(r"(?i)(?<!\S)(?:tag|category|cat|no)[-_]\S*", " ", text)
    return [set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())) for name in text.split()]


def _marks(page: Page) -> list[Marks]:
    holds_main = [False] * len(page.nodes)
    for i in range(len(page.nodes) - 1, 0, -1):
        if page.nodes[i].name in MAIN_ELEMENTS or holds_main[i]:
            holds_main[page.nodes[i].parent] = True
    marks: list[Marks] = []
    for i, node in enumerate(page.nodes):
        above = marks[node.parent] if i else Marks(False, False, False, False)
        element = node.name in MAIN_ELEMENTS  # no word of its attributes makes it another part
        names = _names(node, above.in_main or element) if node.attributes else []
        tokens = set().union(*names)
        unseen = "hidden" in node.attributes or re.search(r"display\s*:\s*none", node.attributes.get("style", "")) is not None
        header = node.name == "header" and not above.in_main
        other = unseen or (
            not holds_main[i] and node.name not in ("html", "body") and (node.name in OTHER_ELEMENTS or header or (not element and bool(tokens & OTHER_TOKENS)))
        )
        main = not other and (node.name in MAIN_ELEMENTS or bool(tokens & CONTENT_TOKENS))
        by_name = other and (unseen or header or node.name in OTHER_ELEMENTS)
        by_word = other and any(x & OTHER_TOKENS and x <= OTHER_TOKENS | PLAIN_TOKENS for x in names)
        marks.append(Marks(main, other, above.in_main or main, above.in_other or other, by_name, by_word))
    return marks


def node_features(page: Page, marks: list[Marks], plain: bool = False) -> np.ndarray:
    """A row a node: element, attribute tokens, depth, place, text and link density of its subtree, and its siblings'.

    `plain` leaves out what names and attributes say of a page's parts, as on pages that don't say it.
    """
    nodes = page.nodes
    n = len(nodes)
    chars = np.array([x.own for x in nodes], float)
    linked = np.array([x.linked for x in nodes], float)
    stops = np.zeros(n)
    for node, _, text, _ in page.runs:
        stops[node] += sum(map(text.count, ".,;!?"))
    sub_chars, sub_linked, sub_nodes, sub_stops = chars.copy(), linked.copy(), np.ones(n), stops.copy()
    parent = np.array([x.parent for x in nodes])
    for i in range(n - 1, 0, -1):
        p = parent[i]
        sub_chars[p] += sub_chars[i]
        sub_linked[p] += sub_linked[i]
        sub_nodes[p] += sub_nodes[i]
        sub_stops[p] += sub_stops[i]
    total = max(1.0, sub_chars[0])
    before = np.concatenate([[0.0], np.cumsum(chars)[:-1]]) / total
    density = sub_linked / np.maximum(sub_chars, 1)
    siblings, place, near_chars, near_links, alike = np.ones(n), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for node in nodes:
        c = np.array(node.children, int)
        if len(c):
            siblings[c] = len(c)
            place[c] = np.arange(len(c)) / len(c)
            rest = max(1, len(c) - 1)
            near_chars[c] = (sub_chars[c].sum() - sub_chars[c]) / rest
            near_links[c] = (density[c].sum() - density[c]) / rest
            names = [nodes[i].name for i in c]
            times = Counter(names)
            alike[c] = [times[x] / len(c) for x in names]
    said = np.zeros((n, 4)) if plain else np.array([[m.main, m.other, m.in_main, m.in_other] for m in marks], float)
    shown = ["div" if plain and x.name in (*MAIN_ELEMENTS, *OTHER_ELEMENTS, "header") else x.name for x in nodes]
    kinds = np.array([[name == e for e in ELEMENTS] for name in shown], float)
    numbers = np.column_stack(
        [
            [x.depth for x in nodes],
            np.log1p(chars),
            np.log1p(sub_chars),
            np.log1p(sub_chars / sub_nodes),
            density,
            linked / np.maximum(chars, 1),
            sub_stops / np.maximum(sub_chars, 1),
            sub_chars / total,
            before,
            np.log1p([len(x.children) for x in nodes]),
            np.log1p(siblings),
            place,
            np.log1p(near_chars),
            near_links,
            alike,
        ]
    )
    return np.column_stack([said, kinds, numbers])


def _weak_labels(page: Page, marks: list[Marks]) -> list[int | None]:
    """1 inside a marked main part, 0 in what is marked as another part or stands beside a marked main part, else None."""
    said = any(m.main for m in marks)
    labels: list[int | None] = []
    for node, m in zip(page.nodes, marks, strict=True):
        if node.name in ("#page", "html", "body") or node.name in NEVER_TEXT:
            labels.append(None)
        elif m.in_other:
            labels.append(0)
        elif m.in_main:
            labels.append(1)
        else:
            labels.append(0 if said and not any(marks[c].in_main for c in node.children) else None)
    return labels


@dataclass
class Trees:
    """Boosted trees as arrays: per tree a weight and, per node, the feature, threshold, children and value (feature -1: a leaf)."""

    weights: list[float]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for weight, (feature, threshold, left, right, value) in zip(self.weights, self.trees, strict=True):
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                inner = feature[at] >= 0
                goes_left = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
            total += weight * value[at]
        return 2 * total


def _exported(model) -> Trees:
    trees = []
    for tree in model.trees:
        rows: list[list] = []

        def visit(node, rows: list[list]) -> int:
            here = len(rows)
            rows.append([-1, 0.0, 0, 0, node.prediction()])
            if node.subtreeDepth() > 0:
                split = node.split()
                rows[here][:2] = [split.featureIndex(), split.threshold()]
                rows[here][2] = visit(node.leftChild(), rows)
                rows[here][3] = visit(node.rightChild(), rows)
            return here

        visit(tree._call_java("rootNode"), rows)
        columns = list(zip(*rows, strict=True))
        trees.append(tuple(np.array(c, t) for c, t in zip(columns, (int, float, int, int, float), strict=True)))
    return Trees(list(model.treeWeights), trees)


def train(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> Trees | None:
    """Trees of the weakly labelled nodes of about `training_pages` pages, chosen by hash; None if there is nothing to learn from.

    Each node is learned twice, with and without what names and attributes say, so that trees read pages that don't say it too.
    """
    number = pages.count()
    few = F.pmod(F.xxhash64("url", F.xxhash64("html")), F.lit(1 << 20)) < (1 << 20) * training_pages / max(1, number)

    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            rows, labels = [], []
            for html in batch.column(0).to_pylist():
                page = parse(html or "")
                marks = _marks(page)
                weak = _weak_labels(page, marks)
                usable = [i for i, label in enumerate(weak) if label is not None]
                for plain in (False, True):
                    rows += node_features(page, marks, plain)[usable].tolist()
                    labels += [weak[i] for i in usable]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.float64())], names=["x", "label"]
            )

    nodes = materialise(in_batches(pages.filter(few).select("html"), run, "x array<double>, label double"), "page-nodes")
    if nodes.select("label").distinct().count() < 2:
        return None
    vectors = nodes.select(array_to_vector("x").alias("features"), "label")
    boosted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=11)
    return _exported(boosted.fit(vectors))


def _prior(page: Page, marks: list[Marks]) -> np.ndarray:
    """What names and attributes say, as log odds: parts that no training page has are known by them, unless the trees are sure.

    Attribute words on a node that holds most of the page's text say little of that text.
    """
    total = [x.own for x in page.nodes]
    for i in range(len(page.nodes) - 1, 0, -1):
        total[page.nodes[i].parent] += total[i]
    prior = np.zeros(len(page.nodes))
    for i, (node, m) in enumerate(zip(page.nodes, marks, strict=True)):
        if m.other:
            if m.by_name:
                prior[i] = -NAMED
            elif 2 * total[i] < total[0]:
                prior[i] = min(-NAMED if m.by_word else -MARKED, prior[node.parent])
        elif i and prior[node.parent] < 0:
            prior[i] = prior[node.parent]
        elif m.in_main:
            prior[i] = 1.0
    return prior


def _plain_margins(page: Page, marks: list[Marks]) -> np.ndarray:
    """Without trees: prose that isn't marked as another part."""
    prose = [x.own >= 80 and x.linked < 0.3 * x.own and not m.in_other for x, m in zip(page.nodes, marks, strict=True)]
    return np.where(prose, 1.0, -0.01)


def decode(page: Page, margins: np.ndarray) -> list[bool]:
    """The likeliest consistent choice: a node is kept only if its parent is.

    From the leaves up, the best score of each subtree with its top kept and with all of it dropped; then from the top down. A
    node counts by its own text. The page, html and body are kept as such, so that they forbid nothing.
    """
    nodes = page.nodes
    weight = np.array([0.05 + math.log1p(x.own) for x in nodes])
    score = margins * weight
    keep, drop = score.copy(), -score
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = [True] * len(nodes)
    for i in range(1, len(nodes)):
        node = nodes[i]
        shell = node.name in ("html", "body")
        kept[i] = kept[node.parent] and node.name not in NEVER_TEXT and (shell or bool(keep[i] >= drop[i]))
    outside = [i for i, x in enumerate(nodes) if x.name in ("#page", "html", "body")]
    own = {i: bool(score[i] > 0) for i in outside}
    # Text directly in the body is judged by itself, as it has no node of its own.
    return [own.get(i, k) for i, k in enumerate(kept)]


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """The pages with `text` and `n_chars` (code points).

    `pages` needs url and html; all other columns stay, but those of the added names. Block texts are joined by a line feed, white
    space within a block is one space, character references are decoded. NULL and empty pages, and pages without main text, have
    the empty text; broken markup is read as far as it goes; repeated rows get a row each.
    """
    learned = trees or train(pages)
    held = pages.sparkSession.sparkContext.broadcast(learned)

    def main_text(learned: Trees | None, html: str | None) -> tuple:
        page = parse(html or "")
        marks = _marks(page)
        margins = learned.margins(node_features(page, marks)) if learned else _plain_margins(page, marks)
        text = blocks(page, decode(page, np.clip(margins, -CLIP, CLIP) + _prior(page, marks)))
        return text, len(text)

    return per_row(pages, main_text, ["html"], "text string, n_chars long", setup=lambda: held.value)
