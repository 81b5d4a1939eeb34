"""Main text of web pages by boosted trees over DOM nodes.

A page is read into a tree of elements. Each element has features: density of
text, links, tags and punctuation in its subtree, tokens of its tag, class, id
and role (its own and its ancestors'), depth, siblings and place in the page.
Gradient-boosted trees give the chance that an element holds main text. The
choice is made for the tree as a whole: of all labelings in which nothing below
a dropped element is kept, the most likely one is taken, by one pass up and one
pass down. So no element is kept below a dropped ancestor.

No page comes labelled, so the trees learn from elements whose names tell what
they are (an article, a navigation bar). Each is also shown with its name features
blanked, which makes the trees use structure, and main elements are also shown
under a name that tells them away (prose in a side bar is no main text), which
makes them use names. Training uses at most ``SAMPLE`` pages, drawn by a hash of the page; every page is extracted whole.

Defined cases: a NULL or empty page has the empty text; a page cut off anywhere
is read as far as it goes, an unfinished tag at its end is dropped; repeated rows
are extracted alike; text in controls, drawings and templates is dropped, an
unclosed one ends with its parent, at a block's start or at its next like, and
counts for nothing if no end tag follows at all; formulas and the fallback text of
objects are elements as others; with no page to learn from, names alone decide; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import Computed, table, with_computed
from cohortry.session import checkpointed

SAMPLE = 400
TREES = 12
DEPTH = 4
STEP = 0.3
PAGES_AT_ONCE = 500

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title".split())
# Elements whose text is no text of the page; the first hold no blocks, so a block's start ends them.
OFF_INLINE = frozenset("button select svg".split())
OFF = OFF_INLINE | {"template"}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead"),
               "td": ("tr",), "th": ("tr",), "option": ("select",)}

# Names that tell what an element is.
AWAY_TAGS = frozenset("nav footer aside form menu dialog".split())
AWAY_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disclaimer footer form header masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted promotion related search share sharing shoutbox sidebar signup skip social "
    "sponsor sponsored subscribe tags toolbar topbar widget widgets contentinfo complementary replies reply "
    "discussion disqus alert respond toc legal login".split()
)
MAIN_TAGS = frozenset("article main".split())
MAIN_NAMES = frozenset("article articlebody body content entry main maincontent post story text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>"
    r"|<[!?][^>]*(?:>|\Z)|(?P<cut></?[a-zA-Z][^>]*\Z)|(?P<text>[^<]+|<)",
    re.S,
)
NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
NAME_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")

FEATURES = (
    "chars", "share", "link_share", "tag_density", "mark_density", "word_length", "depth", "children", "siblings",
    "same_siblings", "place", "paragraphs", "items", "own_chars", "heading", "parent_link_share",
    "away_self", "away_above", "main_self", "main_above",
)
NAMED = tuple(i for i, name in enumerate(FEATURES) if name.endswith(("_self", "_above")))


class Page:
    """Elements of a page in document order, and its text pieces by element."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.depth, self.away, self.main = ["#page"], [-1], [0], [False], [False]
        self.off = [False]
        self.pieces: list[tuple[int, str]] = []  # an empty piece is a block border
        self._read(html)

    def _open(self, tag: str, attrs: str, above: int) -> int:
        names = set()
        if attrs:
            for groups in NAMING.findall(attrs):
                for raw in groups:
                    if raw:
                        names.update(t for t in NAME_SPLIT.split(raw.lower()) if t)
        page_header = tag == "header" and not self._inside_main(above)
        self.tag.append(tag)
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        self.off.append(self.off[above] or tag in OFF)
        self.away.append(tag in AWAY_TAGS or tag in OFF or page_header or not names.isdisjoint(AWAY_NAMES))
        self.main.append(tag in MAIN_TAGS or (tag != "body" and not names.isdisjoint(MAIN_NAMES)))
        return len(self.tag) - 1

    def _inside_main(self, node: int) -> bool:
        while node > 0:
            if self.tag[node] in MAIN_TAGS:
                return True
            node = self.parent[node]
        return False

    def _read(self, html: str) -> None:
        at, here = 0, 0
        pieces, tags, parent, off = self.pieces, self.tag, self.parent, self.off
        last_end: dict[str, int] = {}
        while found := TOKEN.match(html, at):
            at = found.end()
            if (text := found["text"]) is not None:
                if not off[here]:
                    pieces.append((here, text))
                continue
            tag = found["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if found["end"]:
                up = here
                while up and tags[up] != tag:
                    up = parent[up]
                if up:
                    here = parent[up]
                    if tag not in INLINE:
                        pieces.append((here, ""))
                elif tag in CLOSES_P:
                    pieces.append((here, ""))
                continue
            if tag in RAW:
                if not found["attrs"].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                    at = end.end() if end else len(html)
                continue
            if off[here] and (tag in CLOSES_P or tag in OFF_INLINE):
                up = here
                while up and tags[up] not in OFF_INLINE and tags[up] not in ("foreignobject", "template"):
                    up = parent[up]
                # Drawings may hold drawings; controls do not hold their like.
                if tags[up] in OFF_INLINE and (tag in CLOSES_P or (tag == tags[up] and tag != "svg")):
                    here = parent[up]
            if tag in OFF:
                if tag not in last_end:
                    last_end[tag] = max((m.start() for m in re.finditer(rf"</{tag}\b", html, re.I)), default=-1)
                if last_end[tag] < at or found["attrs"].endswith("/"):
                    continue
            if tag not in INLINE:
                pieces.append((here, ""))
            if tag in VOID:
                continue
            if tag in CLOSES_P:
                up = here
                while up and tags[up] in INLINE:
                    up = parent[up]
                if tags[up] == "p":
                    here = parent[up]
            elif tag in SAME_CLOSES:
                up = here
                while up and tags[up] != tag and tags[up] not in SAME_CLOSES[tag]:
                    up = parent[up]
                if up and tags[up] == tag:
                    here = parent[up]
            here = self._open(tag, found["attrs"], here)

    def features(self) -> np.ndarray:
        """One row of FEATURES per element."""
        n = len(self.tag)
        own, marks, words, first = [0] * n, [0] * n, [0] * n, [-1] * n
        seen = 0
        for node, text in self.pieces:
            size = len(text) if text and not text.isspace() else 0
            if size:
                own[node] += size
                marks[node] += text.count(".") + text.count(",")
                words[node] += text.count(" ") + 1
                if first[node] < 0:
                    first[node] = seen
                seen += size
        chars, links, elements = own[:], [0] * n, [1] * n
        paragraphs, items, children = [0] * n, [0] * n, [0] * n
        kinds: list[dict[str, int]] = [{} for _ in range(n)]
        for i in range(n - 1, 0, -1):
            up, tag = self.parent[i], self.tag[i]
            chars[up] += chars[i]
            marks[up] += marks[i]
            words[up] += words[i]
            elements[up] += elements[i]
            links[up] += chars[i] if tag == "a" else links[i]
            paragraphs[up] += paragraphs[i] + (tag == "p")
            items[up] += items[i] + (tag == "li")
            children[up] += 1
            kinds[up][tag] = kinds[up].get(tag, 0) + 1
            if first[i] >= 0 and (first[up] < 0 or first[i] < first[up]):
                first[up] = first[i]
        away_above, main_above = [False] * n, [False] * n
        rows = []
        total = max(1, chars[0])
        for i in range(n):
            up = max(0, self.parent[i])
            if i:
                away_above[i] = away_above[up] or self.away[up]
                main_above[i] = main_above[up] or self.main[up]
            size = chars[i] or 1
            rows.append((
                math.log1p(chars[i]), chars[i] / total, links[i] / size, elements[i] / size, marks[i] / size,
                chars[i] / (words[i] or 1), self.depth[i], children[i], children[up],
                kinds[up].get(self.tag[i], 1) / (children[up] or 1), max(0, first[i]) / total,
                math.log1p(paragraphs[i] + (self.tag[i] == "p")), math.log1p(items[i]), math.log1p(own[i]),
                self.tag[i][0] == "h" and self.tag[i][1:].isdigit(), links[up] / (chars[up] or 1),
                self.away[i], away_above[i], self.main[i], main_above[i],
            ))
        return np.array(rows, dtype=np.float64)

    def taught(self) -> list[tuple[int, int]]:
        """(element, 1 holds main text or 0 not) for elements whose names tell."""
        n = len(self.tag)
        away, inside = [False] * n, [False] * n
        holds = [False] * n
        for i in range(1, n):
            up = self.parent[i]
            away[i] = away[up] or self.away[i]
            inside[i] = (inside[up] or self.main[i]) and not away[i]
        for i in range(n - 1, 0, -1):
            holds[i] = holds[i] or inside[i]
            holds[self.parent[i]] = holds[self.parent[i]] or holds[i]
        return [(i, int(holds[i])) for i in range(1, n) if holds[i] or away[i]]

    def decode(self, chance: np.ndarray) -> list[bool]:
        """The most likely labeling without a kept element below a dropped one."""
        n = len(self.tag)
        p = np.clip(chance, 1e-4, 1 - 1e-4)
        keep, drop = np.log(p).tolist(), np.log(1 - p).tolist()
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            keep[up] += max(keep[i], drop[i])
            drop[up] += drop[i]
        kept = [True] * n
        for i in range(1, n):
            # The page and its body hold whatever there is.
            forced = self.tag[i] in ("html", "body")
            kept[i] = kept[self.parent[i]] and (forced or keep[i] >= drop[i])
        return kept

    def text(self, kept: list[bool]) -> str:
        """Decoded text of the kept elements, blocks and words joined by one blank."""
        parts = [unescape(t) if t else " " for node, t in self.pieces if kept[node]]
        return " ".join("".join(parts).split())


class Trees:
    """Boosted regression trees as nested tuples (feature, threshold, left, right) or a leaf value."""

    def __init__(self, trees: list, weights: list[float]) -> None:
        self.trees, self.weights = trees, weights

    def chance(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for tree, weight in zip(self.trees, self.weights, strict=True):
            margin += weight * _walk(tree, x)
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


def _walk(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    feature, threshold, left, right = tree
    low = x[:, feature] <= threshold
    out = np.empty(len(x))
    out[low] = _walk(left, x[low])
    out[~low] = _walk(right, x[~low])
    return out


def _tree_of(node) -> tuple | float:
    """A fitted tree of the Spark model as nested tuples."""
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree_of(node.leftChild()), _tree_of(node.rightChild()))


# Names alone: away from main text below a telling name.
BY_NAME = Trees(
    [(FEATURES.index("away_self"), 0.5, (FEATURES.index("away_above"), 0.5, 1.0, -1.0), -1.0)], [1.0]
)


def training_nodes(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> DataFrame:
    """(features, label): elements of at most ``sample`` pages, as found and in other guises."""
    drawn = pages.filter(F.length(html) > 0).select(F.col(html).alias("html")).orderBy(F.xxhash64("html")).limit(sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, labels = [], []
            for text in batch["html"]:
                page = Page(text)
                x = page.features()
                for i, label in page.taught():
                    blank = x[i].copy()
                    blank[list(NAMED)] = 0.0
                    rows += [x[i].tolist(), blank.tolist()]
                    labels += [float(label)] * 2
                    if label:
                        for name in ("away_self", "away_above"):
                            for moved in (x[i].copy(), blank.copy()):
                                moved[FEATURES.index(name)] = 1.0
                                rows.append(moved.tolist())
                                labels.append(0.0)
            if rows:
                yield pd.DataFrame({"x": rows, "label": labels})

    return drawn.repartition(8).mapInPandas(run, "x array<double>, label double")


def learn(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> Trees:
    """Fit the trees; names alone decide if the pages teach one class only."""
    rows = checkpointed(training_nodes(pages, html, sample))
    if rows.select("label").distinct().count() < 2:
        return BY_NAME
    train = rows.select(array_to_vector("x").alias("features"), "label").cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(train)
    train.unpersist()
    return Trees([_tree_of(t._java_obj.rootNode()) for t in model.trees], list(model.treeWeights))


def extract(pages: DataFrame, trees: Trees, html: str = "html", columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``columns`` with text and n_chars for each row of ``pages``."""

    def make():
        def compute(batch: list[str | None]) -> Computed:
            texts = []
            for at in range(0, len(batch), PAGES_AT_ONCE):
                read = [Page(t or "") for t in batch[at : at + PAGES_AT_ONCE]]
                x = [p.features() for p in read]
                chance, start = trees.chance(np.concatenate(x)), 0
                for page, rows in zip(read, x, strict=True):
                    texts.append(page.text(page.decode(chance[start : start + len(rows)])))
                    start += len(rows)
            return {"text": texts, "n_chars": [len(t) for t in texts]}

        return compute

    return with_computed(pages, columns, html, "text string, n_chars long", make)


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract(pages, learn(pages))
