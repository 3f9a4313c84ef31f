"""Main text of web pages by boosted trees over the nodes of their trees.

A page becomes a tree of blocks, with every run of text as a leaf. Each node is described by its subtree (length,
density, links), the tokens of its attributes, its depth, its ancestors and its siblings, and gradient-boosted trees
give the odds that it holds main text. Decoding is hierarchical: whatever lies in a rejected node is rejected too,
and of all choices without such a contradiction the likeliest one for the whole tree is taken.

The trees are trained by Spark on generated pages, whose true main text is known; see ``page_layouts``.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import other_columns, share, widened
from .page_layouts import MARK, layouts

#: Training pages; the sample is generated, so its size is the bound.
TRAINING_PAGES = 600
TREES, DEPTH, STEP = 20, 5, 0.4
#: What it costs, in log-odds, to drop a block out of a kept one other than the body: parts of an article rarely stand alone.
PARTING = 2.0

#: Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe object svg audio video canvas select head".split())
#: Of these, what stays unread to the end of the page where no closing tag follows; of others only the tag.
OPAQUE = frozenset("script style title textarea".split())
#: What may stand in a head; any other tag ends it.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes script style template head html".split())
BLOCKS = frozenset("""address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup label legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
#: An element that starts ends an open one of these, up to a container.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Groups of elements and of attribute tokens that nodes are described by.
TAGS = [{"article"}, {"main"}, {"section"}, {"div", "center"}, {"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"},
        {"ul", "ol", "menu", "dl"}, {"li", "dd", "dt"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th"}, {"nav"}, {"header"}, {"footer"}, {"aside"},
        {"form", "fieldset", "button", "label", "legend", "dialog"}, {"figure", "figcaption"}, {"#text"}, {"body"}]
TOKENS = [
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toc tabs skip sitemap links",
    "ad ads adv advert advertisement advertising adsense adslot sponsor sponsored promo promotion banner affiliate partner dfp",
    "cookie cookies consent notice notification alert gdpr popup modal overlay newsletter subscribe subscription signup paywall warning toast announcement disclaimer privacy",
    "comment comments commentlist reply replies disqus respond discussion feedback review reviews thread user",
    "sidebar side aside widget related recommended recommendations popular trending share sharing social more teaser rail complementary tags",
    "footer foot copyright legal colophon contentinfo bottom credits",
    "header head masthead logo topbar top toolbar branding site",
    "form search login contact register input field button",
    "content article post entry main story body text articlebody prose hentry document blog",
]
GROUP = {token: i for i, names in enumerate(TOKENS) for token in names.split()}
UNDER = ["nav", "header", "footer", "aside", "form", "article", "main"]

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S)
OPEN_COMMENT = re.compile(r"<!--.*\Z", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ENDINGS = re.compile(r"[.!?…。！？]")


def attribute_groups(attributes: str, known: dict = {}) -> tuple[tuple[int, ...], bool]:  # noqa: B006
    """Which token groups the names in a tag's attributes belong to, and whether it is hidden; remembers some."""
    if attributes in known:
        return known[attributes]
    if len(known) > 4096:
        known.clear()
    found = set()
    for value in ATTRIBUTE.findall(attributes):
        for token in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
            if token in GROUP:
                found.add(GROUP[token])
    described = tuple(sorted(found)), bool(HIDDEN.search(attributes))
    if len(attributes) <= 1000:
        known[attributes] = described
    return described


class Page:
    """The tree: parents come before their children; leaves hold text."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attributes, self.text, self.linked = ["body"], [-1], [""], [""], [0]
        self._stack, self._run, self._in_link, self._link_chars, self._unclosed = [0], [], False, 0, set()
        self._open: dict[str, list[int]] = {}  # depths at which a tag is open, the deepest last
        self._read(source)
        self._close_run()

    def _node(self, tag: str, attributes: str = "", text: str = "", linked: int = 0) -> int:
        for column, value in ((self.tag, tag), (self.parent, self._stack[-1]), (self.attributes, attributes), (self.text, text), (self.linked, linked)):
            column.append(value)
        return len(self.tag) - 1

    def _add(self, text: str) -> None:
        if text:
            self._run.append(text)
            if self._in_link:
                self._link_chars += len(text)

    def _close_run(self) -> None:
        if self._run:
            text = " ".join(html.unescape("".join(self._run)).split())
            if text:
                self._node("#text", "", text, min(self._link_chars, len(text)))
        self._run, self._link_chars = [], 0

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        self._last = source.rfind(">")  # no tag ends behind it
        while at < end:
            m = TOKEN.search(source, at) if at <= self._last else OPEN_COMMENT.search(source, at)
            if not m:
                self._add(source[at:])
                return
            self._add(source[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower() if m.re is TOKEN else ""
            if not tag:
                continue
            if m[1] or m[4]:
                self._end(tag)
                continue
            attributes = m[3] or m[6] or ""
            if tag in RAW and not attributes.endswith("/"):
                at = self._after_head(source, at) if tag == "head" else self._after_raw(source, at, tag)
                self._run.append(" ") if self._run else None
            else:
                self._start(tag, attributes)

    def _after_raw(self, source: str, at: int, tag: str) -> int:
        if tag in self._unclosed:
            return at
        closing = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at, self._last + 1)
        if closing:
            return closing.end()
        if tag in OPAQUE:
            return len(source)
        self._unclosed.add(tag)  # nor does one follow later
        return at

    def _after_head(self, source: str, at: int) -> int:
        """The place behind a head, which ends at its closing tag or before the first tag that can't stand in it."""
        closing = re.compile(r"</head\b[^>]*>|<body\b", re.I).search(source, at, self._last + 1)
        limit = closing.start() if closing else self._last + 1
        while at < limit and (m := TOKEN.search(source, at)) and m.start() < limit:
            if not closing and source[at:m.start()].strip():
                return at
            tag, starts = (m[2] or m[5] or "").lower(), not (m[1] or m[4])
            if tag and starts and tag not in IN_HEAD:
                return m.start()
            at = m.end()
            if starts and tag in RAW and tag != "head" and not (m[3] or m[6] or "").endswith("/"):
                at = self._after_raw(source, at, tag)
        return at if not closing else closing.end() if closing[0][1] == "/" else closing.start()

    def _deepest(self, tags) -> int:
        """The depth of the innermost open element with one of these tags; 0 without one."""
        return max((self._open[t][-1] for t in tags if self._open.get(t)), default=0)

    def _cut(self, depth: int) -> None:
        """Close what is open from a depth on."""
        for node in reversed(self._stack[depth:]):
            self._open[self.tag[node]].pop()
        del self._stack[depth:]

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("br", "hr"):
            self._run.append(" ")
        elif tag == "a":
            self._in_link = True
        elif tag in BLOCKS:
            self._close_run()
            if self.tag[self._stack[-1]] == "p" and tag not in ("button", "label"):
                self._cut(len(self._stack) - 1)
            if tag in ENDS:
                ended, container = ENDS[tag]
                depth = self._deepest(ended)
                if depth > self._deepest(container):
                    self._cut(depth)
            if tag == "body":
                self.attributes[0] = attributes
            else:
                self._open.setdefault(tag, []).append(len(self._stack))
                self._stack.append(self._node(tag, attributes))

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._in_link = False
        elif tag in BLOCKS and tag != "body":
            self._close_run()
            if depth := self._deepest([tag]):
                self._cut(depth)

    def features(self) -> np.ndarray:
        """One row a node."""
        n = len(self.tag)
        chars, links, sentences, commas, nodes, blocks, short, children = ([0.0] * n for _ in range(8))
        depth, place, groups, above, under = [0] * n, [0] * n, [()] * n, [frozenset()] * n, [frozenset()] * n
        hidden, before = [False] * n, [0.0] * n
        total = 0.0
        for i in range(n):
            p = self.parent[i]
            groups[i], hidden[i] = attribute_groups(self.attributes[i]) if self.attributes[i] else ((), False)
            before[i] = total
            if p >= 0:
                depth[i], place[i] = depth[p] + 1, int(children[p])
                children[p] += 1
                above[i] = above[p].union(groups[p]) if groups[p] else above[p]
                under[i] = under[p] | {self.tag[p]} if self.tag[p] in UNDER else under[p]
                hidden[i] = hidden[i] or hidden[p]
            if text := self.text[i]:
                size = float(len(text))
                chars[i], links[i], sentences[i], commas[i] = size, float(self.linked[i]), float(len(ENDINGS.findall(text))), float(text.count(","))
                blocks[i], short[i] = 1.0, float(size < 60)
                total += size
            nodes[i] = 1.0
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            for column in (chars, links, sentences, commas, nodes, blocks, short):
                column[p] += column[i]
        out = np.zeros((n, 20 + len(TAGS) + 2 * len(TOKENS) + len(UNDER)))
        for i in range(n):
            p = self.parent[i]
            size, share_of = chars[i], chars[i] / total if total else 0.0
            around = chars[p] if p >= 0 else size
            row = [math.log1p(size), links[i] / size if size else 0.0, math.log1p(size / nodes[i]), sentences[i] / (1 + blocks[i]), commas[i] / (1 + blocks[i]),
                   math.log1p(blocks[i]), short[i] / (1 + blocks[i]), share_of, size / around if around else 0.0, depth[i], place[i],
                   children[p] if p >= 0 else 1.0, children[i], before[i] / total if total else 0.0, (before[i] + size) / total if total else 0.0,
                   links[p] / around if p >= 0 and around else 0.0, short[p] / (1 + blocks[p]) if p >= 0 else 0.0, math.log1p(around), float(hidden[i]), math.log1p(total)]
            own = self.tag[i]
            row += [float(own in t) for t in TAGS]
            row += [float(g in groups[i]) for g in range(len(TOKENS))]
            row += [float(g in above[i]) for g in range(len(TOKENS))]
            row += [float(u in under[i]) for u in UNDER]
            out[i] = row
        return out

    def decode(self, odds: np.ndarray) -> str:
        """The text of the leaves that the likeliest consistent choice keeps; ``odds`` are log-odds by node."""
        n = len(self.tag)
        weight = np.array([1.0 + (2.0 if t else 0.0) for t in self.text])
        log_in, log_out = (-np.logaddexp(0, -odds) * weight).tolist(), (-np.logaddexp(0, odds) * weight).tolist()
        kept, dropped = log_in[:], log_out[:]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            kept[p] += max(kept[i], dropped[i] - (PARTING if p else 0.0))
            dropped[p] += dropped[i]
        inside, parts = [True] * n, []
        for i in range(1, n):
            inside[i] = inside[self.parent[i]] and kept[i] >= dropped[i] - (PARTING if self.parent[i] else 0.0)
            if inside[i] and self.text[i]:
                parts.append(self.text[i])
        return " ".join(parts)

    def labels(self) -> list[float]:
        """Of a generated page: 1 for nodes that hold marked text; the marks go."""
        marked = [float(MARK in t) for t in self.text]
        self.text = [t.replace(MARK, "") for t in self.text]
        for i in range(len(marked) - 1, 0, -1):
            marked[self.parent[i]] = max(marked[self.parent[i]], marked[i])
        return marked


class Boosted:
    """Trees as arrays: log-odds of many nodes at once."""

    def __init__(self, model):
        self.trees = []
        for tree, weight in zip(model.trees, model.treeWeights):
            feature, threshold, left, right, value = [], [], [], [], []

            def walk(node) -> int:
                at = len(feature)
                leaf = node.subtreeDepth() == 0
                for column, x in ((feature, 0), (threshold, 0.0), (left, at), (right, at), (value, float(node.prediction()))):
                    column.append(x)
                if not leaf:
                    feature[at], threshold[at] = node.split().featureIndex(), node.split().threshold()
                    left[at], right[at] = walk(node.leftChild()), walk(node.rightChild())
                return at

            walk(tree._call_java("rootNode"))
            self.trees.append((weight, *map(np.array, (feature, threshold, left, right, value))))

    def odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            total += weight * value[at]
        return 2 * total  # the classifier's margin is half the log-odds


def train(spark: SparkSession, pages: int = TRAINING_PAGES) -> Boosted:
    """Boosted trees from generated pages."""
    rows = []
    for source in layouts(pages):
        page = Page(source)
        labels = page.labels()
        rows += [(y, x.tolist()) for y, x in zip(labels, page.features())]
    nodes = spark.createDataFrame(rows, "label double, x array<double>").select("label", array_to_vector("x").alias("features"))
    nodes = nodes.coalesce(2).persist()
    try:
        return Boosted(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=64, seed=7, cacheNodeIds=False).fit(nodes))
    finally:
        nodes.unpersist()


def main_text(pages: DataFrame, model: Boosted, html_column: str = "html", batch: int = 64) -> DataFrame:
    """Every row with ``text``, the page's main text, in place of its source.

    Character references are decoded, white space inside a block is one space, blocks are joined by one space in the
    order of the page. A null, empty or textless page gives an empty text; text outside any tag is a block. Other
    columns and repeated rows stay; one named ``text`` is replaced.
    """
    out = StructType([StructField("text", StringType(), False)])
    kept = [c for c in other_columns(pages, ["text"]) if c != html_column]
    schema = widened(pages.select(*kept), out)
    shared = share(pages.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared()
        for rows in batches:
            sources, texts = rows.column(html_column), []
            for lo in range(0, len(sources), batch):
                parsed = [Page(s or "") for s in sources.slice(lo, batch).to_pylist()]
                odds = trees.odds(np.concatenate([p.features() for p in parsed]))
                at = 0
                for p in parsed:
                    texts.append(p.decode(odds[at:at + len(p.tag)]))
                    at += len(p.tag)
            rest = rows.select(kept)
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(texts, pa.string())], names=[*kept, "text"])

    return pages.mapInArrow(run, schema)


def counted(texts: DataFrame) -> DataFrame:
    """With the number of code points."""
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
