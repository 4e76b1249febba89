"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Boosted trees give every element the probability that what it holds is main text, from
subtree densities, words in its attributes, depth and sibling statistics.  The elements
of a page are then decoded together: an element is a container, main text or clutter;
main text may hold main text or clutter, clutter only clutter.  So no descendant is kept
inside something dropped, and none is a mere container inside the article.

The trees are fitted on at most ``SAMPLE_PAGES`` pages that mark their article, each
also in a disturbed copy: with reader comments, notices, forms, sidebars and the like
made of the page's own text put in and about the article, whose place is known.  Pages
that mark no article are extracted alike.  Without any page to learn from, words and
tags that speak against main text decide.

Blocks are the text of block elements in page order; a line break is white space.  Null
and empty pages have empty text, as have pages of which nothing is main text.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import map_text, query, reach_package, table
from tabkit.llm.dom import BLOCKS, LABEL, NAMES, RAW, RCDATA, Page, features
from tabkit.session import materialize

SAMPLE_PAGES = 400
TREES = 20
DEPTH = 5
# What it costs to change from container or main text to something else below it.
CHANGE = 1.0
CONTAINER, MAIN, CLUTTER = 0, 1, 2

# --- training pages -------------------------------------------------------------------

# Clutter with known place; {} takes text of the page, # a word of it.
CLUTTERS = (
    '<div class="comments" {}><h3>Comments</h3><div class="comment"><b>#</b><p>@</p></div><div class="comment"><p>@</p></div></div>',
    '<section id="comments" {}><ol><li><p>@</p></li><li><p>@</p></li></ol></section>',
    '<aside {}><h2>#</h2><p>@</p><ul><li><a href="/#">#</a></li><li><a href="/#">#</a></li></ul></aside>',
    '<div class="sidebar" {}><p>@</p><ul><li><a href="/#">#</a></li></ul></div>',
    '<div id="cookie-notice" {}><p>@</p><button>#</button></div>',
    '<div class="notice" {}>@</div>',
    '<form action="/#" {}><label>@</label><input name="q"><button>#</button></form>',
    '<header {}><h1>#</h1><p>@</p></header>',
    '<div class="header" {}><a href="/">#</a> @</div>',
    '<nav {}><ul><li><a href="/#">#</a></li><li><a href="/#">#</a></li></ul></nav>',
    '<div class="menu" {}><a href="/#">#</a> <a href="/#">#</a> <a href="/#">#</a></div>',
    '<div class="ad" {}>@</div>',
    '<div class="advert" {}><p>@</p></div>',
    '<footer {}><p>@</p></footer>',
    '<div id="footer" {}>@</div>',
    '<div class="related" {}><ul><li><a href="/#">@</a></li><li><a href="/#">@</a></li></ul></div>',
    '<div class="share" {}><a href="/#">#</a><a href="/#">#</a></div>',
)
# Parts that main text may have besides paragraphs.
PARTS = (
    "<ul><li>@</li><li>@</li><li>@</li></ul>",
    "<ol><li>@</li><li>@</li></ol>",
    "<table><tr><td>@</td><td>@</td></tr><tr><td>#</td><td>#</td></tr></table>",
    "<blockquote><p>@</p></blockquote>",
    "<h2>@</h2>",
    "<section><h3>#</h3><p>@</p></section>",
    "<div><p>@</p><p>@</p></div>",
    "<figure><figcaption>@</figcaption></figure>",
    "<pre>@</pre>",
    '<p>@ <a href="/#">@</a> @</p>',
    '<p><a href="/#">@</a></p>',
    "<p>#</p>",
)
HOLDERS = (
    "article", "article", "article", "main", "main", 'div class="content"', 'div id="main"', 'div class="post-body"',
    'div class="article"', "div",
)


def marked(source: str) -> str | None:
    """The page with its article labelled main and the rest clutter; None if it marks none."""
    low = source.lower()
    start = low.find("<article")
    if start < 0 or low.find("<article", start + 1) >= 0:
        return None
    place = start + len("<article")
    return f'{source[:place]} {LABEL}="1"{source[place:]}'


def disturbed(source: str, seed: int) -> str | None:
    """A labelled copy with clutter put in and about the article, and another holder for it."""
    draw = random.Random(seed)
    page = marked(source)
    if page is None:
        return None
    words = [w for _, t in Page(source).runs for w in t.split()] or ["text"]

    def filled(parts: str) -> str:
        while "@" in parts:
            at = draw.randrange(len(words))
            text = " ".join(words[at : at + draw.randint(3, 60)])
            parts = parts.replace("@", text.replace("@", " ").replace("<", " ").replace("#", " "), 1)
        while "#" in parts:
            parts = parts.replace("#", draw.choice(words).replace("#", " ").replace("<", " "), 1)
        return parts

    def clutter() -> str:
        return filled(draw.choice(CLUTTERS).replace("{}", f'{LABEL}="0"', 1))

    start = page.find("<article")
    inside = page.find(">", start) + 1
    end = page.find("</article>", inside)
    end = len(page) if end < 0 else end
    body = page[inside:end]
    places = [0, len(body)]
    at = body.find("</p><p>")
    while at >= 0:
        places.append(at + 4)
        at = body.find("</p><p>", at + 1)
    for place in sorted(draw.sample(places, min(len(places), draw.randint(1, 4))), reverse=True):
        body = body[:place] + (clutter() if draw.random() < 0.5 else filled(draw.choice(PARTS))) + body[place:]
    holder = draw.choice(HOLDERS)
    before = "".join(clutter() for _ in range(draw.randint(0, 3)))
    after = "".join(clutter() for _ in range(draw.randint(0, 3)))
    rest = page[end:].removeprefix("</article>")
    return f'{page[:start]}{before}<{holder} {LABEL}="1">{body}</{holder.split()[0]}>{after}{rest}'


def decided(page: Page) -> np.ndarray:
    """Elements that get a decision of their own: blocks, and inline ones that speak against it."""
    own = [
        t in BLOCKS or against > 0 or t in ("button", "label", "select", "textarea")
        for t, against in zip(page.tags, page.against)
    ]
    return np.array(own)


def training_rows(source: str, seed: int) -> list[tuple[float, list[float]]]:
    """Label (1: main text) and features of elements; what holds the article as well as others is none."""
    out = []
    for body in (marked(source), disturbed(source, seed), disturbed(source, seed + 1)):
        if body is None:
            continue
        page = Page(body)
        values, own = features(page), decided(page)
        labels = np.array(page.labels)
        for i in np.flatnonzero(own & (values[:, 1] > 0)):
            out.append((float(labels[i] == 1), values[i].tolist()))
    return out


@dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays, one row per tree: feature (-1 at a leaf), cut, children, value."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        everything = np.arange(len(rows))
        for k, weight in enumerate(self.weight):
            at = np.zeros(len(rows), np.int64)
            while True:
                feature = self.feature[k, at]
                inner = feature >= 0
                if not inner.any():
                    break
                low = rows[everything, np.maximum(feature, 0)] <= self.cut[k, at]
                at = np.where(inner, np.where(low, self.left[k, at], self.right[k, at]), at)
            total += weight * self.value[k, at]
        return 1.0 / (1.0 + np.exp(-2.0 * total))


def exported(model) -> Trees:
    """The fitted trees of MLlib as arrays, to be applied to many elements at once."""
    tables = []
    for tree in model.trees:
        rows: list[list[float]] = []

        def walk(node) -> int:
            at = len(rows)
            rows.append([-1, 0.0, 0, 0, node.prediction()])
            if node.subtreeDepth() > 0:
                split = node.split()
                rows[at][:2] = [split.featureIndex(), split.threshold()]
                rows[at][2] = walk(node.leftChild())
                rows[at][3] = walk(node.rightChild())
            return at

        walk(tree._java_obj.rootNode())
        tables.append(rows)
    width = max(map(len, tables))
    full = np.array([t + [[-1, 0.0, 0, 0, 0.0]] * (width - len(t)) for t in tables])
    return Trees(
        full[:, :, 0].astype(int), full[:, :, 1], full[:, :, 2].astype(int), full[:, :, 3].astype(int), full[:, :, 4],
        np.array(list(model.treeWeights)),
    )


def train(pages: DataFrame, source: str = "html", key: str = "page_id", sample_pages: int = SAMPLE_PAGES) -> Trees | None:
    """Boosted trees from a bounded sample of the pages; None if no page marks its article."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    reach_package(pages.sparkSession)
    rows = pages.select(F.col(f"`{key}`").alias("id"), F.col(f"`{source}`").alias("html")).filter("html IS NOT NULL")
    ids = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(sample_pages)
    chosen = rows.join(F.broadcast(ids.distinct()), "id")

    def run(batches):
        for batch in batches:
            found = [
                row
                for i, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for row in training_rows(h, 2 * int(i))
            ]
            if found:
                labels, values = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels), pa.array(values, pa.list_(pa.float64()))], names=["label", "values"]
                )

    examples = materialize(chosen.mapInArrow(run, "label double, values array<double>"), "elements")
    kinds = {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return None
    examples = examples.select("label", array_to_vector("values").alias("features")).coalesce(4).persist()
    try:
        booster = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=5)
        return exported(booster.fit(examples))
    finally:
        examples.unpersist()


# --- extraction -----------------------------------------------------------------------


def probabilities(trees: Trees | None, values: np.ndarray) -> np.ndarray:
    if trees is not None:
        return trees.probability(values)
    against = values[:, [NAMES.index(n) for n in ("against", "above_against", "tag_against", "above_tag_against")]]
    return np.where(against.max(axis=1) > 0, 0.05, 0.9)


def decode(page: Page, chance: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The best assignment of states to elements that the rules of the module allow."""
    n = len(page.tags)
    chance = np.clip(chance, 1e-4, 1 - 1e-4)
    text = np.zeros(n)
    for node, run in page.runs:
        if run and not run.isspace():
            text[node] = 1
    gain = np.zeros((n, 3))
    # an element that holds no text itself may be a container at no cost
    gain[:, MAIN], gain[:, CLUTTER] = np.log(chance), np.log(1 - chance)
    gain[:, CONTAINER] = np.where(text > 0, np.log(1 - chance) - CHANGE, -0.05)
    gain[~own] = 0.0
    choice = np.zeros((n, 3), int)
    best = gain.copy()
    for i in range(n - 1, 0, -1):
        up, (c, m, x) = page.parents[i], best[i].tolist()
        if not own[i]:  # goes with what holds it
            choice[i] = (CONTAINER, MAIN, CLUTTER)
            best[up] += best[i]
            continue
        options = (c, m - CHANGE, x - CHANGE)
        choice[i, CONTAINER] = int(np.argmax(options))
        best[up, CONTAINER] += max(options)
        choice[i, MAIN] = MAIN if m >= x - CHANGE else CLUTTER
        best[up, MAIN] += max(m, x - CHANGE)
        choice[i, CLUTTER] = CLUTTER
        best[up, CLUTTER] += x
    state = np.zeros(n, int)
    for i in range(1, n):
        state[i] = choice[i, state[page.parents[i]]]
    return state


def blocks(page: Page, state: np.ndarray) -> list[str]:
    """Text of the main elements, a string per block, white space made single."""
    holder = list(range(len(page.tags)))
    for i in range(1, len(page.tags)):
        if page.tags[i] not in BLOCKS:
            holder[i] = holder[page.parents[i]]
    out: list[str] = []
    parts: list[str] = []
    last = 0
    for node, run in page.runs:
        if not run or holder[node] != last:  # an empty run marks where a block starts or ends
            out.append("".join(parts))
            parts, last = [], holder[node]
        if run and state[node] == MAIN and page.tags[node] not in RAW and page.tags[node] not in RCDATA:
            parts.append(run)
    out.append("".join(parts))
    return [x for x in (" ".join(b.split()) for b in out) if x]


def extract(
    pages: DataFrame, trees: Trees | None, source: str = "html", keep=("page_id", "url")
) -> DataFrame:
    """``keep``, then ``text`` and ``n_chars`` of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(trees)  # a few hundred tree nodes

    def make():
        model = sent.value

        def work(sources):
            texts = []
            for at in range(0, len(sources), 64):
                read = [Page(s or "") for s in sources[at : at + 64]]
                values = [features(p) for p in read]
                chance = probabilities(model, np.concatenate(values))
                ends = np.cumsum([len(v) for v in values])
                for page, part in zip(read, np.split(chance, ends[:-1])):
                    texts.append("\n".join(blocks(page, decode(page, part, decided(page)))))
            return texts, [len(t) for t in texts]

        return work

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return map_text(pages, source, keep, fields, make)


@query("op10_main_text")
def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract(pages, train(pages))
