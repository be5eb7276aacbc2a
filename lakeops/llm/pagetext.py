"""The main text of web pages: content marginals of a tree-shaped graphical model.

Every block-level element and every run of text of a page is a node that is content or
not. A node's own evidence (tag, names, role, length, links, signs) gives its potential; an
edge's potential says how well the labels of parent and child agree. The page is a tree, so
one pass of sum-product messages from the leaves up and one from the root down give exact
marginals. Runs of text whose marginal is at least a half are the text.

Weights are learned from labelled pages (``labelled_pages``) by following the exact
gradient of the likelihood, which needs the same marginals. Nodes are handled a level at a
time over all pages of a slice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm import dom, labelled_pages

TRAINING_PAGES = 1000
STEPS = 150
SLICE_CHARS = 1 << 20

# Tags with a weight of their own; others share one.
TAGS = (
    "body article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
ROLES = "alert alertdialog article banner complementary contentinfo dialog form main menu navigation search".split()
# Whole words of class and id names, and parts of names.
NAME_WORDS = (
    "ad ads alert aside author body bottom box col content entry foot form gdpr head inner layout legal login logo "
    "main menu message meta modal nav notice page pager partner post rail reply row section side site story tags text top"
).split()
NAME_PARTS = (
    "adsense advert announce article banner brand breadcrumb colophon column comment consent contact container content "
    "cookie copyright credits discuss disqus feedback follow footer header masthead navbar navigation newsletter "
    "overlay pagination popular popup privacy promo recommend register related replies response search share sharing "
    "sidebar signup social sponsor subscribe trending widget wrapper"
).split()

LENGTHS = (0, 10, 25, 60, 120, 300, 1000)
SHARES = (0.0, 0.15, 0.4, 0.7, 0.95)


def _numbered(prefix: str, names: list[str] | tuple) -> list[str]:
    return [f"{prefix}:{name}" for name in names]


FEATURES = (
    _numbered("tag", [*TAGS, "other"])
    + _numbered("role", ROLES)
    + _numbered("word", NAME_WORDS)
    + _numbered("part", NAME_PARTS)
    + ["hidden", "element", "text"]
    + _numbered("under", [*TAGS, "other"])
    + _numbered("element-length", LENGTHS)
    + _numbered("element-links", SHARES)
    + _numbered("text-length", LENGTHS)
    + _numbered("text-links", SHARES)
    + ["text-stop", "text-copyright"]
)
INDEX = {name: i for i, name in enumerate(FEATURES)}
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
STOPS = (".", "!", "?", "…", "。", "！", "？", ":", "\"", "”", "»")


@lru_cache(maxsize=20_000)
def element_features(tag: str, source: str) -> tuple[int, ...]:
    """What the start tag says."""
    found = {INDEX["element"], INDEX[f"tag:{tag}" if tag in TAGS else "tag:other"]}
    if source.strip():
        given = dom.attributes(source)
        names = f"{given.get('class', '')} {given.get('id', '')}"
        low = names.lower()
        words = {w.lower() for w in NAME.findall(names)}
        found.update(INDEX[f"word:{w}"] for w in NAME_WORDS if w in words)
        found.update(INDEX[f"part:{p}"] for p in NAME_PARTS if p in low)
        role = given.get("role", "").strip().lower()
        if role in ROLES:
            found.add(INDEX[f"role:{role}"])
        if "hidden" in given or given.get("aria-hidden") == "true" or HIDDEN.search(given.get("style", "")):
            found.add(INDEX["hidden"])
    return tuple(sorted(found))


def text_features(text: str, above: str) -> list[int]:
    found = [INDEX["text"], INDEX[f"under:{above}" if above in TAGS else "under:other"]]
    if text.endswith(STOPS):
        found.append(INDEX["text-stop"])
    if "©" in text[:200] or "©" in text[-200:]:
        found.append(INDEX["text-copyright"])
    return found


@dataclass
class Forest:
    """Nodes of many pages by level, and (node, feature) pairs."""

    parent: np.ndarray
    levels: list[np.ndarray]
    is_text: np.ndarray
    node: np.ndarray
    feature: np.ndarray


def forest(pages: list[dom.Page]) -> Forest:
    parents, depths, texts, lengths, linked = [], [], [], [], []
    node: list[int] = []
    feature: list[int] = []
    base = 0
    for page in pages:
        for i, (parent, tag, text) in enumerate(zip(page.parent, page.tag, page.text, strict=True)):
            found = element_features(tag, page.attributes[i]) if text is None else text_features(text, page.tag[parent])
            node.extend([base + i] * len(found))
            feature.extend(found)
            parents.append(parent + base if parent >= 0 else -1)
            texts.append(text is not None)
            lengths.append(len(text) if text is not None else 0)
        depths.extend(page.depth)
        linked.extend(page.linked)
        base += len(page.parent)
    parent = np.array(parents, dtype=np.int64)
    depth = np.array(depths, dtype=np.int64)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))
    is_text = np.array(texts, dtype=bool)
    length, links = np.array(lengths, dtype=np.float64), np.array(linked, dtype=np.float64)
    for level in reversed(levels[1:]):
        np.add.at(length, parent[level], length[level])
        np.add.at(links, parent[level], links[level])
    share = links / np.maximum(length, 1)
    own = np.arange(base)
    size = np.searchsorted(LENGTHS, length, side="right") - 1
    rate = np.searchsorted(SHARES, share, side="right") - 1
    kinds = np.where(is_text, INDEX["text-length:0"], INDEX["element-length:0"])
    rates = np.where(is_text, INDEX["text-links:0.0"], INDEX["element-links:0.0"])
    return Forest(
        parent,
        levels,
        is_text,
        np.concatenate([np.array(node, dtype=np.int64), own, own]),
        np.concatenate([np.array(feature, dtype=np.int64), kinds + size, rates + rate]),
    )


def sum_product(trees: Forest, unary: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of "content" of every node, and of every edge's (parent, child) labels.

    ``unary`` is the log potential of "content" (that of "not" is 0), ``edges`` has one
    2 x 2 table of log potentials for element and one for text children. Messages are log
    odds: a factor common to both labels changes no marginal.
    """
    count = len(trees.parent)
    below = unary.astype(np.float64)
    upward, above = np.zeros(count), np.zeros(count)
    table = edges[trees.is_text.astype(np.int64)]
    neither, child, parent_, both = table[:, 0, 0], table[:, 0, 1], table[:, 1, 0], table[:, 1, 1]
    for level in reversed(trees.levels[1:]):
        own = below[level]
        odds = np.logaddexp(parent_[level], both[level] + own) - np.logaddexp(neither[level], child[level] + own)
        upward[level] = odds
        np.add.at(below, trees.parent[level], odds)
    for level in trees.levels[1:]:
        rest = below[trees.parent[level]] + above[trees.parent[level]] - upward[level]
        above[level] = np.logaddexp(child[level], both[level] + rest) - np.logaddexp(neither[level], parent_[level] + rest)
    marginal = 1 / (1 + np.exp(-np.clip(below + above, -700, 700)))
    top = np.maximum(trees.parent, 0)
    rest = below[top] + above[top] - upward
    joint = np.stack([neither, child + below, parent_ + rest, both + rest + below], axis=1)
    joint = np.exp(joint - joint.max(axis=1, keepdims=True))
    return marginal, (joint / joint.sum(axis=1, keepdims=True)).reshape(-1, 2, 2)


@dataclass
class Model:
    weights: np.ndarray
    edges: np.ndarray

    def unary(self, trees: Forest) -> np.ndarray:
        return np.bincount(trees.node, weights=self.weights[trees.feature], minlength=len(trees.parent))

    def marginals(self, trees: Forest) -> np.ndarray:
        return sum_product(trees, self.unary(trees), self.edges)[0]


def labels_of(page: dom.Page) -> np.ndarray:
    """The label of the nearest marked element; unmarked tops are not content."""
    found: list[int] = []
    for parent, source in zip(page.parent, page.attributes, strict=True):
        mark = dom.attributes(source).get("data-label") if source else None
        found.append(int(mark) if mark is not None else (found[parent] if parent >= 0 else 0))
    return np.array(found, dtype=np.int64)


def train(sources: list[str], steps: int = STEPS, decay: float = 3e-4) -> Model:
    """Weights that make the labels of marked pages likely."""
    pages = [dom.read(source) for source in sources]
    trees = forest(pages)
    truth = np.concatenate([labels_of(page) for page in pages])
    children = np.concatenate(trees.levels[1:])
    kind = trees.is_text[children].astype(np.int64)
    seen_edges = np.zeros((2, 2, 2))
    np.add.at(seen_edges, (kind, truth[trees.parent[children]], truth[children]), 1.0)
    seen = np.bincount(trees.feature, weights=truth[trees.node].astype(float), minlength=len(FEATURES))

    size = len(FEATURES)
    value, first, second = np.zeros(size + 8), np.zeros(size + 8), np.zeros(size + 8)
    for step in range(1, steps + 1):
        model = Model(value[:size], value[size:].reshape(2, 2, 2))
        marginal, pairs = sum_product(trees, model.unary(trees), model.edges)
        expected = np.bincount(trees.feature, weights=marginal[trees.node], minlength=size)
        expected_edges = np.stack([pairs[children[kind == k]].sum(axis=0) for k in (0, 1)])
        slope = np.concatenate([seen - expected, (seen_edges - expected_edges).ravel()]) / len(sources) - decay * value
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        value = value + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(value[:size], value[size:].reshape(2, 2, 2))


@lru_cache(maxsize=1)
def trained() -> Model:
    return train(labelled_pages.pages(TRAINING_PAGES))


def texts(model: Model, sources: list[str], threshold: float = 0.5) -> list[str]:
    """Main texts of pages, their blocks in page order joined by a line break."""
    pages = [dom.read(source) for source in sources]
    trees = forest(pages)
    keep = model.marginals(trees) >= threshold
    found, base = [], 0
    for page in pages:
        found.append("\n".join(t for i, t in enumerate(page.text) if t is not None and keep[base + i]))
        base += len(page.parent)
    return found


def extract(
    df: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, from its whole html.

    A null or empty html gives an empty text. Repeated and null ids stay as they are, rows
    do not meet each other, other columns are not read. The model is trained on the driver
    from ``TRAINING_PAGES`` labelled pages of the library unless given; tasks handle pages
    of about ``SLICE_CHARS`` characters at a time.
    """
    fitted = model or trained()
    schema = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, start, held, sources = batch.column("html"), 0, 0, []
            for i in range(batch.num_rows):
                sources.append(column[i].as_py() or "")
                held += len(sources[-1])
                if held >= SLICE_CHARS or i + 1 == batch.num_rows:
                    found = texts(fitted, sources)
                    part = batch.slice(start, len(sources))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("page_id"),
                            part.column("url"),
                            pa.array(found, pa.string()),
                            pa.array([len(t) for t in found], pa.int64()),
                        ],
                        ["page_id", "url", "text", "n_chars"],
                    )
                    start, held, sources = i + 1, 0, []

    rows = df.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
