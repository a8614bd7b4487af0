"""Main text of web pages by a graphical model over the tree of blocks.

Every block is content or not. A block's numbers give its own potential; each
edge has a potential for the four pairs of parent and child labels, by the
child's kind of element. Sums of products are passed from the leaves up and from
the root down, which gives each block's exact marginal probability. Training
climbs the likelihood of labelled pages, whose gradient is observed minus
expected numbers under these marginals.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tillroll.llm.dom import FEATURES, OTHER, Page, describe, groups_of, read_page
from tillroll.llm.labelled import smallest_hashes
from tillroll.llm.page_samples import labelled_pages
from tillroll.llm.shingles import sliced

#: Bytes of html that are parsed together.
PAGE_BYTES = 1 << 20
#: Pages to learn from: drawn layouts, and at most so many of the table that mark their article, of at most so many characters.
DRAWN_PAGES = 500
TABLE_PAGES = 150
TABLE_CHARS = 100_000
STEPS = 300
THRESHOLD = 0.5


@dataclass(frozen=True)
class Forest:
    """Blocks of many pages, parents before children; parent -1 for roots."""

    features: np.ndarray
    kind: np.ndarray
    parent: np.ndarray
    levels: list[np.ndarray]


def _forest(pages: Iterable[Page]) -> Forest:
    features, kinds, parents, depths, offset = [], [], [], [], 0
    for page in pages:
        own = np.array(page.parents)
        depth = np.zeros(len(own), np.int64)
        for at in range(1, len(own)):
            depth[at] = depth[own[at]] + 1
        features.append(describe(page))
        kinds.append(groups_of(page))
        parents.append(np.where(own >= 0, own + offset, -1))
        depths.append(depth)
        offset += len(own)
    depth = np.concatenate(depths)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1)))
    return Forest(np.concatenate(features), np.concatenate(kinds), np.concatenate(parents), levels)


@dataclass(frozen=True)
class ContentModel:
    """own: weights of a block's numbers; edge[kind, parent label, child label]."""

    own: np.ndarray
    edge: np.ndarray

    def messages(self, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beliefs from below, messages sent to parents, and full beliefs, as log potentials by label."""
        below = np.zeros((len(forest.parent), 2))
        below[:, 1] = forest.features @ self.own
        sent = np.zeros_like(below)
        edge = self.edge[forest.kind]
        for level in forest.levels[:0:-1]:
            pair = edge[level] + below[level][:, None, :]
            sent[level] = np.logaddexp(pair[:, :, 0], pair[:, :, 1])
            np.add.at(below, forest.parent[level], sent[level])
        full = below.copy()
        for level in forest.levels[1:]:
            outside = full[forest.parent[level]] - sent[level]
            pair = edge[level] + outside[:, :, None]
            full[level] = below[level] + np.logaddexp(pair[:, 0, :], pair[:, 1, :])
        return below, sent, full

    def marginals(self, forest: Forest) -> np.ndarray:
        """Probability of each block to be content."""
        full = self.messages(forest)[2]
        return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -500, 500)))


def fit(forest: Forest, labels: np.ndarray, steps: int = STEPS, rate: float = 0.05, ridge: float = 1e-3) -> ContentModel:
    """Weights that make the labels (0 or 1 by block) likely, by Adam steps on the exact gradient."""
    own, edge = np.zeros(FEATURES), np.zeros((OTHER + 1, 2, 2))
    child = np.flatnonzero(forest.parent >= 0)
    parent, kind = forest.parent[child], forest.kind[child]
    seen_own = forest.features.T @ labels
    seen_edge = np.zeros_like(edge)
    np.add.at(seen_edge, (kind, labels[parent], labels[child]), 1.0)
    weights = np.zeros(own.size + edge.size)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        model = ContentModel(weights[: own.size], weights[own.size :].reshape(edge.shape))
        below, sent, full = model.messages(forest)
        chance = 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -500, 500)))
        pair = (full[parent] - sent[child])[:, :, None] + model.edge[kind] + below[child][:, None, :]
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        expected = np.zeros_like(edge)
        np.add.at(expected, kind, pair)
        slope = np.append(seen_own - forest.features.T @ chance, (seen_edge - expected).ravel()) / len(labels) - ridge * weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights = weights + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return ContentModel(weights[: own.size], weights[own.size :].reshape(edge.shape))


def _labels(page: Page, marked: bool) -> np.ndarray:
    """A label for each block from the nearest region around it; marked: regions are article elements and page furniture."""
    out = np.zeros(len(page.tags), np.int64)
    for at in range(1, len(page.tags)):
        own = page.labels[at]
        if marked:
            own = {"article": 1, "nav": 0, "footer": 0, "aside": 0, "form": 0}.get(page.tags[at])
        out[at] = out[page.parents[at]] if own is None else own
    return out


def train(pages: DataFrame, key: str = "page_id", html: str = "html", drawn: int = DRAWN_PAGES, rows: int = TABLE_PAGES) -> ContentModel:
    """The model learned from drawn labelled layouts and at most `rows` pages of the table with an article element.

    The pages taken have the smallest hashes of their keys and at most
    TABLE_CHARS characters, of pages that repeat a key the least html; an empty
    table leaves the drawn ones.
    """
    own = pages.select(F.col(key).alias("key"), F.col(html).alias("html"))
    own = own.where((F.length("html") <= TABLE_CHARS) & F.col("html").contains("<article"))
    chosen = smallest_hashes(own.select("key").where("key is not null").distinct(), "key", rows)
    # At most `rows` keys, and then as many pages of bounded length.
    found = own.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("html").alias("html")).orderBy("key")
    taken = found.select("html").toArrow()["html"].to_pylist()
    read = [(read_page(h), False) for h in labelled_pages(drawn)] + [(read_page(h), True) for h in taken]
    return fit(_forest(p for p, _ in read), np.concatenate([_labels(p, marked) for p, marked in read]))


def extract_all(htmls: list[str | None], model: ContentModel) -> list[str]:
    """The main text of each page: content blocks' texts in page order, two line feeds between."""
    pages = [read_page(h) for h in htmls]
    if not pages:
        return []
    chance = model.marginals(_forest(pages))
    out, offset = [], 0
    for page in pages:
        out.append("\n\n".join(text for block, text, _ in page.pieces if chance[offset + block] >= THRESHOLD))
        offset += len(page.tags)
    return out


def extract_main_text(pages: DataFrame, model: ContentModel, html: str = "html", name: str = "text") -> DataFrame:
    """All columns and the main text of the whole html; empty if there is none, as for null or empty html.

    White space inside a block is one space and none around it; nothing is cut
    short. Rows are independent, repeated ones stay; an empty table gives an
    empty one. A column of that name is refused.
    """
    if name.lower() in {c.lower() for c in pages.columns}:
        raise ValueError(f"The frame already has a column {name}.")
    schema = T.StructType([*pages.schema.fields, T.StructField(name, T.StringType(), False)])

    def extract(batches):
        for part in sliced(batches, html, PAGE_BYTES):
            texts = extract_all(part.column(html).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return pages.mapInArrow(extract, schema)
