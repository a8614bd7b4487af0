"""Gradient-boosted trees on histograms, for a binary label, and their flat form.

Training works on a bounded sample: values become bins by quantiles, and each
tree is grown level by level from sums of gradients by node, feature and bin.
A tree of depth d is complete: node i has the children 2i+1 and 2i+2, so a
forest is three arrays, and all rows walk down all trees by indexing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """feature and threshold by tree and inner node, value by tree and leaf, and the score before any tree."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row: rows walk down one level of all trees at a time."""
        trees, inner = self.feature.shape
        if not trees or not len(rows):
            return np.full(len(rows), self.start)
        offsets = np.arange(trees) * inner
        feature, threshold = self.feature.ravel(), self.threshold.ravel()
        node = np.zeros((len(rows), trees), np.int64)
        at = np.arange(len(rows))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            flat = node + offsets
            node = 2 * node + 1 + (rows[at, feature[flat]] > threshold[flat])
        leaves = node - inner + np.arange(trees) * (inner + 1)
        return self.start + self.value.ravel()[leaves].sum(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(rows), -500, 500)))


def _bins(rows: np.ndarray, most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bin of every value, and each feature's upper edges of all bins but the last."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, most + 1)[1:-1], method="lower")) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, rows.T, strict=True)], 1)
    return binned, edges


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 2.0,
    least: int = 10,
) -> Forest:
    """Trees that lower the logistic loss; least: rows on either side of a split.

    With no rows, or labels all alike, the forest is empty and its score the
    smoothed share of label 1.
    """
    inner = 2**depth - 1
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    start = float(np.log(share / (1 - share)))
    empty = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    if len(np.unique(labels)) < 2:
        return empty
    binned, edges = _bins(rows, bins)
    count, features = rows.shape
    cells = binned + np.arange(features) * bins
    margin = np.full(count, start)
    feature, threshold, value = (np.zeros((trees, n), kind) for n, kind in ((inner, np.int64), (inner, float), (inner + 1, float)))
    for t in range(trees):
        chance = 1.0 / (1.0 + np.exp(-margin))
        slope, curve = labels - chance, chance * (1 - chance)
        node = np.zeros(count, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (features * bins) + cells).ravel()
            g, h, n = (
                np.bincount(at, np.repeat(x, features), nodes * features * bins).reshape(nodes, features, bins)
                for x in (slope, curve, np.ones(count))
            )
            gl, hl, nl = (x.cumsum(axis=2) for x in (g, h, n))
            gt, ht, nt = (x[:, :, -1:] for x in (gl, hl, nl))
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(nl < least) | (nt - nl < least)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            own_feature, own_bin = best // bins, best % bins
            good = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
            for k in range(nodes):
                limits = edges[own_feature[k]]
                split = good[k] and own_bin[k] < len(limits)
                feature[t, first + k] = own_feature[k] if split else 0
                threshold[t, first + k] = limits[own_bin[k]] if split else np.inf
            right = rows[np.arange(count), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = (np.bincount(leaf, x, inner + 1) for x in (slope, curve))
        value[t] = rate * g / (h + ridge)
        margin += value[t, leaf]
    return Forest(feature, threshold, value, start)
