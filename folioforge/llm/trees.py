"""Gradient-boosted trees on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32
DEPTH = 4
TREES = 80
RATE = 0.2
RIDGE = 1.0


@dataclass
class Forest:
    """Trees of one depth: node k of a level has the children 2k and 2k + 1 of the next."""

    base: float
    edges: list[np.ndarray]
    features: np.ndarray  # tree x inner node
    cuts: np.ndarray  # tree x inner node; bins above it go right
    leaves: np.ndarray  # tree x leaf

    def logits(self, x: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)
        flat, width = bins.ravel(), bins.shape[1]
        rows = np.arange(len(x)) * width
        out = np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                at = node + (2**level - 1)
                node = 2 * node + (flat[rows + feature[at]] > cut[at])
            out += leaf[node]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Boost trees on the logistic loss of labels 0 and 1."""
    edges = []
    for column in x.T:
        cuts = np.unique(np.quantile(column, np.arange(1, BINS) / BINS, method="lower"))
        edges.append(cuts[cuts < column.max()])
    bins = np.stack([np.searchsorted(e, column) for e, column in zip(edges, x.T, strict=True)], axis=1)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    logit = np.full(len(y), base)
    features = np.zeros((trees, 2**DEPTH - 1), np.int64)
    cuts = np.full((trees, 2**DEPTH - 1), BINS, np.int64)
    leaves = np.zeros((trees, 2**DEPTH))
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            count = 2**level
            best = np.full(count, 1e-6)
            for j in range(x.shape[1]):
                cell = node * BINS + bins[:, j]
                gg = np.bincount(cell, g, count * BINS).reshape(count, BINS)
                hh = np.bincount(cell, h, count * BINS).reshape(count, BINS)
                left_g, left_h = gg.cumsum(1)[:, :-1], hh.cumsum(1)[:, :-1]
                all_g, all_h = gg.sum(1, keepdims=True), hh.sum(1, keepdims=True)
                gain = (left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE)
                        - all_g**2 / (all_h + RIDGE))
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                better = top > best
                best[better] = top[better]
                features[t, count - 1 : 2 * count - 1][better] = j
                cuts[t, count - 1 : 2 * count - 1][better] = at[better]
            inner = node + (count - 1)
            node = 2 * node + (bins[np.arange(len(y)), features[t, inner]] > cuts[t, inner])
        sums_g, sums_h = np.bincount(node, g, 2**DEPTH), np.bincount(node, h, 2**DEPTH)
        leaves[t] = -RATE * sums_g / (sums_h + RIDGE)
        logit += leaves[t, node]
    return Forest(base, edges, features, cuts, leaves)
