"""A generalised additive model with pairwise interactions, by cyclic boosting of shallow trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32  # values of a feature are told apart to so many quantiles
PAIR_BINS = 8  # of either feature of a pair
PAIRS = 6  # interactions that are fitted
ROUNDS = 120
RATE = 0.15
RIDGE = 2.0


@dataclass
class Model:
    """Lookup tables: the score's logit is ``base`` plus a cell of each table."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        logit = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            logit += table[np.searchsorted(edges, x[:, j])]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            logit += table[np.searchsorted(self.pair_edges[i], x[:, i]), np.searchsorted(self.pair_edges[j], x[:, j])]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    cuts = np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))
    return cuts[cuts < values.max()] if len(values) else cuts


def _gain(g, h):
    return g * g / (h + RIDGE)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The best place to cut a run of bins, and what it gains."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0, 0.0
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gain))
    return at + 1, float(gain[at])


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step of a tree of depth two over the bins of one feature."""
    step, runs = np.empty(len(g)), [(0, len(g))]
    for _ in range(2):
        cut = []
        for lo, hi in runs:
            at, gain = _split(g[lo:hi], h[lo:hi])
            cut += [(lo, lo + at), (lo + at, hi)] if gain > 1e-9 else [(lo, hi)]
        runs = cut
    for lo, hi in runs:
        step[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + RIDGE)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Step of a tree that cuts one feature and then the other on either side, and its gain."""
    best, found = np.zeros_like(g), 0.0
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        at, _ = _split(gg.sum(1), hh.sum(1))
        step, gain = np.zeros_like(gg), -_gain(gg.sum(), hh.sum())
        for rows in (slice(0, at), slice(at, None)):
            part_g, part_h = gg[rows].sum(0), hh[rows].sum(0)
            cut, _ = _split(part_g, part_h)
            for columns in (slice(0, cut), slice(cut, None)):
                own_g, own_h = part_g[columns].sum(), part_h[columns].sum()
                step[rows, columns] = -own_g / (own_h + RIDGE)
                gain += _gain(own_g, own_h)
        if gain > found:
            best, found = (step.T if turn else step), gain
    return best, found


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Model:
    """Fit to rows ``x`` with labels 0 or 1. Without rows, or with one label, a constant."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])] if len(y) else [np.empty(0)] * x.shape[1]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])] if len(y) else edges
    model = Model(base, edges, [np.zeros(len(e) + 1) for e in edges], [], coarse, [])
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)]
    logit = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return p - y, p * (1 - p)

    for _ in range(rounds):  # features take turns, so correlated ones share what they explain
        for j, own in enumerate(bins):
            g, h = slopes()
            size = len(edges[j]) + 1
            step = RATE * _tree(np.bincount(own, g, size), np.bincount(own, h, size))
            model.tables[j] += step
            logit += step[own]

    shapes = {}
    cells = [np.searchsorted(e, x[:, j]) for j, e in enumerate(coarse)]

    def grid(i, j, values):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(cells[i] * shape[1] + cells[j], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            shapes[i, j] = _pair_tree(grid(i, j, g), grid(i, j, h))[1]
    model.pairs = sorted(shapes, key=lambda pair: (-shapes[pair], pair))[:pairs]
    model.pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(rounds // 2):
        for table, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            g, h = slopes()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            table += step
            logit += step[cells[i], cells[j]]
    return model
