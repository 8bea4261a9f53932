"""Generalised additive model with pairwise interactions, boosted cyclically.

A text's features are cut into bins. Shallow trees are boosted one feature at a
time, round after round, each a step function of its feature's bins, so that
their sum is one table per feature. Then the pairs of features whose joint split
explains most of what is left get tables of their own. A score is the sum of the
tables' entries at the text's bins.

The fit runs on the driver over a bounded sample of feature rows.
"""

from __future__ import annotations

import numpy as np

BINS = 48
PAIR_BINS = 12
ROUNDS = 80
PAIRS = 8
PAIR_ROUNDS = 30
RATE = 0.15
RIDGE = 2.0
LEAST_ROWS = 10


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def gain(g, h):
    return g * g / (h + RIDGE)


def best_cut(g, h, n):
    """(gain, first bin of the right side) of the best split of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    gs, hs, ns = np.cumsum(g), np.cumsum(h), np.cumsum(n)
    left, right = gain(gs[:-1], hs[:-1]), gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1])
    value = left + right - gain(gs[-1], hs[-1])
    value[(ns[:-1] < LEAST_ROWS) | (ns[-1] - ns[:-1] < LEAST_ROWS)] = 0
    k = int(np.argmax(value))
    return float(value[k]), k + 1


def shallow_tree(g, h, n):
    """Leaf values per bin of a tree of up to three leaves."""
    out = np.zeros(len(g))
    best, cut = best_cut(g, h, n)
    edges = [0, len(g)]
    if best > 0:
        edges = [0, cut, len(g)]
        (lv, lc), (rv, rc) = best_cut(g[:cut], h[:cut], n[:cut]), best_cut(g[cut:], h[cut:], n[cut:])
        if max(lv, rv) > 0:
            edges = sorted([*edges, lc if lv >= rv else cut + rc])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def quadrants(g, h):
    """(gain, leaf values) of the best pair of splits of a grid."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def four(s):
        low = s[:-1, :-1]
        top, side, all_ = s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        return low, top - low, side - low, all_ - top - side + low

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    parts = list(zip(four(gs), four(hs), strict=True))
    value = sum(gain(a, b) for a, b in parts) - gain(gs[-1, -1], hs[-1, -1])
    i, j = np.unravel_index(int(np.argmax(value)), value.shape)
    leaf = np.zeros(g.shape)
    for (a, b), rows, cols in zip(parts, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)), (slice(0, j + 1), slice(j + 1, None)) * 2, strict=True):
        a, b = np.broadcast_to(a, value.shape), np.broadcast_to(b, value.shape)
        leaf[rows, cols] = a[i, j] / (b[i, j] + RIDGE)
    return float(value[i, j]), leaf


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Model of a feature matrix and 0/1 labels, as plain arrays.

    Without both labels it is the smoothed share of label 1.
    """
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = {"base": float(np.log(rate / (1 - rate))), "cuts": [], "tables": [], "pairs": []}
    if not len(y) or y.min() == y.max():
        return model
    width = x.shape[1]
    cuts = [cut_points(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables, strict=True)]
    score = np.full(len(y), model["base"])
    for _ in range(ROUNDS):
        for j in range(width):
            p = sigmoid(score)
            g, h = (np.bincount(bins[j], w, minlength=len(tables[j])) for w in (y - p, p * (1 - p)))
            leaf = RATE * shallow_tree(g, h, counts[j])
            tables[j] += leaf
            score += leaf[bins[j]]
    coarse_cuts = [cut_points(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(coarse_cuts)]

    def grid(i, j, w):
        shape = len(coarse_cuts[i]) + 1, len(coarse_cuts[j]) + 1
        return np.bincount(coarse[i] * shape[1] + coarse[j], w, minlength=shape[0] * shape[1]).reshape(shape)

    p = sigmoid(score)
    g, h = y - p, p * (1 - p)
    ranked = sorted(((quadrants(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(width) for j in range(i)), reverse=True)
    pairs = [(i, j, np.zeros(grid(i, j, g).shape)) for _, i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in pairs:
            p = sigmoid(score)
            leaf = RATE * quadrants(grid(i, j, y - p), grid(i, j, p * (1 - p)))[1]
            table += leaf
            score += leaf[coarse[i], coarse[j]]
    model["cuts"], model["tables"] = cuts, tables
    model["pairs"] = [(i, j, coarse_cuts[i], coarse_cuts[j], table) for i, j, table in pairs]
    return model


def scored(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1: bin lookups, added."""
    total = np.full(len(x), model["base"])
    for j, (cuts, table) in enumerate(zip(model["cuts"], model["tables"], strict=True)):
        total += table[np.searchsorted(cuts, x[:, j], "right")]
    for i, j, a, b, table in model["pairs"]:
        total += table[np.searchsorted(a, x[:, i], "right"), np.searchsorted(b, x[:, j], "right")]
    return sigmoid(total)
