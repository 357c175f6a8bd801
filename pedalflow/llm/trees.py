"""Gradient-boosted regression trees for a yes-or-no label, on numpy arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST_ROWS, SMOOTH = 30, 4, 0.3, 32, 5, 1.0


class Forest(NamedTuple):
    """Complete binary trees: node k splits to 2k + 1 (at most the limit) and 2k + 2; a limit of inf sends all left."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    limit: np.ndarray
    value: np.ndarray  # (trees, leaves)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The log odds of each row."""
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, feature[node]] > limit[node])
            total += value[node - self.feature.shape[1]]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosted trees for the labels ``y`` (0 or 1), fitted to the log loss with Newton steps on binned features."""
    n, n_features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    features, limits = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32)
    values = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gain, feature, cut = _best_splits(binned, edges, node - first, width, slope, curve)
            for k in np.flatnonzero(gain > 0):
                features[t, first + k], limits[t, first + k] = feature[k], edges[feature[k]][cut[k]]
            own = features[t, node]
            right = x[np.arange(n), own].astype(np.float32) > limits[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        step = np.bincount(leaf, slope, leaves) / (np.bincount(leaf, curve, leaves) + SMOOTH)
        values[t] = RATE * step
        margin += values[t][leaf]
    return Forest(base, features, limits, values)


def _best_splits(binned, edges, place, width, slope, curve):
    best = np.zeros(width), np.zeros(width, np.int64), np.zeros(width, np.int64)
    g, h, c = np.bincount(place, slope, width), np.bincount(place, curve, width), np.bincount(place, minlength=width)
    whole = g**2 / (h + SMOOTH)
    for f, e in enumerate(edges):
        bins = len(e) + 1
        if bins == 1:
            continue
        at = place * bins + binned[:, f]
        size = width * bins
        left_g = np.bincount(at, slope, size).reshape(width, bins).cumsum(1)[:, :-1]
        left_h = np.bincount(at, curve, size).reshape(width, bins).cumsum(1)[:, :-1]
        left_c = np.bincount(at, minlength=size).reshape(width, bins).cumsum(1)[:, :-1]
        right_g, right_h = g[:, None] - left_g, h[:, None] - left_h
        gain = left_g**2 / (left_h + SMOOTH) + right_g**2 / (right_h + SMOOTH) - whole[:, None]
        gain[(left_c < LEAST_ROWS) | (c[:, None] - left_c < LEAST_ROWS)] = 0
        cut = gain.argmax(1)
        top = gain[np.arange(width), cut]
        better = top > best[0] + 1e-9
        for kept, new in zip(best, (top, np.full(width, f), cut)):
            kept[better] = new[better]
    return best
