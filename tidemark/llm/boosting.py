"""Histogram gradient boosting of binary labels, as flat arrays for numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Trees side by side: row t of each array is a tree, nodes numbered from the root in layers.

    ``feature`` is -1 at a leaf; the left child of node i is 2i + 1.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = feature[node]
                go = np.where(at < 0, 0, 1 + (x[rows, np.maximum(at, 0)] > threshold[node]))
                node = np.where(go > 0, 2 * node + go, node)
            total += value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 4.0) -> Forest:
    """Grow ``trees`` trees layer by layer on the gradients of the logistic loss.

    Each feature is cut at its quantiles into ``bins``; a layer needs the sums
    of gradients by (node, feature, bin) only.  No row gives an empty forest
    with score 1/2; one class gives its smoothed share.
    """
    n, m = x.shape
    weight = np.ones(n) if weight is None else weight
    share = (float((weight * y).sum()) + 0.5) / (float(weight.sum()) + 1.0)
    size = (2 << depth) - 1
    forest = Forest(np.full((0, size), -1), np.zeros((0, size)), np.zeros((0, size)), float(np.log(share / (1 - share))), depth)
    if not n or share in (0.0, 1.0):
        return forest
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(m)], 1)
    cell = code + np.arange(m) * bins
    margin = np.full(n, forest.base)
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        feature, threshold, value, cut = np.full(size, -1), np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
        node = np.zeros(n, np.int64)
        for layer in range(depth):
            first, wide = (1 << layer) - 1, 1 << layer
            live = node >= first
            if not live.any():
                break
            at = ((node[live] - first)[:, None] * (m * bins) + cell[live]).ravel()
            sums = [np.bincount(at, np.repeat(v[live], m), wide * m * bins).reshape(wide, m, bins) for v in (g, h)]
            left_g, left_h = sums[0].cumsum(2), sums[1].cumsum(2)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(left_h < least / 10) | (right_h < least / 10)] = 0
            best = gain.reshape(wide, -1).argmax(1)
            for k in range(wide):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    feature[first + k], threshold[first + k], cut[first + k] = j, cuts[j][b], b
            split = feature[node]
            go = np.where((split < 0) | (node < first), 0, 1 + (code[np.arange(n), np.maximum(split, 0)] > cut[node]))
            node = np.where(go > 0, 2 * node + go, node)
        total_g, total_h = np.bincount(node, g, size), np.bincount(node, h, size)
        value = -rate * total_g / (total_h + ridge)
        value[feature >= 0] = 0
        margin += value[node]
        made.append((feature, threshold, value))
    forest.feature, forest.threshold, forest.value = (np.stack([t[i] for t in made]) for i in range(3))
    return forest
