"""Gradient-boosted trees on histograms, for two classes: fitted in numpy on a bounded sample, applied by walking all
rows down flat arrays at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class BoostSettings:
    trees: int = 80
    depth: int = 4
    rate: float = 0.2
    bins: int = 64
    ridge: float = 1.0  # added to the second derivative of every node
    least: float = 5.0  # rows that a side of a split must have


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: the children of node i are 2i + 1 and 2i + 2, values sit below the last level."""

    start: float
    feature: np.ndarray  # (trees, 2^depth - 1)
    limit: np.ndarray  # a row goes right if its feature is above
    value: np.ndarray  # (trees, 2^depth)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = self.value.shape[1].bit_length() - 1
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            out += value[node - (len(value) - 1)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, settings: BoostSettings = BoostSettings()) -> Trees:
    """Trees for the log-odds of ``y`` (0 or 1). With one class only, or no rows, the start is all there is."""
    n, columns = x.shape
    positive = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(positive / (1 - positive)))
    inner, leaves = 2**settings.depth - 1, 2**settings.depth
    feature = np.zeros((0, inner), np.int64)
    if n == 0 or y.min() == y.max():
        return Trees(start, feature, np.zeros((0, inner)), np.zeros((0, leaves)))
    marks = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, settings.bins + 1)[1:-1])) for j in range(columns)]
    binned = np.stack([np.searchsorted(m, x[:, j], "left") for j, m in enumerate(marks)], axis=1)
    width = settings.bins
    flat = binned + np.arange(columns) * width
    margin = np.full(n, start)
    features, limits, values = [], [], []
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        tree_feature, tree_limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(settings.depth):
            first, nodes = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (columns * width) + flat).ravel()
            size = nodes * columns * width
            g = np.bincount(cell, np.repeat(slope, columns), size).reshape(nodes, columns, width).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(curve, columns), size).reshape(nodes, columns, width).cumsum(axis=2)
            c = np.bincount(cell, minlength=size).reshape(nodes, columns, width).cumsum(axis=2)
            score = lambda a, b: a * a / (b + settings.ridge)
            rest_g, rest_h, rest_c = g[:, :, -1:] - g, h[:, :, -1:] - h, c[:, :, -1:] - c
            gain = score(g, h) + score(rest_g, rest_h) - score(g[:, :, -1:], h[:, :, -1:])
            gain[(c < settings.least) | (rest_c < settings.least)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k in range(nodes):
                j, b = divmod(int(best[k]), width)
                if gain[k, j, b] > 1e-9 and b < len(marks[j]):
                    tree_feature[first + k], tree_limit[first + k] = j, marks[j][b]
            node = 2 * node + 1 + (x[np.arange(n), tree_feature[node]] > tree_limit[node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, curve, leaves)
        value = -settings.rate * g / (h + settings.ridge)
        margin += value[leaf]
        features.append(tree_feature)
        limits.append(tree_limit)
        values.append(value)
    return Trees(start, np.array(features), np.array(limits), np.array(values))
