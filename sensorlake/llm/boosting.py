"""Gradient-boosted trees for a yes/no label, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: a feature and a limit for each inner node, a value for each leaf."""

    prior: float
    feature: np.ndarray  # trees x (2^depth - 1)
    limit: np.ndarray
    value: np.ndarray  # trees x 2^depth

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        depth = int(self.value.shape[1]).bit_length() - 1
        for f, lim, val in zip(self.feature, self.limit, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > lim[at])
            total += val[at - (len(val) - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32,
        ridge: float = 5.0) -> Trees:
    """Newton boosting of the logistic loss; every level splits each node where the gain is largest."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    score = np.full(n, prior)
    features, limits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        feat, lim = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            local = at - first
            best, split = np.zeros(nodes), np.full((nodes, 2), -1)
            sum_g, sum_h = np.bincount(local, g, nodes), np.bincount(local, h, nodes)
            base = sum_g ** 2 / (sum_h + ridge)
            for j in range(m):
                if not len(edges[j]):
                    continue
                width = len(edges[j]) + 1
                key = local * width + binned[:, j]
                left_g = np.bincount(key, g, nodes * width).reshape(nodes, width).cumsum(1)[:, :-1]
                left_h = np.bincount(key, h, nodes * width).reshape(nodes, width).cumsum(1)[:, :-1]
                gain = left_g ** 2 / (left_h + ridge) + (sum_g[:, None] - left_g) ** 2 / (sum_h[:, None] - left_h + ridge) \
                    - base[:, None]
                k = gain.argmax(1)
                more = gain[np.arange(nodes), k] > best + 1e-9
                best[more] = gain[np.arange(nodes), k][more]
                split[more] = np.stack([np.full(nodes, j), k], 1)[more]
            for node in np.flatnonzero(split[:, 0] >= 0):
                j, k = split[node]
                feat[first + node], lim[first + node] = j, edges[j][k]
            at = 2 * at + 1 + (x[np.arange(n), feat[at]] > lim[at])
        leaf = at - (2 ** depth - 1)
        value = rate * np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + ridge)
        score += value[leaf]
        features.append(feat)
        limits.append(lim)
        values.append(value)
    return Trees(prior, np.array(features), np.array(limits), np.array(values))
