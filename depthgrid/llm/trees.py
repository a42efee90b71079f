"""Gradient-boosted trees for a binary label, on histograms, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Forest:
    """Full binary trees of one depth: at inner node k go to 2k+1 (value <= cut) or 2k+2."""

    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    bias: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.bias), np.arange(len(x))
        inner = self.features.shape[1]
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


def fit_forest(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.3,
    penalty: float = 1.0, least: float = 2.0,
) -> Forest:
    """Newton boosting of the logistic loss; ``least`` is a leaf's smallest sum of curvature."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    coded = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
    slots = coded + np.arange(x.shape[1]) * BINS
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    margin, inner = np.full(len(x), bias), 2**depth - 1
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            if len(rows):
                size = x.shape[1] * BINS
                own = slots[rows].ravel()
                sums = [
                    np.bincount(own, np.repeat(v[rows], x.shape[1]), size).reshape(-1, BINS).cumsum(axis=1)
                    for v in (g, h)
                ]
                (gl, hl), (gt, ht) = sums, (g[rows].sum(), h[rows].sum())
                gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty)
                gain[(hl < least) | (ht - hl < least)] = -np.inf
                best = int(gain.argmax())
                f, b = divmod(best, BINS)
                if gain.flat[best] > gt**2 / (ht + penalty) + 1e-6 and b < len(edges[f]):
                    feature[k], cut[k] = f, edges[f][b]
            node[rows] = 2 * k + 1 + (x[rows, feature[k]] > cut[k])
        at = node - inner
        total_g, total_h = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
        leaf = -rate * total_g / (total_h + penalty)
        margin += leaf[at]
        trees.append((feature, cut, leaf))
    return Forest(*(np.stack(part) for part in zip(*trees)), bias)
