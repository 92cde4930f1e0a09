"""Gradient-boosted trees on dense features, and isotonic calibration, for a bounded training sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth, level by level: the feature and cut of each inner node, the value of each leaf."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds for each row of features."""
        out = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 120, depth: int = 3, rate: float = 0.15, bins: int = 64, least: float = 8.0) -> Trees:
    """Logistic loss, second-order leaf values, cuts at quantiles of each feature."""
    n, width = x.shape
    share = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    place = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
    scale = weight / weight.mean()
    inner = 2**depth - 1
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), start)
    raw = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = scale * (p - y), scale * p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            best = np.full(many, 1e-9)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                slots = len(cuts[f]) + 1
                slot = (node - first) * slots + place[:, f]
                g, h, c = (
                    np.bincount(slot, v, many * slots).reshape(many, slots).cumsum(axis=1) for v in (grad, hess, np.ones(n))
                )
                gl, hl, cl = g[:, :-1], h[:, :-1], c[:, :-1]
                gr, hr, cr = g[:, -1:] - gl, h[:, -1:] - hl, c[:, -1:] - cl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(cl < least) | (cr < least)] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(many), at]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                out.feature[t, first + better] = f
                out.cut[t, first + better] = cuts[f][at[better]]
            node = 2 * node + 1 + (x[np.arange(n), out.feature[t, node]] > out.cut[t, node])
        leaf = node - inner
        value = -np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + 1)
        out.leaf[t] = rate * value
        raw += out.leaf[t][leaf]
    return out


def fit_isotonic(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(raw scores, probabilities), both rising: pool adjacent violators; probabilities in between are interpolated."""
    order = np.argsort(raw, kind="stable")
    xs, first = np.unique(raw[order], return_index=True)
    w = np.add.reduceat(weight[order], first)
    v = np.add.reduceat((weight * y)[order], first) / w
    blocks: list[list[float]] = []  # value, weight, least and greatest raw score
    for x, value, mass in zip(xs, v, w):
        blocks.append([value, mass, x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b = blocks.pop()
            a = blocks[-1]
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1] += b[1]
            a[3] = b[3]
    return np.array([x for b in blocks for x in (b[2], b[3])]), np.array([p for b in blocks for p in (b[0], b[0])])
