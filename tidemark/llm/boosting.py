"""Gradient-boosted trees: logistic loss, one forest per class, histogram splits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete trees of one depth: split column and threshold per inner node, value per leaf."""
    columns: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        depth = int(np.log2(self.leaves.shape[1]))
        rows = np.arange(len(x))
        for col, cut, leaf in zip(self.columns, self.thresholds, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, col[at]] > cut[at])
            out += leaf[at - (leaf.size - 1)]
        return out


def fit_forest(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3,
               bins: int = 32, l2: float = 1.0) -> Forest:
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)   # code <= b  <=>  x <= edge[b]
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4))
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    inner, out = (1 << depth) - 1, []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        col, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            best = np.zeros(many)
            for j in range(m):
                key = (at - first) * bins + code[:, j]
                gs = np.bincount(key, g, many * bins).reshape(many, bins)
                hs = np.bincount(key, h, many * bins).reshape(many, bins)
                gl, hl = np.cumsum(gs, 1)[:, :-1], np.cumsum(hs, 1)[:, :-1]
                gt, ht = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                gain = gl**2 / (hl + l2) + (gt - gl)**2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain = gain[:, :len(edges[j])]
                if not gain.shape[1]:
                    continue
                b = np.argmax(gain, 1)
                top = gain[np.arange(many), b]
                for node in np.flatnonzero(top > best + 1e-12):
                    best[node], col[first + node], cut[first + node] = top[node], j, edges[j][b[node]]
            at = 2 * at + 1 + (x[np.arange(n), col[at]] > cut[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        margin += value[leaf]
        out.append((col, cut, value))
    return Forest(*[np.array(v) for v in zip(*out)], base)
