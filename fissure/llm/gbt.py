"""Gradient-boosted trees in numpy, with monotone constraints, flattened into node arrays for scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """All nodes of all trees in five arrays. A leaf's children are itself, so that every row walks ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total


def _splits(binned, g, h, weight, bins, monotone, low, high, penalty):
    """Best (gain, feature, bin, left value, right value) of one node."""
    best = (1e-6, -1, 0, 0.0, 0.0)
    gs, hs = g.sum(), h.sum()
    base = gs * gs / (hs + penalty)
    for f in range(binned.shape[1]):
        gl = np.cumsum(np.bincount(binned[:, f], g, bins))[:-1]
        hl = np.cumsum(np.bincount(binned[:, f], h, bins))[:-1]
        gr, hr = gs - gl, hs - hl
        vl, vr = np.clip(-gl / (hl + penalty), low, high), np.clip(-gr / (hr + penalty), low, high)
        gain = -(2 * gl * vl + (hl + penalty) * vl**2) - (2 * gr * vr + (hr + penalty) * vr**2) - base
        ok = (hl >= weight) & (hr >= weight) & ((vr - vl) * monotone[f] >= 0)
        gain = np.where(ok, gain, -1)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k, float(vl[k]), float(vr[k]))
    return best


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64, weight: float = 2.0, penalty: float = 1.0) -> Trees:
    """Logistic loss; ``monotone`` has 1 (score never falls as the feature rises), -1 or 0 for each feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), bias)
    nodes: list[list[float]] = []
    roots = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), float(-g.sum() / (h.sum() + penalty))])
        work = [(roots[-1], np.arange(len(y)), -np.inf, np.inf, 0)]
        while work:
            at, rows, low, high, level = work.pop()
            margin[rows] += rate * nodes[at][4] if level == depth else 0
            if level == depth:
                continue
            gain, f, k, vl, vr = _splits(binned[rows], g[rows], h[rows], weight, bins, monotone, low, high, penalty)
            if f < 0 or k >= len(edges[f]):
                margin[rows] += rate * nodes[at][4]
                continue
            go = binned[rows, f] <= k
            left, right = len(nodes), len(nodes) + 1
            nodes[at][:4] = [f, float(edges[f][k]), left, right]
            nodes.append([0, 0.0, left, left, vl])
            nodes.append([0, 0.0, right, right, vr])
            middle = (vl + vr) / 2
            up, down = monotone[f] > 0, monotone[f] < 0
            work.append((left, rows[go], middle if down else low, middle if up else high, level + 1))
            work.append((right, rows[~go], middle if up else low, middle if down else high, level + 1))
    flat = np.array(nodes)
    leaf = flat[:, 2] == np.arange(len(flat))
    return Trees(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), np.where(leaf, rate * flat[:, 4], 0.0), np.array(roots), depth, bias)
