"""Gradient-boosted trees for a yes/no target, in numpy (histograms, fixed depth)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Trees:
    """Full binary trees of one depth: feature and threshold by inner node, value by leaf."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.2,
          penalty: float = 2.0, least: float = 4.0) -> Trees:
    """Log-loss boosting with second-order leaf values; deterministic."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    logit = np.full(n, base)
    inner = 2**depth - 1
    features, thresholds, leaves = [], [], []
    flat = (bins + np.arange(width) * BINS).ravel()
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = ((node - first) * (width * BINS))[:, None].repeat(width, 1).ravel() + flat
            shape = (count, width, BINS)
            gs = np.bincount(cell, np.repeat(g, width), count * width * BINS).reshape(shape).cumsum(axis=2)
            hs = np.bincount(cell, np.repeat(h, width), count * width * BINS).reshape(shape).cumsum(axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
            gain[(hs < least) | (ht - hs < least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        value = -rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + penalty)
        logit += value[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), base)
