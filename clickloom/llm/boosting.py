"""Gradient boosted trees for a binary label, on tables that fit one process.

Newton steps on the logistic loss, features cut into at most ``BINS`` ranges. Used
for samples whose size a parameter bounds; scoring is vectorised over batches.
"""

from __future__ import annotations

import numpy as np

BINS = 32
#: a tree is four arrays over its nodes: feature (-1 for a leaf), threshold, left child, value; the right child follows the left
Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _grow(binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, depth: int, l2: float, least: float) -> Tree:
    feature, threshold, child, value = [], [], [], []
    queue = [(np.arange(len(grad)), 0)]
    # nodes are appended in the order in which they are taken, children in pairs
    waiting = 1
    while queue:
        rows, level = queue.pop(0)
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, -1, 0)
        if level < depth and h > 2 * least:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                at = binned[rows, f]
                left_g = np.cumsum(np.bincount(at, grad[rows], len(cuts) + 1))[:-1]
                left_h = np.cumsum(np.bincount(at, hess[rows], len(cuts) + 1))[:-1]
                gain = left_g**2 / (left_h + l2) + (g - left_g) ** 2 / (h - left_h + l2) - g**2 / (h + l2)
                gain[(left_h < least) | (h - left_h < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k)
        _, f, k = best
        feature.append(f)
        value.append(-g / (h + l2))
        if f < 0:
            threshold.append(0.0)
            child.append(0)
            continue
        threshold.append(edges[f][k])
        child.append(waiting)
        waiting += 2
        goes_left = binned[rows, f] <= k
        queue += [(rows[goes_left], level + 1), (rows[~goes_left], level + 1)]
    return np.array(feature), np.array(threshold), np.array(child), np.array(value)


def _leaf_values(tree: Tree, x: np.ndarray) -> np.ndarray:
    feature, threshold, child, value = tree
    node = np.zeros(len(x), np.int64)
    inner = feature[node] >= 0
    while inner.any():
        at = np.flatnonzero(inner)
        here = node[at]
        right = x[at, feature[here]] > threshold[here]
        node[at] = child[here] + right
        inner = feature[node] >= 0
    return value[node]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, l2: float = 1.0, least: float = 2.0) -> list[Tree]:
    """Trees with the learning rate in their values; their sum is the log-odds, starting at zero."""
    edges = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) > BINS:
            values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1), method="nearest"))
        edges.append((values[1:] + values[:-1]) / 2)
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1) if len(edges) else np.zeros((len(x), 0), int)
    margin, model = np.zeros(len(x)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        feature, threshold, child, value = _grow(binned, edges, p - y, p * (1 - p), depth, l2, least)
        tree = (feature, threshold, child, value * rate)
        margin += _leaf_values(tree, x)
        model.append(tree)
    return model


def margins(model: list[Tree], x: np.ndarray) -> np.ndarray:
    return sum((_leaf_values(t, x) for t in model), np.zeros(len(x)))
