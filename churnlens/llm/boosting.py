"""Gradient-boosted trees for a binary target: numpy histograms, logistic loss."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, least: float = 5.0, l2: float = 1.0):
    """A model (edges, bias, list of trees); a tree is (feature, bound, value) arrays of a complete binary tree."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    code = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(d)], 1)  # code > k means x > edges[k]
    width = bins + 1
    flat = code + np.arange(d) * width
    mean = np.clip((y * weight).sum() / weight.sum(), 1e-6, 1 - 1e-6)
    bias = float(np.log(mean / (1 - mean)))
    f, model = np.full(n, bias), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = (y - p) * weight, p * (1 - p) * weight
        feature, bound = np.full(2**depth - 1, -1), np.zeros(2**depth - 1)
        at = np.zeros(n, int)
        for level in range(depth):
            first = 2**level - 1
            for node in range(first, 2 * first + 1):
                rows = np.nonzero(at == node)[0]
                if len(rows) == 0:
                    continue
                idx = flat[rows].ravel()
                gs = np.bincount(idx, np.repeat(g[rows], d), d * width).reshape(d, width).cumsum(1)
                hs = np.bincount(idx, np.repeat(h[rows], d), d * width).reshape(d, width).cumsum(1)
                gt, ht = gs[0, -1], hs[0, -1]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[(hs < least * 0.05) | (ht - hs < least * 0.05)] = -1
                j, k = np.unravel_index(gain.argmax(), gain.shape)
                if gain[j, k] > 1e-6 and k < len(edges[j]):
                    feature[node], bound[node] = j, edges[j][k]
            go = feature[at] >= 0
            right = go & (x[np.arange(n), np.maximum(feature[at], 0)] > bound[at])
            at = 2 * at + 1 + right
        leaf = at - (2**depth - 1)
        value = np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2) * rate
        f += value[leaf]
        model.append((feature, bound, value))
    return bias, model


def margin(fitted, x: np.ndarray) -> np.ndarray:
    """Log-odds of each row."""
    bias, model = fitted
    out = np.full(len(x), bias)
    rows = np.arange(len(x))
    for feature, bound, value in model:
        at = np.zeros(len(x), int)
        for _ in range(int(np.log2(len(value)))):
            j = feature[at]
            at = 2 * at + 1 + ((j >= 0) & (x[rows, np.maximum(j, 0)] > bound[at]))
        out += value[at - len(feature)]
    return out
