"""Gradient-boosted trees for two classes: trees that ask one question on each level, over binned features."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Log odds as the sum of trees; a tree is a (feature, bin) for each level and a value for each leaf."""

    def __init__(self, edges: list[np.ndarray], base: float):
        self.edges, self.base, self.trees = edges, base, []

    def binned(self, features: np.ndarray) -> np.ndarray:
        """features x rows: the bin of each value."""
        return np.stack([np.searchsorted(e, features[:, k], "left").astype(np.uint8) for k, e in enumerate(self.edges)])

    def log_odds(self, bins: np.ndarray) -> np.ndarray:
        found = np.full(bins.shape[1], self.base)
        for questions, values in self.trees:
            found += values[_leaves(bins, questions)]
        return found


def _leaves(bins: np.ndarray, questions: list[tuple[int, int]]) -> np.ndarray:
    leaf = np.zeros(bins.shape[1], np.int64)
    for feature, edge in questions:
        leaf = 2 * leaf + (bins[feature] > edge)
    return leaf


def fit(features: np.ndarray, target: np.ndarray, *, trees: int, depth: int, rate: float, ridge: float = 4.0) -> Boosted:
    """Fit by Newton steps on the logistic loss; each level takes the question that gains most over all its nodes."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in features.T]
    mean = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(edges, float(np.log(mean / (1 - mean))))
    bins = model.binned(features)
    n_features, n = bins.shape
    flat = bins.astype(np.int64) + np.arange(n_features)[:, None] * BINS
    score = np.full(n, model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = target - p, p * (1 - p)
        leaf, questions = np.zeros(n, np.int64), []
        slopes, bends = np.tile(slope, n_features), np.tile(bend, n_features)
        for level in range(depth):
            size = (1 << level) * n_features * BINS
            codes = (flat + leaf * n_features * BINS).ravel()
            both = np.bincount(codes, slopes, size), np.bincount(codes, bends, size)
            g, h = (w.reshape(1 << level, n_features, BINS).cumsum(axis=2) for w in both)
            right_g, right_h = g[:, :, -1:] - g, h[:, :, -1:] - h
            gain = (g**2 / (h + ridge) + right_g**2 / (right_h + ridge)).sum(axis=0)
            feature, edge = divmod(int(gain.argmax()), BINS)
            questions.append((feature, edge))
            leaf = 2 * leaf + (bins[feature] > edge)
        g, h = (np.bincount(leaf, w, 1 << depth) for w in (slope, bend))
        values = rate * g / (h + ridge)
        model.trees.append((questions, values))
        score += values[leaf]
    return model
