"""Gradient-boosted trees of logistic loss over binned features, small enough to ship with a task.

A level of a tree grows from sums alone, of gradients and curvatures per node, feature and bin. :meth:`BoostedTrees.fit`
takes them from one array; rows that lie elsewhere give theirs part by part (:meth:`BoostedTrees.sums`), and
:meth:`BoostedTrees.split` takes the total.
"""

from __future__ import annotations

import numpy as np

BINS = 32
# Sums are integers of this part of one, so they don't depend on order.
UNIT = 1 << 20


class BoostedTrees:
    """Binary classifier. Trees are complete, of one depth, each level choosing a split per node."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.3, leaf_weight: float = 1.0):
        self.trees, self.depth, self.rate, self.leaf_weight = trees, depth, rate, leaf_weight
        self.edges: list[np.ndarray] = []
        self.splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def begin(self, edges: list[np.ndarray], share: float) -> BoostedTrees:
        """No trees yet, for features cut at ``edges`` (``BINS`` - 1 at most) and the ``share`` of class 1."""
        share = min(max(share, 1e-3), 1 - 1e-3)
        self.edges, self.splits, self.base = edges, [], float(np.log(share / (1 - share)))
        self._open()
        return self

    def _open(self) -> None:
        self.level, inner = 0, 2**self.depth - 1
        self._feature, self._border = np.zeros(inner, int), np.full(inner, BINS)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        weight = np.ones(len(y)) if weight is None else weight
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1], method="lower")) for c in x.T]
        self.begin(edges, float(np.average(y, weights=weight)))
        binned = self._binned(x)
        for _ in range(self.trees * self.depth):
            self.split(self.sums(binned, y, weight))
        return self

    def sums(self, binned: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Gradients and curvatures of some rows, (2, nodes, features, bins), for the level that grows next."""
        p = 1 / (1 + np.exp(-self._margin(binned)))
        parts = [np.rint(weight * (y - p) * UNIT), np.rint(weight * p * (1 - p) * UNIT)]
        node = self._node(binned, self._feature, self._border, self.level) * BINS
        cells = 2**self.level * BINS
        found = [[np.bincount(node + column, part, cells) for column in binned.T] for part in parts]
        return np.array(found).reshape(2, -1, 2**self.level, BINS).swapaxes(1, 2).astype(np.int64)

    def split(self, sums: np.ndarray) -> None:
        """Grow one level by the sums over all rows; the last one ends the tree."""
        g, h = np.cumsum(sums, axis=3) / UNIT
        total_g, total_h = g[:, :1, -1:], h[:, :1, -1:]
        gain = g**2 / (h + self.leaf_weight) + (total_g - g) ** 2 / (total_h - h + self.leaf_weight) - total_g**2 / (total_h + self.leaf_weight)
        gain = gain[:, :, :-1].reshape(len(gain), -1)
        nodes, at = np.arange(len(gain)), gain.argmax(axis=1)
        # A border of ``BINS`` sends all to the left.
        gains = gain[nodes, at] > 1e-6
        feature, border = np.where(gains, at // (BINS - 1), 0), np.where(gains, at % (BINS - 1), BINS)
        own = slice(len(nodes) - 1, 2 * len(nodes) - 1)
        self._feature[own], self._border[own] = feature, border
        self.level += 1
        if self.level == self.depth:
            cut = np.minimum(border, BINS - 1)
            left_g, left_h = g[nodes, feature, cut], h[nodes, feature, cut]
            leaf_g = np.stack([left_g, total_g[:, 0, 0] - left_g], axis=1).ravel()
            leaf_h = np.stack([left_h, total_h[:, 0, 0] - left_h], axis=1).ravel()
            self.splits.append((self._feature, self._border, self.rate * leaf_g / (leaf_h + self.leaf_weight)))
            self._open()

    @staticmethod
    def _node(binned: np.ndarray, feature: np.ndarray, border: np.ndarray, levels: int) -> np.ndarray:
        """The place of each row in a level of a tree."""
        node, rows = np.zeros(len(binned), dtype=int), np.arange(len(binned))
        for _ in range(levels):
            node = 2 * node + 1 + (binned[rows, feature[node]] > border[node])
        return node - (2**levels - 1)

    def _margin(self, binned: np.ndarray) -> np.ndarray:
        score = np.full(len(binned), self.base)
        for feature, border, value in self.splits:
            score += value[self._node(binned, feature, border, self.depth)]
        return score

    def predict_binned(self, binned: np.ndarray) -> np.ndarray:
        """Probability of class 1 of features given as bins."""
        return 1 / (1 + np.exp(-self._margin(binned)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        return self.predict_binned(self._binned(x)) if len(x) else np.zeros(0)
