"""Gradient-boosted trees on a bounded sample: grown with numpy, scored as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees in one set of node arrays; a leaf points to itself, so every row takes ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row: rows x features in, all trees at once for blocks of rows."""
        out = np.empty(len(rows))
        for start in range(0, len(rows), 4096):
            block = rows[start:start + 4096]
            node = np.broadcast_to(self.roots, (len(block), len(self.roots))).copy()
            at = np.arange(len(block))[:, None]
            for _ in range(self.depth):
                down = block[at, self.feature[node]] <= self.threshold[node]
                node = np.where(down, self.left[node], self.right[node])
            out[start:start + 4096] = self.base + self.value[node].sum(axis=1)
        return out


def _bins(column: np.ndarray, most: int) -> np.ndarray:
    """Upper edges of the bins of one feature: distinct values, or quantiles if there are too many."""
    values = np.unique(column)
    if len(values) > most:
        values = np.unique(np.quantile(column, np.linspace(0, 1, most), method="lower"))
    return values[:-1] if len(values) > 1 else values


def grow(rows: np.ndarray, labels: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4,
         rate: float = 0.15, bins: int = 64, least: int = 5, ridge: float = 1.0) -> Forest:
    """Logistic gradient boosting with histograms.

    ``monotone`` has +1, -1 or 0 for each feature: the score never falls, never rises, or is free as the feature
    grows. A split against the constraint is not taken, and values of leaves are kept between the bounds
    that the splits above have set.
    """
    n, width = rows.shape
    edges = [_bins(rows[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], rows[:, f]) for f in range(width)], axis=1)
    odds = np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(odds / (1 - odds)))
    margin = np.full(n, base)
    nodes: list[list] = []
    roots = []

    def leaf_value(gradient: float, curvature: float, low: float, high: float) -> float:
        return float(np.clip(-gradient / (curvature + ridge), low, high))

    def build(members: np.ndarray, level: int, low: float, high: float, gradients, curvatures) -> int:
        g, h = gradients[members].sum(), curvatures[members].sum()
        value = leaf_value(g, h, low, high)
        index = len(nodes)
        nodes.append([0, np.inf, index, index, rate * value])
        best = (1e-6, None)
        if level < depth and len(members) >= 2 * least:
            for f in range(width):
                size = len(edges[f]) + 1
                codes = binned[members, f]
                count = np.cumsum(np.bincount(codes, minlength=size))[:-1]
                gl = np.cumsum(np.bincount(codes, gradients[members], size))[:-1]
                hl = np.cumsum(np.bincount(codes, curvatures[members], size))[:-1]
                vl = np.clip(-gl / (hl + ridge), low, high)
                vr = np.clip(-(g - gl) / (h - hl + ridge), low, high)
                # Loss that the two clipped leaf values save, to second order.
                gain = -(gl * vl + (hl + ridge) * vl**2 / 2 + (g - gl) * vr + (h - hl + ridge) * vr**2 / 2)
                gain += g * value + (h + ridge) * value**2 / 2
                allowed = (count >= least) & (len(members) - count >= least)
                if monotone[f]:
                    allowed &= monotone[f] * (vr - vl) >= 0
                if allowed.any():
                    k = int(np.argmax(np.where(allowed, gain, -np.inf)))
                    if gain[k] > best[0]:
                        best = (gain[k], (f, k, vl[k], vr[k]))
        if best[1]:
            f, k, vl, vr = best[1]
            middle = (vl + vr) / 2
            lows, highs = (low, low), (high, high)
            if monotone[f] > 0:
                lows, highs = (low, middle), (middle, high)
            elif monotone[f] < 0:
                lows, highs = (middle, low), (high, middle)
            down = binned[members, f] <= k
            left = build(members[down], level + 1, lows[0], highs[0], gradients, curvatures)
            right = build(members[~down], level + 1, lows[1], highs[1], gradients, curvatures)
            nodes[index] = [f, edges[f][k], left, right, 0.0]
        return index

    for _ in range(trees if n else 0):
        chance = 1 / (1 + np.exp(-margin))
        first = len(nodes)
        roots.append(build(np.arange(n), 0, -np.inf, np.inf, chance - labels, chance * (1 - chance)))
        tree = flat(nodes, [first], 0.0, depth)
        margin = margin + tree.margin(rows)
    return flat(nodes, roots, base, depth)


def flat(nodes: list[list], roots: list[int], base: float, depth: int) -> Forest:
    columns = list(zip(*nodes, strict=True)) if nodes else [(), (), (), (), ()]
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    arrays = [np.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return Forest(*arrays, np.array(roots, np.int64), base, depth)
