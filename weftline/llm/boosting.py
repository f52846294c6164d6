"""Gradient-boosted trees for a yes/no label and isotonic calibration, over bounded NumPy matrices."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Boosted depth-limited trees on binned features, with a monotone map of their sum to a probability."""

    edges: list[np.ndarray]
    depth: int
    base: float
    features: list[np.ndarray] = field(default_factory=list)  # of each tree, by heap position
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros(x.shape, np.int64)

    def _walk(self, codes: np.ndarray, tree: int) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        for _ in range(self.depth):
            at = 2 * at + 1 + (codes[rows, self.features[tree][at]] > self.cuts[tree][at])
        return at - (2**self.depth - 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        codes, out = self.codes(x), np.full(len(x), self.base)
        for tree in range(len(self.leaves)):
            out += self.leaves[tree][self._walk(codes, tree)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        m = self.margin(x)
        raw = 1 / (1 + np.exp(-m))
        if self.knots is None:
            return raw
        flat = np.interp(m, *self.knots)
        # Equal calibrated values stay in the order of the margins, by a share too small to move a decision.
        return np.clip(flat * (1 - 1e-6) + raw * 1e-6, 0, 1)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Trees by second-order boosting of the log loss over feature histograms."""
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(x.shape[1])]
    share = np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4)
    model = Trees(edges, depth, float(np.log(share / (1 - share))))
    codes, margin = model.codes(x), np.full(len(x), model.base)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, bins, np.int64), np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            node = at - first
            gain, pick = np.full(n, 1e-9), [(0, bins)] * n
            total_g, total_h = np.bincount(node, g, n), np.bincount(node, h, n)
            for f in range(x.shape[1]):
                key = node * (bins + 1) + codes[:, f]
                gl = np.bincount(key, g, n * (bins + 1)).reshape(n, -1).cumsum(axis=1)[:, :-1]
                hl = np.bincount(key, h, n * (bins + 1)).reshape(n, -1).cumsum(axis=1)[:, :-1]
                gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
                value = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (total_g**2 / (total_h + ridge))[:, None]
                value[(hl < 1e-3) | (hr < 1e-3)] = -1
                top = value.argmax(axis=1)
                for k in np.flatnonzero(value[np.arange(n), top] > gain):
                    gain[k], pick[k] = value[k, top[k]], (f, int(top[k]))
            for k, (f, c) in enumerate(pick):
                feature[first + k], cut[first + k] = f, c
            at = 2 * at + 1 + (codes[np.arange(len(x)), feature[at]] > cut[at])
        leaf = at - inner
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(value)
        margin += value[leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing map of score to the mean of y (pool adjacent violators)."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v, w in zip(score[order], y[order], weight[order], strict=True):
        blocks.append([v * w, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    x = [e for b in blocks for e in ((b[2],) if b[2] == b[3] else (b[2], b[3]))]
    v = [b[0] / b[1] for b in blocks for _ in range(1 if b[2] == b[3] else 2)]
    return np.array(x), np.array(v)
