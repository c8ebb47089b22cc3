"""Sparse logistic regression in numpy, for bounded training samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows as (feature, value) lists: ``starts`` has a start per row and the end."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray
    width: int

    @staticmethod
    def of(rows: list[dict[int, float]], width: int) -> Sparse:
        starts = np.cumsum([0] + [len(r) for r in rows])
        index = np.fromiter((k for r in rows for k in r), np.int64, starts[-1])
        value = np.fromiter((v for r in rows for v in r.values()), np.float64, starts[-1])
        return Sparse(starts, index, value, width)

    def times(self, w: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.value * w[self.index])])
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(x: Sparse, extra: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, rounds: int = 120) -> np.ndarray:
    """Weights of the sparse features, of the dense columns ``extra``, and the bias, by accelerated gradient descent."""
    n, d = len(y), x.width
    dense = np.hstack([extra, np.ones((n, 1))])
    owner = x.owner()
    square = np.bincount(owner, x.value**2, n) + (dense**2).sum(1)
    # the loss bends at most by a quarter of the mean row norm; a larger one is met by halving the step
    step = 4.0 / max(1e-9, float((weight * square).sum() / weight.sum()) * weight.sum()) * 4
    w = np.zeros(d + dense.shape[1])
    ridge = np.full(len(w), l2)
    ridge[-1] = 0.0

    def loss_and_slope(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.times(w[:d]) + dense @ w[d:]
        p = sigmoid(z)
        r = weight * (p - y)
        loss = float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (ridge * w * w).sum())
        return loss, np.concatenate([np.bincount(x.index, x.value * r[owner], d), dense.T @ r]) + ridge * w

    at, pace = w, 1.0
    last = np.inf
    for _ in range(rounds):
        loss, slope = loss_and_slope(at)
        for _ in range(30):
            new = at - step * slope
            new_loss = loss_and_slope(new)[0]
            if new_loss <= loss - 0.5 * step * float(slope @ slope):
                break
            step /= 2
        nxt = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        if new_loss > last:  # restart the momentum
            at, pace = new, 1.0
        else:
            at = new + (pace - 1) / nxt * (new - w)
            pace = nxt
        if abs(last - new_loss) < 1e-7 * max(1.0, abs(new_loss)):
            w = new
            break
        w, last = new, new_loss
        step *= 1.1
    return w
