"""Linear classifiers on sparse hashed features, fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class SparseRows:
    """Rows of (bucket, value) pairs, end to end; ``begins`` has one entry per row and the end."""

    begins: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of(rows: list[tuple[bytes, bytes]], width: int) -> "SparseRows":
        """From int32 buckets and float32 values in bytes."""
        buckets = [np.frombuffer(b, dtype=np.int32) for b, _ in rows]
        values = [np.frombuffer(v, dtype=np.float32) for _, v in rows]
        begins = np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int64)
        return SparseRows(begins, np.concatenate(buckets or [np.zeros(0, np.int32)]),
                          np.concatenate(values or [np.zeros(0, np.float32)]), width)

    def take(self, chosen: np.ndarray) -> "SparseRows":
        parts = [slice(self.begins[i], self.begins[i + 1]) for i in np.flatnonzero(chosen)]
        lengths = [p.stop - p.start for p in parts]
        return SparseRows(
            np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
            np.concatenate([self.buckets[p] for p in parts] or [self.buckets[:0]]),
            np.concatenate([self.values[p] for p in parts] or [self.values[:0]]), self.width)

    def times(self, weights: np.ndarray) -> np.ndarray:
        if not len(self.values):
            return np.zeros(len(self.begins) - 1)
        # A row without pairs would take its neighbour's first one.
        sums = np.add.reduceat(self.values * weights[self.buckets],
                               np.minimum(self.begins[:-1], len(self.values) - 1))
        return np.where(np.diff(self.begins) > 0, sums, 0.0)

    def weighted_sum(self, factors: np.ndarray) -> np.ndarray:
        each = np.repeat(factors, np.diff(self.begins))
        return np.bincount(self.buckets, weights=self.values * each, minlength=self.width)


def _fit(rows: SparseRows, slope, l2: float, rounds: int, rate: float
         ) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch steps scaled per weight; ``slope`` is the loss gradient."""
    weights, bias = np.zeros(rows.width), 0.0
    drift, spread = np.zeros(rows.width + 1), np.zeros(rows.width + 1)
    count = max(1, len(rows.begins) - 1)
    for step in range(1, rounds + 1):
        pull = slope(rows.times(weights) + bias) / count
        gradient = np.append(rows.weighted_sum(pull) + l2 * weights, pull.sum())
        drift = 0.9 * drift + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient ** 2
        move = rate * (drift / (1 - 0.9 ** step)) / (
            np.sqrt(spread / (1 - 0.99 ** step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, float(bias)


def fit_logistic(rows: SparseRows, positive: np.ndarray, l2: float = 1e-4, rounds: int = 120,
                 rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression; the result's sum is the log odds of ``positive``."""
    return _fit(rows, lambda s: 1 / (1 + np.exp(-np.clip(s, -35, 35))) - positive,
                l2, rounds, rate)


def fit_svm(rows: SparseRows, positive: np.ndarray, l2: float = 1e-4, rounds: int = 80,
            rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge); positive sums mean ``positive``.

    Both classes weigh the same, however many rows they have.
    """
    sign = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    share = share * len(sign)
    return _fit(rows, lambda s: -2 * share * sign * np.maximum(0, 1 - sign * s), l2, rounds, rate)


def fit_platt(scores: np.ndarray, positive: np.ndarray, rounds: int = 50
              ) -> tuple[float, float]:
    """Slope and offset that turn scores into calibrated log odds (Newton steps).

    Targets are pulled off 0 and 1 by the class sizes, so separable scores
    still give finite values.
    """
    above, below = positive.sum(), len(positive) - positive.sum()
    target = np.where(positive, (above + 1) / (above + 2), 1 / (below + 2))
    slope, offset = 1.0, 0.0
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(slope * scores + offset, -35, 35)))
        error, weight = chance - target, np.maximum(chance * (1 - chance), 1e-9)
        gradient = np.array([(error * scores).sum(), error.sum()])
        curve = np.array([[(weight * scores ** 2).sum() + 1e-6, (weight * scores).sum()],
                          [(weight * scores).sum(), weight.sum() + 1e-6]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        slope, offset = slope - step[0], offset - step[1]
    return float(max(slope, 1e-6)), float(offset)
