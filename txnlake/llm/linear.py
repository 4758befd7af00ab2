"""Sparse logistic regression on hashed features (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Documents as lists of hashed feature numbers, with some dense features."""

    def __init__(self, features: list[np.ndarray], dense: np.ndarray | None = None) -> None:
        self.lengths = np.array([len(f) for f in features], np.int64)
        self.flat = np.concatenate(features).astype(np.int64) if features else np.empty(0, np.int64)
        self.owner = np.repeat(np.arange(len(features)), self.lengths)
        self.dense = dense if dense is not None else np.empty((len(features), 0))

    def scores(self, weights: np.ndarray, extra: np.ndarray) -> np.ndarray:
        sums = np.bincount(self.owner, weights[self.flat], minlength=len(self.lengths))
        return sums + np.c_[np.ones(len(self.lengths)), self.dense] @ extra


def fit(rows: Rows, target: np.ndarray, size: int, steps: int = 150, rate: float = 0.1,
        ridge: float = 1e-4, scale: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashed weights, [bias, dense weights]) by Adam on the full sample;
    ``target`` may be probabilities. ``scale`` is the value that each hashed
    feature has when present (1 without it)."""
    n = max(1, len(target))
    w, extra = np.zeros(size), np.zeros(1 + rows.dense.shape[1])
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(extra), np.zeros_like(extra)]
    inputs = np.c_[np.ones(len(target)), rows.dense]
    scale = np.ones(size) if scale is None else scale
    for step in range(1, steps + 1):
        error = (sigmoid(rows.scores(w * scale, extra)) - target) / n
        grads = (np.bincount(rows.flat, error[rows.owner], minlength=size) * scale + ridge * w, inputs.T @ error)
        for x, g, m, v in ((w, grads[0], state[0], state[1]), (extra, grads[1], state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w * scale, extra


def log_odds(rows: Rows, target: np.ndarray, size: int, least: int = 3, shrink: float = 3.0) -> np.ndarray:
    """How much more often a feature occurs with target 1 than 0 (log odds),
    shrunk for rare features and 0 for those in fewer than ``least`` rows."""
    df = np.bincount(rows.flat, minlength=size)
    with_1 = np.bincount(rows.flat, target[rows.owner], minlength=size)
    odds = np.log((with_1 + 1) / (target.sum() + 2)) - np.log((df - with_1 + 1) / ((1 - target).sum() + 2))
    return np.where(df >= least, odds * df / (df + shrink), 0.0)
