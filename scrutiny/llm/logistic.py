"""Two small logistic regressions: dense with a ridge, and sparse with a lasso; calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_dense(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4,
              steps: int = 300) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent; classes weigh the same. Rows of ``x`` have norm about 1."""
    weight = balanced(y)
    x = x.astype(np.float32, copy=False)
    w, look = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    bias = bias_look = 0.0
    longest = max((np.square(x[at:at + 256]).sum(1).max() for at in range(0, len(x), 256)), default=0)
    rate = 1 / (0.25 * (longest + 1) + ridge)
    for step in range(steps):
        g = (sigmoid(x @ look + bias_look) - y) * weight
        new = look - np.float32(rate) * (g.astype(np.float32) @ x + np.float32(ridge) * look)
        new_bias = bias_look - rate * g.sum()
        pull = step / (step + 3)
        look, bias_look = new + np.float32(pull) * (new - w), new_bias + pull * (new_bias - bias)
        w, bias = new, new_bias
    return w, bias


def fit_sparse(columns: np.ndarray, sizes: np.ndarray, n_columns: int, y: np.ndarray,
               lasso: float = 4e-4, steps: int = 150,
               rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Presence features: row i has the next ``sizes[i]`` entries of ``columns``.

    Proximal steps with a rate of each column's own; the lasso leaves words without evidence
    at exactly zero, so long texts do not add up noise.
    """
    weight = balanced(y)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    w, seen, bias, bias_seen = np.zeros(n_columns), np.full(n_columns, 1e-8), 0.0, 1e-8
    for _ in range(steps):
        z = np.bincount(rows, w[columns], len(sizes)) + bias
        g = (sigmoid(z) - y) * weight
        grad = np.bincount(columns, g[rows], n_columns)
        seen += grad * grad
        bias_seen += g.sum() ** 2
        own = rate / np.sqrt(seen)
        w = w - own * grad
        w = np.sign(w) * np.maximum(np.abs(w) - own * lasso, 0)
        bias -= rate / np.sqrt(bias_seen) * g.sum()
    return w, bias


def balanced(y: np.ndarray) -> np.ndarray:
    """Weights under which both classes count half each."""
    ones = y.sum()
    return np.where(y > 0, 0.5 / max(ones, 1), 0.5 / max(len(y) - ones, 1))


def calibrated(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities (Platt's method, smoothed targets)."""
    ones, zeros = y.sum(), len(y) - y.sum()
    if ones == 0 or zeros == 0:
        return 1.0, 0.0
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([z, np.ones(len(z))], 1)
    a = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ a)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        a = a - np.clip(np.linalg.solve(hess, x.T @ (p - target) + 1e-3 * (a - [1, 0])), -1, 1)
    return (float(a[0]), float(a[1])) if a[0] > 0 else (1.0, 0.0)
