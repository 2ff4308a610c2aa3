"""Small linear learners for bounded training samples."""

from __future__ import annotations

import numpy as np


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 1000.0, steps: int = 100) -> tuple[np.ndarray, float]:
    """Weights and bias of a squared-hinge linear SVM for labels -1/+1, classes weighing alike;
    accelerated full-batch gradient steps from zero, so the result is deterministic."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1)).astype(x.dtype)
    y = y.astype(x.dtype)
    lipschitz = 1 / c + 2 * (1 + float((x * x).sum(axis=1).max(initial=0)))
    w = np.zeros(x.shape[1] + 1, dtype=x.dtype)
    at = w
    for k in range(steps):
        slope = -2 * weight * y * np.maximum(0, 1 - y * (x @ at[:-1] + at[-1]))
        new = at - np.append(slope @ x + at[:-1] / c, slope.sum()) / lipschitz
        at = (new + k / (k + 3) * (new - w)).astype(x.dtype)
        w = new
    return w[:-1].astype(float), float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by damped Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = sigmoid(z @ w)
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return w


def sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))
