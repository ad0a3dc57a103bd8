"""Small shared pieces for classifiers: bounded training samples and logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """At most n rows, the least by a seeded hash of the key: the same rows at every run."""
    return rows.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(n)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2, rounds: int = 25) -> np.ndarray:
    """Coefficients (the last is the constant) of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    b = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * max(weight.sum(), 1) / 100)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ b)
        slope = x.T @ (weight * (y - p)) - penalty * b
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        b += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def predict(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sigmoid(x @ b[:-1] + b[-1])
