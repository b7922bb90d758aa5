"""A network with one hidden ReLU layer and a logistic output, trained with Adam.

A step is one distributed pass over one part of the training rows: each partition
adds up loss and gradient of its Arrow batches, the driver updates weights and the
two Adam moments (a few vectors of the model's size). Parts are fixed by the MD5
of the key, so the weights after any number of steps do not depend on the
partitioning beyond the last digits of sums.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dense import column, matrix, predicted, stored, total
from .sampling import md5_key


def initial(width: int, hidden: int, seed: int = 0) -> np.ndarray:
    """All parameters as one vector: hidden weights (row by row) and biases, output
    weights and bias. The i-th of a kind is drawn by the MD5 of ``seed|kind|i``, evenly
    within the bounds of Glorot and Bengio for its layer."""
    def drawn(kind: str, n: int, bound: float) -> np.ndarray:
        u = [int(hashlib.md5(f"{seed}|{kind}|{i}".encode()).hexdigest()[:13], 16) for i in range(n)]
        return bound * (2 * (np.array(u, dtype=float) / 16.0 ** 13) - 1)

    a, b = np.sqrt(6.0 / (width + hidden)), np.sqrt(6.0 / (hidden + 1))
    return np.concatenate([drawn("w", width * hidden, a), drawn("b", hidden, a), drawn("v", hidden, b), drawn("c", 1, b)])


def _parts(theta: np.ndarray, width: int, hidden: int):
    cut = width * hidden
    return (theta[:cut].reshape(width, hidden), theta[cut:cut + hidden],
            theta[cut + hidden:cut + 2 * hidden], theta[-1])


def output(x: np.ndarray, theta: np.ndarray, width: int, hidden: int) -> np.ndarray:
    """Log-odds of label 1."""
    w, b, v, c = _parts(theta, width, hidden)
    return np.maximum(x @ w + b, 0) @ v + c


def gradient(x: np.ndarray, y: np.ndarray, theta: np.ndarray, width: int, hidden: int) -> np.ndarray:
    """Rows, summed log loss and its gradient."""
    w, b, v, c = _parts(theta, width, hidden)
    h = np.maximum(x @ w + b, 0)
    z = h @ v + c
    d = 0.5 * (1 + np.tanh(0.5 * z)) - y
    back = d[:, None] * v * (h > 0)
    return np.concatenate([[len(y), np.logaddexp(0, np.where(y > 0, -z, z)).sum()], (x.T @ back).ravel(),
                           back.sum(0), h.T @ d, [d.sum()]])


def step(theta, moments, t: int, sums: np.ndarray, decay: np.ndarray, rate: float):
    """One Adam update from the sums of a part; returns parameters, moments, penalised loss."""
    n = max(sums[0], 1.0)
    g = (sums[2:] + decay * theta) / n
    m, s = 0.9 * moments[0] + 0.1 * g, 0.999 * moments[1] + 0.001 * g * g
    pace = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
    return (theta - pace * m / (np.sqrt(s) + 1e-8), (m, s),
            (sums[1] + 0.5 * float(decay @ (theta * theta))) / n)


def train_network(train: DataFrame, width: int, key: str, hidden: int = 100, parts: int = 2, max_epochs: int = 40,
                  rate: float = 0.01, alpha: float = 1e-4, tol: float = 1e-4, patience: int = 10,
                  seed: int = 0) -> np.ndarray:
    """The parameters after at most ``max_epochs`` passes over ``parts`` parts, or when the
    loss of an epoch has not fallen by ``tol`` for ``patience`` epochs."""
    digits = F.conv(F.substring(md5_key(seed, key), 1, 8), 16, 10).cast("long")
    rows = stored(train.select("label", "x", F.pmod(digits, F.lit(parts)).alias("part")), "network-rows")
    theta = initial(width, hidden, seed)
    moments = (np.zeros_like(theta), np.zeros_like(theta))
    decay = np.full(len(theta), alpha)
    decay[width * hidden:width * hidden + hidden] = 0
    decay[-1] = 0
    t, best, waited = 0, np.inf, 0
    for _ in range(max_epochs):
        losses, counts = 0.0, 0.0
        for p in range(parts):
            now = theta
            sums = total(rows.where(F.col("part") == p).select("label", "x"),
                         lambda b: gradient(matrix(b), column(b, "label"), now, width, hidden), 2 + len(theta))
            if not sums[0]:
                continue
            t += 1
            theta, moments, loss = step(theta, moments, t, sums, decay, rate)
            losses, counts = losses + loss * sums[0], counts + sums[0]
        mean = losses / counts if counts else 0.0
        waited = waited + 1 if mean > best - tol else 0
        best = min(best, mean)
        if waited >= patience:
            break
    return theta


def network(train: DataFrame, test: DataFrame, width: int, key: str, hidden: int = 100, **options) -> DataFrame:
    """Predictions for ``test`` of the network fitted on ``train``."""
    theta = train_network(train, width, key, hidden, **options)
    return predicted(test, key, lambda x: output(x, theta, width, hidden))
