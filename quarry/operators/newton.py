"""Logistic regression and the kernel support vector machine by Newton steps.

Both minimise ``|w|^2 / 2 + C * sum(loss(y (w.x + b)))`` with a free intercept.
One pass over the rows gives loss, gradient and second derivative as one partial
sum a partition (``dense.total``); the system solved on the driver has the size of the
model. A step that does not lower the objective is halved.

The machine with kernel ``exp(-gamma |x - z|^2)`` is fitted over all training rows
(``svm``). Only a caller that states a number of ``landmarks`` gets the bounded form, made
linear by a Nystroem map: so many training rows, first in MD5 order, span the feature
space. Its hinge loss is approached through quadratic corners of falling width.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import svm
from .dense import column, matrix, predicted, total
from .sampling import md5_key

Loss = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def logistic_loss(m: np.ndarray):
    """Loss, first and second derivative at margins ``m``."""
    p = 0.5 * (1 + np.tanh(-0.5 * m))           # 1 / (1 + exp(m))
    return np.logaddexp(0, -m), -p, p * (1 - p)


def hinge_loss(width: float) -> Loss:
    """max(0, 1 - m) with its corner rounded over ``1 - width .. 1``."""
    def loss(m):
        gap = 1 - m
        bent = (gap > 0) & (gap < width)
        value = np.where(bent, gap * gap / (2 * width), np.maximum(gap - width / 2, 0))
        return value, np.where(bent, -gap / width, -(gap >= width).astype(float)), bent / width
    return loss


def _pass(rows: DataFrame, w: np.ndarray, loss: Loss, features) -> tuple[float, np.ndarray, np.ndarray]:
    n = len(w)

    def part(batch):
        x = features(matrix(batch))
        x = np.hstack([x, np.ones((len(x), 1))])
        y = 2.0 * column(batch, "label") - 1
        value, slope, curve = loss(y * (x @ w))
        return np.concatenate([[value.sum()], x.T @ (slope * y), ((x * curve[:, None]).T @ x).ravel()])

    got = total(rows.select("label", "x"), part, 1 + n + n * n)
    return float(got[0]), got[1:1 + n], got[1 + n:].reshape(n, n)


def newton(rows: DataFrame, width: int, loss: Loss, c: float = 1.0, start: np.ndarray | None = None,
           features=lambda x: x, tol: float = 1e-8, max_rounds: int = 100, damped: bool = True) -> np.ndarray:
    """Weights and intercept. Stops when the gradient's norm is at most ``tol`` or no
    shorter step lowers the objective any more."""
    w = np.zeros(width + 1) if start is None else start
    ridge = np.append(np.ones(width), 0.0)

    def at(w):
        value, slope, curve = _pass(rows, w, loss, features)
        return (0.5 * float(ridge @ (w * w)) + c * value, ridge * w + c * slope,
                np.diag(ridge) + c * curve)

    value, slope, curve = at(w)
    for _ in range(max_rounds):
        if np.linalg.norm(slope) <= tol:
            break
        if curve[-1, -1] <= 0:                  # no row bends: the intercept is held for this step
            curve[-1, -1] = 1.0
        step = np.linalg.solve(curve, -slope)
        size = 1.0
        while True:
            new = at(w + size * step)
            if not damped or new[0] <= value + 1e-4 * size * float(slope @ step) or size < 1e-6:
                break
            size /= 2
        if damped and new[0] >= value and np.linalg.norm(new[1]) >= np.linalg.norm(slope):
            break
        w, (value, slope, curve) = w + size * step, new
    return w


def logistic(train: DataFrame, test: DataFrame, width: int, key: str, c: float = 1.0) -> DataFrame:
    """Predictions for ``test`` of the model with penalty ``|w|^2 / 2`` fitted on ``train``."""
    w = newton(train, width, logistic_loss, c)
    return predicted(test, key, lambda x: x @ w[:-1] + w[-1])


# ------------------------------------------------------------ kernel machine
def gamma_scale(train: DataFrame, width: int) -> float:
    """1 / (width * variance of all cells); 1 where that variance is 0."""
    n, s, q = total(train.select("x"), lambda b: np.array([matrix(b).size, matrix(b).sum(), (matrix(b) ** 2).sum()]), 3)
    spread = q / n - (s / n) ** 2 if n else 0.0
    return 1.0 / (width * spread) if spread > 0 else 1.0


def nystroem(train: DataFrame, key: str, landmarks: int, gamma: float, seed=0):
    """The map from rows to coordinates whose inner products are the kernel's
    projection on the landmark rows."""
    marks = np.array([r["x"] for r in train.select("x", md5_key(seed, key).alias("_h"))
                      .orderBy("_h").limit(landmarks).collect()], dtype=float)
    marks = np.unique(marks, axis=0)

    def kernel(x):
        d = (x * x).sum(1)[:, None] + (marks * marks).sum(1)[None, :] - 2 * x @ marks.T
        return np.exp(-gamma * np.maximum(d, 0))

    value, vector = np.linalg.eigh(kernel(marks))
    kept = value > 1e-10 * max(value[-1], 1e-300)
    root = vector[:, kept] / np.sqrt(value[kept])
    return (lambda x: kernel(x) @ root), int(kept.sum())


def rbf_svm(train: DataFrame, test: DataFrame, width: int, key: str, c: float = 1.0,
            landmarks: int | None = None, gamma: float | None = None, seed=0,
            corners=(1.0, 0.3, 0.1, 0.03, 0.01)) -> DataFrame:
    """Predictions for ``test`` of the machine with a radial kernel fitted on ``train``.

    All training rows span it. ``landmarks``, where stated, bounds the model: that many
    training rows span it, while its loss and derivatives are sums over all of them.
    ``corners`` are the widths of the rounded hinge, of which the last counts; each
    bounded fit starts from the one before."""
    gamma = gamma or gamma_scale(train, width)
    if landmarks is None:
        return svm.predicted(train, test, key, c, gamma, corners[-1])
    features, size = nystroem(train, key, landmarks, gamma, seed)
    w = None
    for corner in corners:
        w = newton(train, size, hinge_loss(corner), c, w, features, tol=1e-3, max_rounds=30)
    return predicted(test, key, lambda x: features(x) @ w[:-1] + w[-1])


def newton_rounds(rows: DataFrame, width: int, rounds: int, c: float = 1.0) -> list[list[float]]:
    """Weights and intercept of logistic regression after each of ``rounds`` full steps."""
    out, w = [], None
    for _ in range(rounds):
        w = newton(rows, width, logistic_loss, c, w, tol=0.0, max_rounds=1, damped=False)
        out.append(w.tolist())
    return out
