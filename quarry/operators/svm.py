"""The exact kernel support vector machine, over all training rows.

Minimises ``|f|^2 / 2 + C * sum(hinge(y (f(x) + b)))`` over all functions that the kernel
``exp(-gamma |x - z|^2)`` spans at the training rows, with a free intercept; the hinge's
corner is rounded over ``1 - corner .. 1``. Its dual has a multiplier in 0 .. C for every
row. They are moved a working set of ``WORKING`` rows at a time: the rows that break the
optimum's conditions most, and those of the set before that are strictly between the
bounds. The small problem is solved on the driver to the end; then one pass over the
stored rows adds the change to every row's gradient. It ends when no pair of rows breaks
the conditions by ``tol`` or more, so every row has its say and none is left out.

Work is (training rows) x (support vectors) kernels, several times over. A task holds a batch
of rows and the kernels of ``CHUNK`` of them; the driver holds three numbers a training row
and the working set, never the rows or the kernel of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hubs
from .dense import column, matrix
from ..session import scratch_path

WORKING = 2048
CHUNK = 1024
TASK_ROWS = 4096        # training or test rows of a task: few bytes, much work


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Stored with a number ``i`` a row, dealt out by the number of rows."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for b in batches:
            i = pa.array(np.arange(at, at + b.num_rows))
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([i, *b.columns], names=["i", *b.schema.names])

    rows = df.mapInArrow(number, f"i long, {kinds}")
    path = scratch_path(df.sparkSession, name)
    hubs.deal(rows, -(-df.count() // TASK_ROWS), "i").write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(d, 0))


def fetched(rows: DataFrame, numbers: np.ndarray) -> np.ndarray:
    """The vectors of the rows with these numbers, in their order."""
    got = rows.where(F.col("i").isin(numbers.tolist())).select("i", "x").toArrow().combine_chunks()
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(numbers), -1)
    at = np.argsort(got.column("i").to_numpy())
    return x[at][np.argsort(np.argsort(numbers))]


def weighed(rows: DataFrame, numbers: np.ndarray, marks: np.ndarray, weight: np.ndarray, gamma: float) -> np.ndarray:
    """For every row, in the order of the sorted ``numbers``, the sum of its kernels with ``marks``
    times their weights."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b)
                got = np.concatenate([kernel(x[k:k + CHUNK], marks, gamma) @ weight for k in range(0, len(x), CHUNK)])
                yield pa.RecordBatch.from_arrays([pa.array([column(b, "i").astype("<i8").tobytes()], pa.binary()),
                                                  pa.array([got.tobytes()], pa.binary())], names=["i", "v"])
    out = np.zeros(len(numbers))
    for r in rows.select("i", "x").mapInArrow(part, "i binary, v binary").collect():
        out[np.searchsorted(numbers, np.frombuffer(r["i"], "<i8"))] = np.frombuffer(r["v"])
    return out


def sides(s: np.ndarray, a: np.ndarray, c: float) -> tuple[np.ndarray, np.ndarray]:
    """Where ``s * a`` may still rise, and where it may fall."""
    return np.where(s > 0, a < c, a > 0), np.where(s > 0, a > 0, a < c)


def solved(k: np.ndarray, s: np.ndarray, a: np.ndarray, slope: np.ndarray, ridge: float, c: float,
           tol: float) -> np.ndarray:
    """Multipliers that minimise the dual over these rows from ``a`` with gradient ``slope``, their
    signed sum unchanged, by steps of the two rows that gain most."""
    a, h, diag = a.copy(), -s * slope, np.diag(k) + ridge
    up, low = sides(s, a, c)
    while True:
        rise = np.where(up, h, -np.inf)
        i = int(rise.argmax())
        gap = rise[i] - np.where(low, h, np.inf)
        if not gap.max() >= tol:
            return a
        bend = np.maximum(diag[i] + diag - 2 * k[i], 1e-12)
        j = int(np.where(gap > 0, gap * gap / bend, -1).argmax())
        step = min(gap[j] / bend[j], c - a[i] if s[i] > 0 else a[i], a[j] if s[j] > 0 else c - a[j])
        for t, way in ((i, s[i]), (j, -s[j])):
            a[t] += way * step
            a[t] = 0.0 if a[t] < 1e-12 * c else c if a[t] > c * (1 - 1e-12) else a[t]
            up[t], low[t] = sides(s[t], a[t], c)
        h -= step * (k[i] - k[j])
        h[i] -= step * ridge
        h[j] += step * ridge


def fit(rows: DataFrame, c: float, gamma: float, corner: float, tol: float,
        working: int = WORKING) -> tuple[np.ndarray, np.ndarray, float]:
    """Numbers of the support vectors, their signed multipliers and the intercept."""
    ends = rows.select("i", "label").toArrow().sort_by("i")
    numbers, s = ends.column("i").to_numpy(), 2.0 * ends.column("label").to_numpy() - 1
    a, slope, ridge = np.zeros(len(s)), -np.ones(len(s)), corner / c
    before = np.zeros(0, np.int64)
    while True:
        h, (up, low) = -s * slope, sides(s, a, c)
        rise, fall = np.where(up, h, -np.inf), np.where(low, h, np.inf)
        top, bottom = rise.max(initial=-np.inf), fall.min(initial=np.inf)
        if not top - bottom >= tol:
            break
        kept = before[(a[before] > 0) & (a[before] < c)][:working // 2]
        rest = np.ones(len(s), bool)
        rest[kept] = False
        some = max(1, (working - len(kept)) // 2)
        w = kept
        for order, may in ((-rise, up), (fall, low)):
            free = np.flatnonzero(rest & may)
            if len(free) > some:
                free = free[np.argpartition(order[free], some - 1)[:some]]
            rest[free] = False
            w = np.concatenate([w, free])
        x = fetched(rows, numbers[w])
        new = solved(kernel(x, x, gamma), s[w], a[w], slope[w], ridge, c, tol / 2)
        moved = np.flatnonzero(new != a[w])
        if not len(moved):
            break
        change = new[moved] - a[w[moved]]
        slope += s * weighed(rows, numbers, x[moved], s[w[moved]] * change, gamma)
        slope[w[moved]] += ridge * change
        a[w], before = new, w
    free = (a > 0) & (a < c)
    ends = [e for e in (top, bottom) if np.isfinite(e)]
    b = h[free].mean() if free.any() else float(np.mean(ends)) if ends else 0.0
    return numbers[a > 0], (s * a)[a > 0], float(b)


def predicted(train: DataFrame, test: DataFrame, key: str, c: float, gamma: float, corner: float,
              tol: float = 1e-5, working: int = WORKING) -> DataFrame:
    """``(key, label, prediction)`` for ``test``, whose scores are added up over a bounded part of
    the support vectors at a time."""
    rows = numbered(train.select("label", "x"), "svm-train")
    asked = numbered(test.select(F.col(key), F.col("label").cast("int").alias("label"), "x"), "svm-test")
    vectors, weight, b = fit(rows, c, gamma, corner, tol, working)
    numbers = np.sort(asked.select("i").toArrow().column("i").to_numpy())
    score = np.full(len(numbers), b)
    for k in range(0, len(vectors), working):
        some = slice(k, k + working)
        score += weighed(asked, numbers, fetched(rows, vectors[some]), weight[some], gamma)
    positive = score > 0
    kind = asked.schema[key].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            got = positive[np.searchsorted(numbers, column(r, "i"))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([r.column(key), r.column("label"), pa.array(got)],
                                             names=[key, "label", "prediction"])
    return asked.select("i", key, "label").mapInArrow(label, f"`{key}` {kind}, label int, prediction int")
