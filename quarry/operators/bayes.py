"""Gaussian naive Bayes in closed form, for rows that are mostly zeros.

One aggregate over the non-zero cells gives sums and squares for each class and
feature; everything else about a class follows from its row count. The
log-likelihood of a row is that of the all-zero row plus a correction at each
non-zero cell, so scoring is one projection with arrays of the model's size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cells(x: str = "x") -> Column:
    return F.explode(F.filter(F.transform(x, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda c: c.v != 0))


def moments(train: DataFrame, width: int, floor: float = 1e-9) -> dict[int, tuple[float, list[float], list[float]]]:
    """For each class: share of rows, means and variances of the features, each
    variance raised by ``floor`` times the largest variance of a feature over all rows."""
    rows = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sums = (train.select("label", _cells().alias("c")).groupBy("label", "c.i")
            .agg(F.sum("c.v").alias("s"), F.sum(F.col("c.v") * F.col("c.v")).alias("q")).collect())   # classes x features
    n = sum(rows.values())
    s, q = {}, {}
    for r in sums:
        s[r["label"], r["i"]], q[r["label"], r["i"]] = r["s"], r["q"]

    def variance(n, s, q):
        return max(q / n - (s / n) ** 2, 0.0)

    def over_all(of, i):
        return sum(of.get((c, i), 0.0) for c in sorted(rows))

    add = floor * max((variance(n, over_all(s, i), over_all(q, i)) for i in range(width)), default=0.0) if n else 0.0
    return {c: (k / n, [s.get((c, i), 0.0) / k for i in range(width)],
                [variance(k, s.get((c, i), 0.0), q.get((c, i), 0.0)) + add for i in range(width)])
            for c, k in rows.items()}


def log_likelihood(model: tuple[float, list[float], list[float]], x: str = "x") -> Column:
    """Log of prior times density of a row, up to a constant of all classes."""
    prior, mean, var = model
    var = [v if v > 0 else 1.0 for v in var]        # no feature varies at all
    base = math.log(prior) - 0.5 * sum(math.log(v) + m * m / v for m, v in zip(mean, var))
    slope = F.array(*[F.lit(m / v) for m, v in zip(mean, var)])
    curve = F.array(*[F.lit(-0.5 / v) for v in var])
    terms = F.zip_with(F.arrays_zip(F.col(x).alias("v"), slope.alias("s")), curve,
                       lambda a, c: F.when(a.v == 0, 0.0).otherwise(a.v * (a.s + a.v * c)))
    return F.lit(base) + F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def gaussian_nb(train: DataFrame, test: DataFrame, width: int, key: str) -> DataFrame:
    """``(key, label, prediction)`` for ``test``: the class with the greatest
    likelihood, the smaller of equal ones."""
    model = moments(train, width)
    if not model:
        best = F.lit(0)
    else:
        best = F.array_max(F.array(*[F.struct(log_likelihood(m).alias("l"), F.lit(-int(c)).alias("c"))
                                     for c, m in sorted(model.items())])).c * -1
    return test.select(key, F.col("label").cast("int").alias("label"), best.cast("int").alias("prediction"))
