"""Reproducible splits and samples.

NumPy's random streams cannot be reproduced in Spark, and ``rand()`` changes
with partitioning, so every random choice here is an order by
``md5('<seed>|<key>')``: uniform, deterministic, partition-independent and
computable by any SQL engine.

Exact sizes need the k-th smallest MD5. It is found by radix selection: rows are
counted by the leading digits of their MD5, then again inside the one bucket that
holds the k-th, until a bucket is taken whole. A pass shuffles counts only, and
the split itself is a map-only comparison with the MD5 found; no row is ranked
or moved. Rows with equal keys have equal MD5s and stay together, on the side of
the first of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 3                  # hex digits settled in a pass: at most 4,096 counts a bucket
LENGTH = 32                 # of an MD5


def md5_key(seed, *cols: str):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def kth_smallest(df: DataFrame, h: Column, ranks: Callable[[dict], list[tuple[object, int]]],
                 group: str | None = None) -> tuple[dict, list[str]]:
    """Rows of each value of ``group`` (None without one), and for each ``(value, k)``
    that ``ranks`` makes of those numbers an MD5 with exactly k rows of that value up
    to it. ``group`` is a column of few values (a class label). The number of passes grows
    with the logarithm of the number of rows."""
    rows = df.select(h.alias("h"), (F.col(group) if group else F.lit(None).cast("int")).alias("g"))

    def counts(some: DataFrame, length: int) -> dict:
        got: dict = {}
        for r in some.groupBy("g", F.substring("h", 1, length).alias("p")).count().collect():
            got.setdefault(r["g"], {})[r["p"]] = r["count"]
        return got

    found = counts(rows, DIGITS)
    totals = {g: sum(c.values()) for g, c in found.items()}
    wanted = ranks(totals)
    at = {i: ("", k) for i, (_, k) in enumerate(wanted)}        # prefix so far, rows still to take
    out = {i: "" if k <= 0 else "f" * LENGTH for i, (g, k) in enumerate(wanted) if k <= 0 or k >= totals.get(g, 0)}
    while len(out) < len(wanted):
        for i, (g, _) in enumerate(wanted):
            if i in out:
                continue
            prefix, left = at[i]
            for p in sorted(x for x in found.get(g, {}) if x.startswith(prefix)):
                n = found[g][p]
                if left <= n:
                    break
                left -= n
            at[i] = (p, left)
            if left == n or len(p) >= LENGTH:
                out[i] = p.ljust(LENGTH, "f")
        asked = {(wanted[i][0], at[i][0]) for i in at if i not in out}
        if asked:
            inside = None
            for g, p in asked:
                one = F.col("g").eqNullSafe(F.lit(g)) & F.col("h").startswith(p)
                inside = one if inside is None else inside | one
            found = counts(rows.where(inside), min(LENGTH, max(len(p) for _, p in asked) + DIGITS))
    return totals, [out[i] for i in range(len(wanted))]


def split_train_test(df: DataFrame, key: str, test_frac: float = 0.1, seed=42) -> DataFrame:
    """Adds ``split`` = 'test' for the first ceil(test_frac * n) rows in MD5
    order, else 'train' (the test share is rounded up, as in the reference)."""
    h = md5_key(seed, key)
    _, (cut,) = kth_smallest(df, h, lambda n: [(None, math.ceil(test_frac * n.get(None, 0)))])
    return df.withColumn("split", F.when(h <= cut, "test").otherwise("train"))


def split_train_eval_test(df: DataFrame, key: str, train_frac: float = 0.7,
                          eval_frac: float = 0.1, seed=0) -> DataFrame:
    """Adds ``split``: exactly int(train_frac*n) 'train' rows, int(eval_frac*n)
    'eval' rows of the rest, the remainder 'test'."""
    h = md5_key(seed, key)

    def ranks(totals):
        n = totals.get(None, 0)
        train = math.floor(train_frac * n)
        return [(None, train), (None, train + math.floor(eval_frac * n))]

    _, (train, evaluation) = kth_smallest(df, h, ranks)
    return df.withColumn("split", F.when(h <= train, "train").when(h <= evaluation, "eval").otherwise("test"))


def _least(totals: dict) -> list[tuple[object, int]]:
    least = min(totals.values(), default=0)
    return [(g, least) for g in totals]


def undersample_majority(df: DataFrame, key: str, label: str, seed=0) -> DataFrame:
    """Balanced set: the majority class cut to the minority's size (first rows
    in MD5 order), the minority kept whole. Equal sizes keep both whole."""
    return _balanced(df, key, label, seed, False)


def cut_majority(df: DataFrame, key: str, label: str, seed=0) -> DataFrame:
    """Only the rows kept from the majority class (of both if equal, none)."""
    return _balanced(df, key, label, seed, True)


def _balanced(df: DataFrame, key: str, label: str, seed, only_cut: bool) -> DataFrame:
    h = md5_key(seed, key)
    totals, cuts = kth_smallest(df, h, _least, label)
    least, kept = min(totals.values(), default=0), F.lit(False)
    for (g, n), cut in zip(totals.items(), cuts):
        if n > least or not only_cut:
            kept = kept | (F.col(label).eqNullSafe(F.lit(g)) & (h <= cut))
    return df.where(kept)


def few_shot_sample(train: DataFrame, key: str, steps: int, n: int = 3) -> DataFrame:
    """For each step 0..steps-1, ``n`` rows without replacement, seeded by
    the step: ``(step, <train columns>)``.

    ``row_number() <= n`` per step gets a map-side WindowGroupLimit, so each
    task ships at most n rows per step.
    """
    from pyspark.sql import Window
    t = train.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    t = t.withColumn("_h", F.md5(F.concat_ws("|", F.col("step").cast("string"),
                                            F.col(key).cast("string"))))
    w = Window.partitionBy("step").orderBy("_h")
    return t.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_h", "_rn")


def dedup_by_md5(texts: DataFrame, text: str, seen: DataFrame, seen_md5: str = "md5") -> DataFrame:
    """Texts whose MD5 is not in ``seen``, each once: ``(md5, text)``."""
    t = texts.select(F.md5(F.col(text)).alias("md5"), F.col(text).alias(text))
    return (t.join(seen.select(F.col(seen_md5).alias("md5")), "md5", "left_anti")
            .dropDuplicates(["md5"]))


def remainder(all_ids: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Ids not in ``used`` (set difference as an anti-join)."""
    return all_ids.join(used.select(key), key, "left_anti")
