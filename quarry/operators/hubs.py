"""Pairs of items that share a key, with hot keys split into blocks.

A key with ``s`` items yields s*(s-1)/2 pairs. Left to a plain equi-join, all
of them come out of one task. Keys above ``hub_size`` items are cut into an
r x r grid (r = ceil(s / hub_size)): the left copy of an item goes to row
``hash(item) % r`` of every column, the right copy to column ``hash(item) % r``
of every row, and each grid cell is its own join task holding about
hub_size**2 pairs. Every ordered pair meets in exactly one cell, and
``left < right`` keeps each unordered pair once. Non-hub keys use r = 1, which
is the plain self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HUB = 2000
TASK_PAIRS = 1 << 20        # about so many items and pairs pass through one join task


def hub_table(df: DataFrame, key: str, hub_size: int) -> DataFrame:
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_sz"))
    return sizes.where(F.col("_sz") > hub_size).select(
        key, F.ceil(F.col("_sz") / F.lit(hub_size)).cast("int").alias("_r"))


def pair_tasks(df: DataFrame, key: str) -> int:
    """How many tasks the items and the pairs of items sharing a key should be dealt over:
    adaptive execution sizes tasks by the bytes they read, which says nothing about pairs."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_sz"))
    rows = sizes.agg(F.sum(F.col("_sz") * (F.col("_sz") + 1) / 2)).first()[0] or 0
    return max(1, -(-int(rows) // TASK_PAIRS))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, dealt out by their number: a few bytes each, they would be merged
    into tasks whose hash tables grow with the input."""
    return deal(df, -(-df.count() // TASK_PAIRS), *df.columns).distinct()


def deal(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Rows dealt over ``n`` tasks by ``cols``. Adaptive execution neither merges nor
    caps a stated number, so a task's rows do not grow with the input."""
    return df.repartition(n, *cols) if n > 1 else df


def pairs_sharing_key(df: DataFrame, key: str, item: str, hub_size: int = DEFAULT_HUB,
                      tasks: int | None = None) -> DataFrame:
    """``(key, left, right)`` for every two distinct items under one key,
    left < right. Input rows ``(key, item)`` must be distinct; ``df`` is read
    twice, so hand over a written table. ``tasks`` is its ``pair_tasks``, if known.
    The hub table has at most a row for ``hub_size`` items and is broadcast: Spark, which
    sees the sizes of all keys before the hubs are picked, would shuffle and sort
    all items to join it, in tasks that grow with the input."""
    base = df.select(key, item)
    n = tasks or pair_tasks(base, key)
    hubs = hub_table(base, key, hub_size)
    t = base.join(F.broadcast(hubs), key, "left").withColumn("_r", F.coalesce(F.col("_r"), F.lit(1)))
    own = F.pmod(F.xxhash64(F.col(item)), F.col("_r").cast("long")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_r") - 1))
    left = t.select(key, F.col(item).alias("left"), own.alias("_i"), every.alias("_j"))
    right = t.select(key, F.col(item).alias("right"), every.alias("_i"), own.alias("_j"))
    return (deal(left, n, key, "_i", "_j").join(deal(right, n, key, "_i", "_j"), [key, "_i", "_j"])
            .where(F.col("left") < F.col("right"))
            .select(key, "left", "right"))
