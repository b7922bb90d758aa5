"""Ordered computations over a whole table without a single-task window.

A window with no PARTITION BY sends every row to one task. The helpers here
split the ordering into monotone buckets instead: each bucket is ordered by a
partitioned window, and what crosses a bucket border (running offsets, the
neighbour row) is computed on a table with one row per bucket. That table has
a proven size bound (the bucket count), so it is the only thing broadcast.

Bucket columns must be monotone in the ordering: bucket(x) < bucket(y) implies
x precedes y.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, bucket: str, order: list, values: list[str],
                 out: list[str], inclusive: bool = True) -> DataFrame:
    """Add running sums of ``values`` over the global order (bucket, *order).

    ``inclusive`` includes the current row. Offsets from earlier buckets come
    from a one-row-per-bucket table.
    """
    tot = df.groupBy(bucket).agg(*[F.sum(v).alias(f"_t{i}") for i, v in enumerate(values)])
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(bucket, *[
        F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}")
        for i in range(len(values))])
    hi = 0 if inclusive else -1
    w = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    res = df.join(F.broadcast(off), bucket)
    for i, (v, o) in enumerate(zip(values, out)):
        res = res.withColumn(o, F.col(f"_o{i}") + F.coalesce(F.sum(v).over(w), F.lit(0)))
    return res.drop(*[f"_o{i}" for i in range(len(values))])


def with_neighbours(df: DataFrame, bucket: str, order: list, cols: list[str],
                    prev: bool = True, nxt: bool = True) -> DataFrame:
    """Add ``prev_<c>`` / ``next_<c>`` over the global order and the flags
    ``has_prev`` / ``has_next``.

    Inside a bucket this is lag/lead; at a bucket border the value comes from
    the last (first) row of the nearest non-empty bucket before (after).
    """
    w = Window.partitionBy(bucket).orderBy(*order)
    ordkey = F.struct(*[o if isinstance(o, Column) else F.col(o) for o in order])
    payload = F.struct(*[F.col(c) for c in cols])
    ends = df.groupBy(bucket).agg(F.min_by(payload, ordkey).alias("_first"),
                                  F.max_by(payload, ordkey).alias("_last"))
    wb = Window.orderBy(bucket)
    border = ends.select(bucket,
                         F.lag("_last").over(wb).alias("_pb"),
                         F.lead("_first").over(wb).alias("_nb"))
    res = df.join(F.broadcast(border), bucket)
    if prev:
        first_in_bucket = F.lag(F.lit(1)).over(w).isNull()
        res = res.withColumn("has_prev", ~(first_in_bucket & F.col("_pb").isNull()))
        for c in cols:
            res = res.withColumn(f"prev_{c}", F.when(first_in_bucket, F.col(f"_pb.{c}"))
                                 .otherwise(F.lag(c).over(w)))
    if nxt:
        last_in_bucket = F.lead(F.lit(1)).over(w).isNull()
        res = res.withColumn("has_next", ~(last_in_bucket & F.col("_nb").isNull()))
        for c in cols:
            res = res.withColumn(f"next_{c}", F.when(last_in_bucket, F.col(f"_nb.{c}"))
                                 .otherwise(F.lead(c).over(w)))
    return res.drop("_pb", "_nb")


def range_buckets(df: DataFrame, *order, name: str = "_b") -> DataFrame:
    """``df`` cut into ranges of the ordering, one per shuffle partition, with
    the range's number; written as a checkpoint, so the numbers stay. The
    number of ranges follows ``spark.sql.shuffle.partitions``, as tasks do."""
    from ..session import shared_dir
    shared_dir(df.sparkSession)
    return df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()).checkpoint()
