"""Sums over dense rows: the one distributed step of the iterative fits.

A row is ``(key, label, x array<double>)``, all of one length. Each partition
adds up what a function makes of its Arrow batches. A few short vectors go to the
driver as they are; longer or more ones are cut into pieces, and each piece is summed by
its own group over the partitions. So the driver receives at most ``GROUPS`` rows and
``SENT`` bytes, or one vector where that is longer, however many partitions there are.
Rows should come straight from a stored table: the number of partitions is then known
without running anything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

GROUPS = 32
SENT = 1 << 18      # bytes of partial sums for the driver in one pass


def matrix(batch: pa.RecordBatch, col: str = "x") -> np.ndarray:
    """The rows' vectors as a matrix."""
    flat = batch.column(col).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 0)


def column(batch: pa.RecordBatch, col: str) -> np.ndarray:
    return batch.column(col).to_numpy(zero_copy_only=False)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder once, in partitions sized by adaptive
    execution, for the many passes of a fit."""
    path = scratch_path(df.sparkSession, name)
    df.hint("rebalance").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def total(df: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``fn(batch)``, vectors of ``size`` doubles, over all batches."""
    parts = df.rdd.getNumPartitions()
    lots = max(1, min(GROUPS, SENT // (8 * size)))             # partial sums of the whole vector
    pieces = 1 if parts <= lots else max(1, min(GROUPS // lots, size))
    ends = [size * i // pieces for i in range(pieces + 1)]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(size)
        for b in batches:
            if b.num_rows:
                acc += fn(b)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * pieces, pa.int64()),
                                          pa.array(range(pieces), pa.int64()),
                                          pa.array([acc[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())],
                                         names=["p", "i", "s"])

    def add(key, rows):     # without hints: applyInArrow fails on hints for some parameters only
        g, i = (k.as_py() for k in key)
        rows = rows.sort_by("p")
        acc = np.zeros(ends[i + 1] - ends[i])
        for s in rows.column("s").to_pylist():
            acc += np.frombuffer(s)
        return pa.table({"p": pa.array([g], pa.int64()), "i": pa.array([i], pa.int64()),
                         "s": pa.array([acc.tobytes()], pa.binary())})

    sums = df.mapInArrow(part, "p long, i long, s binary")
    if parts > lots:
        sums = (sums.withColumn("g", F.pmod("p", F.lit(lots))).groupBy("g", "i")
                .applyInArrow(add, "p long, i long, s binary"))
    out = np.zeros(size)
    for r in sorted(sums.collect(), key=lambda r: (r["p"], r["i"])):
        out[ends[r["i"]]:ends[r["i"] + 1]] += np.frombuffer(r["s"])
    return out


def predicted(df: DataFrame, key: str, score: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``(key, label, prediction)``: 1 where the score of a row is above 0."""
    kind = df.schema[key].dataType.simpleString()

    def label(batches):
        for b in batches:
            got = (score(matrix(b)) > 0).astype(np.int32) if b.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("label"), pa.array(got)],
                                             names=[key, "label", "prediction"])
    return df.select(key, F.col("label").cast("int").alias("label"), "x").mapInArrow(
        label, f"{key} {kind}, label int, prediction int")
