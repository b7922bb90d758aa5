"""Exact length histogram of encoded documents.

One map encodes the texts and keeps only their lengths; Spark counts equal
lengths. The histogram, at most one row per possible length, answers totals,
quantiles and truncated totals for every context limit by sums over it: a
limit that is no length of a document behaves as the next smaller length does,
plus the documents that are cut there. Sums run in buckets of 1,024 lengths
and then over the buckets, so no task orders the whole histogram.

Defined results: null and empty texts have length 0 (no end token is added
unless asked for); repeated rows count as often as they occur; an empty table
gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running_sums
from .common import WordTokenizer, materialise, text_bytes, text_slices


def encoded_lengths(docs: DataFrame, tokenizer: str | None = None, extra: int = 0,
                    text_col: str = "text") -> DataFrame:
    """``(n_tokens)`` of every row, with ``extra`` special tokens each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer.shared(tokenizer)
        for b in batches:
            for _, texts in text_slices(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(tok.lengths(texts) + extra)], ["n_tokens"])

    return docs.select(text_bytes(text_col).alias("_t")).mapInArrow(run, "n_tokens long")


def histogram(docs: DataFrame, tokenizer: str | None = None, extra: int = 0,
              text_col: str = "text") -> DataFrame:
    """``(n_tokens, n_docs)``."""
    return (encoded_lengths(docs, tokenizer, extra, text_col)
            .groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))


def context_limits(hist: DataFrame) -> DataFrame:
    """For every length as the context limit: documents and tokens longer than
    it (suffix sums), all documents' tokens when cut at it, and the part of
    the documents that fits (the quantile rank of the length)."""
    hist = materialise(hist, "lengths")
    rows = hist.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn(
        "_b", F.shiftright("n_tokens", 10))
    total = rows.agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).first()
    docs, tokens = F.lit(total["d"] or 0), F.lit(total["t"] or 0)
    run = running_sums(rows, "_b", ["n_tokens"], ["n_docs", "tokens"], ["_d", "_t"])
    return run.select(
        "n_tokens", "n_docs", (docs - F.col("_d")).cast("long").alias("docs_longer"),
        (tokens - F.col("_t")).cast("long").alias("tokens_longer"),
        (F.col("_t") + (docs - F.col("_d")) * F.col("n_tokens")).cast("long").alias("truncated_tokens"),
        tokens.cast("long").alias("total_tokens"), (F.col("_d") / docs).alias("part_fitting"))


def truncated_total(limits: DataFrame, limit: int) -> int:
    """Tokens left of all documents when each is cut at ``limit``."""
    below = (limits.where(F.col("n_tokens") <= limit).orderBy(F.col("n_tokens").desc()).limit(1).collect())
    if below:
        r = below[0]
        return r["truncated_tokens"] + (limit - r["n_tokens"]) * r["docs_longer"]
    n = limits.agg(F.sum("n_docs")).first()[0] or 0
    return n * limit


def quantile(limits: DataFrame, q: float) -> int | None:
    """The smallest length that at least a part ``q`` of the documents does not exceed."""
    return limits.where(F.col("part_fitting") >= q).agg(F.min("n_tokens")).first()[0]
