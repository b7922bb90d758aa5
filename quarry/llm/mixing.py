"""Mixing sources to target weights by temperature.

* A source's share p is its part of all tokens (words). Weights are
  p**a / sum(p**a); a = 1 keeps the natural mix, a = 0 levels all sources.
* a is bisected on [0, 1] until the weights meet a target: an entropy (in
  nats), or a limit on how often the most repeated source may be repeated.
  Each pass sums 511 trial exponents (nine bisection steps) over the source
  table inside Spark, so the number of sources is not bounded by the driver.
* The budget, in tokens, defaults to the smallest that cuts no source: the
  largest budget/weight ratio decides, so every row is used at least once.
* A source's budget is realised as full epochs of all its rows plus a part of
  one more epoch, taken as a permutation of blocks (hash of the id) and of the
  rows inside them. Only the block where the budget ends is looked into row by
  row. Block totals are summed in two levels, so a source with most of the
  rows is spread over many tasks.

Defined results: null texts count no token; a null source is a source of its
own; rows of a source without any token are kept once; repeated rows are each
counted and used; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_bytes, text_slices

BLOCK_ROWS = 512
SUPER = 256           # blocks of a first-level sum
TRIALS = 512          # 2**9: nine bisection steps per pass
PASSES = 6            # 54 bits


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """``(uid, source, n_tokens)`` of every row; a word is a run of bytes other
    than blank, tab, newline, VT, FF and CR."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, texts in text_slices(b.column(2)):
                n = [len(x.split()) for x in texts]
                part = b.slice(i, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64())],
                                                 ["uid", "source", "n_tokens"])

    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, source_col)]
    return (docs.select(F.col(id_col).alias("uid"), F.col(source_col).alias("source"),
                        text_bytes(text_col).alias("_t"))
            .mapInArrow(run, f"uid {kinds[0]}, source {kinds[1]}, n_tokens long"))


def _hash(seed: int, col: str):
    """A long of 60 bits from an MD5, which any SQL engine can repeat."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_totals(rows: DataFrame) -> DataFrame:
    """``(source, n_rows, tokens, share)`` of ``rows (source, n_tokens)``."""
    per = materialise(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.sum("n_tokens").alias("tokens")), "sources")
    total = per.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    return per.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))


def _measures(sources: DataFrame, exponents: list[float]) -> list[dict] | None:
    """For each trial exponent: the sum ``z`` of p**a, the entropy of the
    weights, and the largest and smallest log of p**(a-1) (how often a source
    is repeated, up to one factor). None without any token."""
    a = np.array(exponents)

    def part(frames):
        import pandas as pd
        z, h, lo, hi, t = np.zeros(len(a)), np.zeros(len(a)), np.inf, -np.inf, 0
        for f in frames:
            t += int(f["tokens"].sum())
            share = np.log(f["share"].to_numpy())
            for at in range(0, len(share), 1024):
                lp = share[at:at + 1024, None]
                e = np.exp(lp * a)
                z, h = z + e.sum(axis=0), h + (e * lp * a).sum(axis=0)
                lo, hi = min(lo, lp.min()), max(hi, lp.max())
        if t:
            yield pd.DataFrame({"i": np.arange(len(a)), "z": z, "h": h, "lo": np.full(len(a), lo),
                                "hi": np.full(len(a), hi), "t": np.full(len(a), t)})

    rows = (sources.where("tokens > 0").select("share", "tokens")
            .mapInPandas(part, "i int, z double, h double, lo double, hi double, t long")
            .groupBy("i").agg(F.sum("z").alias("z"), F.sum("h").alias("h"), F.min("lo").alias("lo"),
                              F.max("hi").alias("hi"), F.sum("t").alias("t")).collect())
    rows.sort(key=lambda r: r["i"])
    if not rows or not rows[0]["t"]:
        return None
    return [{"z": r["z"], "entropy": log(r["z"]) - r["h"] / r["z"], "most": (x - 1) * r["lo"],
             "least": (x - 1) * r["hi"], "tokens": r["t"]} for x, r in zip(exponents, rows)]


def exponent(sources: DataFrame, entropy: float | None = None, repeats: float | None = None,
             budget: int | None = None) -> float:
    """The largest exponent whose weights have at least ``entropy``, or the
    smallest that repeats no source over ``repeats`` times (1.0 if none does).

    With no ``budget`` the repeats are counted at the budget that cuts no source.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give either a target entropy or a repetition limit")

    def too_flat(m) -> bool:
        if entropy is not None:
            return m["entropy"] >= entropy
        over = -m["least"] if budget is None else log(budget / m["tokens"] / m["z"])
        return exp(min(700.0, m["most"] + over)) > repeats

    lo, hi = 0.0, 1.0                    # too flat at lo, not at hi
    ends = _measures(sources, [0.0, 1.0])
    if ends is None or too_flat(ends[1]):
        return 1.0
    if not too_flat(ends[0]):
        return 0.0
    for _ in range(PASSES):
        grid = [lo + (hi - lo) * i / TRIALS for i in range(1, TRIALS)]
        flat = [too_flat(m) for m in _measures(sources, grid)]
        k = sum(flat)                    # the measures are monotone in a
        lo, hi = ([lo, *grid][k], [*grid, hi][k])
    return hi if repeats is not None else lo


def weights(sources: DataFrame, a: float, budget: int | None = None) -> DataFrame:
    """``(source, n_rows, tokens, share, weight, budget)``, budgets in whole tokens."""
    m = _measures(sources, [a])
    z, least = (m[0]["z"], m[0]["least"]) if m else (1.0, 0.0)
    w = F.when(F.col("tokens") > 0, F.exp(F.log("share") * a) / F.lit(z)).otherwise(F.lit(0.0))
    if budget is None:
        # budget / tokens of a source is p**(a-1) / (p_max**(a-1)): at least 1
        part = F.exp(F.log("share") * (a - 1)) * F.lit(exp(-least)) * F.col("tokens")
        b = F.greatest(F.col("tokens"), F.round(part).cast("long"))
    else:
        b = F.floor(w * F.lit(float(budget)) + F.lit(1e-6))
    return (sources.withColumn("weight", w)
            .withColumn("budget", F.when(F.col("tokens") > 0, b).otherwise(F.lit(0)).cast("long")))


def realise(rows: DataFrame, plan: DataFrame, seed: int = 1) -> DataFrame:
    """``rows (uid, source, n_tokens)`` with ``weight``, ``budget`` and
    ``copies``: how often the row is used; over a source the copies' tokens
    reach its budget up to less than one row.

    The part epoch takes blocks in the order of a seeded hash while they fit
    wholly, then rows of the next block in hash order while they fit.
    """
    key = ["source_key", "block"]
    p = plan.select(F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("source_key"),
                    "weight", "budget",
                    F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens")))
                    .otherwise(F.lit(1)).alias("epochs"),
                    F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens"))
                    .otherwise(F.lit(0)).alias("rest"),
                    F.ceil(F.col("n_rows") / BLOCK_ROWS).alias("n_blocks"))
    dealt = (rows.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")))
             .join(p, "source_key")
             .withColumn("_h", _hash(seed, "uid"))
             .withColumn("block", F.pmod("_h", F.col("n_blocks"))))
    blocks = (dealt.groupBy(*key).agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest"),
                                      F.first("n_blocks").alias("n_blocks"))
              .withColumn("_o", _hash(seed + 1, "block"))
              .withColumn("_s", F.shiftright("_o", 30) % F.ceil(F.col("n_blocks") / SUPER)))
    # Two levels: sums of the groups of blocks, then of the blocks inside a group.
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(*by[-1]).rowsBetween(
        Window.unboundedPreceding, -1)
    tops = (blocks.groupBy("source_key", "_s").agg(F.sum("t").alias("_st"))
            .withColumn("_base", F.coalesce(F.sum("_st").over(before("source_key", ["_s"])), F.lit(0)))
            .drop("_st"))
    placed = (blocks.join(tops, ["source_key", "_s"])
              .withColumn("start", F.col("_base") + F.coalesce(
                  F.sum("t").over(before("source_key", "_s", ["_o", "block"])), F.lit(0)))
              # The end: blocks wholly inside the rest are in; the first that is not is cut.
              .select(*key, F.col("start").alias("_start"), F.col("t").alias("_t")))
    joined = dealt.join(placed, key)
    whole = (F.col("rest") > 0) & (F.col("_start") + F.col("_t") <= F.col("rest"))
    out = F.col("_start") >= F.col("rest")
    cut = (joined.where(~whole & ~out)
           .withColumn("_run", F.sum("n_tokens").over(
               Window.partitionBy(*key).orderBy("_h", "uid")
               .rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("_in", F.col("_start") + F.col("_run") <= F.col("rest")))
    sure = joined.where(whole | out).withColumn("_run", F.lit(0).cast("long")).withColumn("_in", whole)
    return (sure.unionByName(cut)
            .select("uid", "source", "n_tokens", "weight", "budget",
                    (F.col("epochs") + F.col("_in").cast("long")).alias("copies")))


def mix(docs: DataFrame, repeats: float | None = None, entropy: float | None = None,
        budget: int | None = None, id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """``(id, source, n_tokens, weight, budget, copies)`` of every row of ``docs
    (id, text, source, ...)``."""
    rows = materialise(count_words(docs, id_col), "mix-rows")
    sources = source_totals(rows.select("source", "n_tokens"))
    a = exponent(sources, entropy=entropy, repeats=repeats, budget=budget)
    plan = materialise(weights(sources, a, budget), "mix-plan")
    return realise(rows, plan, seed).withColumnRenamed("uid", id_col)


def apply(docs: DataFrame, repeats: float | None = None, entropy: float | None = None,
          budget: int | None = None, id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """The mixed table: rows of ``docs`` as often as decided, all columns kept.
    Rows that share an id (or have none) are used equally often."""
    used = (mix(docs, repeats, entropy, budget, id_col, seed)
            .groupBy(F.col(id_col).alias("_id")).agg(F.max("copies").cast("int").alias("_copies")))
    # Whole rows travel in one struct, so their column names meet no others.
    rows = docs.select(F.struct(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns))).alias("row"),
                       F.col(f"`{id_col}`").alias("id"))
    return (rows.join(used, rows["id"].eqNullSafe(F.col("_id"))).where("_copies > 0")
            .withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*(F.col(f"row._{i}").alias(c) for i, c in enumerate(docs.columns))))
