"""ROC curve, partial AUC and the precision sweep over ``(score, label)``.

Rows are first grouped by distinct score (a partial aggregate, so ties and hot
scores collapse map-side) and that table is range-partitioned by descending
score and checkpointed once, so the input is scanned a single time whatever
reads the table afterwards. The running true/false positive counts then come
from the bucketed running sums in ``ordered``: each range is one window task
and the offsets between ranges come from a one-row-per-range table.

Semantics kept from the reference:
* points are taken at distinct scores, cumulated over all rows;
* an interior point whose false- and true-positive second differences are
  both 0 is dropped (this changes the rectangle-sum area: kept);
* the curve starts at (0, 0) with threshold +inf;
* the partial area is the right-rectangle sum (fpr[i] - fpr[i-1]) * tpr[i]
  over points with lo <= fpr <= hi; the first point in range still subtracts
  its out-of-range predecessor;
* the sweep predicts ``score > t`` (strict); precision is 0 when nothing is
  predicted.
Fixed: a single distinct score keeps its one point; no positives or no
negatives give NULL rates instead of a division error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import range_buckets, running_sums, with_neighbours

# The false-positive-rate ranges that are reported.
RANGES = [(0.0, 1.0), (0.0, 0.4), (0.0, 0.75), (0.25, 0.75)]


def score_groups(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))


def grouped(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """The distinct-score table in ranges of descending score: the offsets,
    neighbours and totals all read it, so the input is scanned once."""
    g = score_groups(scored, score, label).withColumn("_k", -F.col("score"))
    return range_buckets(g, "_k")


def _curve_rows(g: DataFrame) -> DataFrame:
    """Distinct scores with running counts and the keep flag.

    Columns: score, pos, neg, tps, fps, keep, _b, _k (order key = -score).
    """
    g = running_sums(g, "_b", ["_k"], ["pos", "neg"], ["tps", "fps"])
    g = with_neighbours(g, "_b", ["_k"], ["pos", "neg"], prev=True, nxt=True)
    keep = (~F.col("has_prev") | ~F.col("has_next")
            | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")))
    return g.withColumn("keep", keep)


def _totals(g: DataFrame):
    """Positives and negatives as scalar subqueries over the score table."""
    return g.agg(F.sum("pos")).scalar(), g.agg(F.sum("neg")).scalar()


def roc_points(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``(threshold, tps, fps, fpr, tpr, _b, _k)`` for the kept points plus
    the (0, 0, +inf) start."""
    g = grouped(scored, score, label)
    rows = _curve_rows(g).where("keep")
    start = rows.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tps"),
        F.lit(0).cast("long").alias("fps"), F.lit(-1).alias("_b"),
        F.lit(float("-inf")).alias("_k"))
    pts = rows.select(F.col("score").alias("threshold"), "tps", "fps", "_b", "_k") \
        .unionByName(start)
    p, n = _totals(g)
    return pts.withColumn("fpr", F.try_divide(F.col("fps").cast("double"), n)) \
              .withColumn("tpr", F.try_divide(F.col("tps").cast("double"), p))


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return roc_points(scored, score, label).select("threshold", "fpr", "tpr")


def partial_auc(scored: DataFrame, ranges=RANGES, score: str = "score", label: str = "label") -> DataFrame:
    """``(lo, hi, auc)`` per FPR range, all ranges in one aggregate."""
    pts = roc_points(scored, score, label)
    pts = with_neighbours(pts, "_b", ["_k"], ["fpr"], prev=True, nxt=False)
    step = (F.col("fpr") - F.coalesce(F.col("prev_fpr"), F.col("fpr"))) * F.col("tpr")
    sums = [F.coalesce(F.sum(F.when((F.col("fpr") >= lo) & (F.col("fpr") <= hi), step)),
                       F.lit(0.0)).alias(f"a{i}") for i, (lo, hi) in enumerate(ranges)]
    agg = pts.agg(*sums)
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"),
                 F.col(f"a{i}").alias("auc")) for i, (lo, hi) in enumerate(ranges)]))
    return agg.select(rows.alias("r")).select("r.lo", "r.hi", "r.auc")


def precision_sweep(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision and accuracy of ``score > t`` at every ROC threshold.

    The counts above a threshold are the running counts one distinct score
    higher (tps - pos), so no threshold rescans the data.
    """
    g = grouped(scored, score, label)
    rows = _curve_rows(g).where("keep")
    p, n = _totals(g)
    tp = F.col("tps") - F.col("pos")
    fp = F.col("fps") - F.col("neg")
    kept = rows.select(F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"))
    start = rows.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("fp"))
    allp = kept.unionByName(start)
    pred = F.col("tp") + F.col("fp")
    prec = F.when(pred == 0, F.lit(0.0)).otherwise(F.col("tp") / pred)
    acc = F.try_divide((F.col("tp") + (F.lit(n) - F.col("fp"))).cast("double"), F.lit(p) + F.lit(n))
    return allp.select("threshold", prec.alias("precision"), acc.alias("accuracy"))


def threshold_at_precision(sweep: DataFrame, lo: float = 0.9, hi: float = 0.91) -> DataFrame:
    """First (highest) threshold whose precision is in [lo, hi); maybe none."""
    return (sweep.where((F.col("precision") >= lo) & (F.col("precision") < hi))
            .orderBy(F.desc("threshold")).limit(1))
