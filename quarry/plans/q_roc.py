"""EVAL-ROC keys on two score/label bindings: many ties (line discount vs
returned) and few ties (order price vs filled)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import roc
from . import bindings as b
from .catalog import register


def _curve_sql(src_sql: str) -> str:
    return "WITH " + src_sql + """,
g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM sl GROUP BY score),
c AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps,
             lead(pos) OVER (ORDER BY score DESC) AS npos, lead(neg) OVER (ORDER BY score DESC) AS nneg,
             lag(pos) OVER (ORDER BY score DESC) AS ppos FROM g),
kc AS (SELECT * FROM c WHERE ppos IS NULL OR npos IS NULL OR npos <> pos OR nneg <> neg),
k AS (SELECT score AS threshold, tps, fps FROM kc UNION ALL SELECT 'inf'::DOUBLE, 0, 0),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
kp AS (SELECT threshold, CAST(fps AS DOUBLE) / N AS fpr, CAST(tps AS DOUBLE) / P AS tpr FROM k, t)"""


def _roc_sql(src):
    return _curve_sql(src) + " SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM kp"


def _auc_sql(src):
    return _curve_sql(src) + """,
kq AS (SELECT fpr, tpr, lag(fpr) OVER (ORDER BY threshold DESC) AS pf FROM kp),
rg AS (SELECT * FROM (VALUES (0.0, 1.0), (0.0, 0.4), (0.0, 0.75), (0.25, 0.75)) v(lo, hi))
SELECT CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi,
  round(coalesce(sum(CASE WHEN fpr >= lo AND fpr <= hi
                     THEN (fpr - coalesce(pf, fpr)) * tpr END), 0), 6) AS auc
FROM kq, rg GROUP BY lo, hi"""


def _sweep_body(src):
    return _curve_sql(src) + """,
sw AS (SELECT score AS threshold, tps - pos AS tp, fps - neg AS fp FROM kc
       UNION ALL SELECT 'inf'::DOUBLE, 0, 0),
sp AS (SELECT threshold,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CAST(tp + (N - fp) AS DOUBLE) / (P + N) AS accuracy FROM sw, t)"""


def _sweep_sql(src):
    return _sweep_body(src) + """
SELECT threshold, round(precision, 6) AS precision, round(accuracy, 6) AS accuracy FROM sp"""


def _pick_sql(src, lo, hi):
    return _sweep_body(src) + """
SELECT threshold, round(precision, 6) AS precision, round(accuracy, 6) AS accuracy FROM sp
WHERE precision >= {lo} AND precision < {hi} ORDER BY threshold DESC LIMIT 1""".format(lo=lo, hi=hi)


def _r6(df, *cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# The last two: a range of precision that the binding's sweep reaches.
BINDINGS = {"": (b.scored_lines, b.SCORED_LINES_SQL, 0.3, 0.35),
            "_orders": (b.scored_orders, b.SCORED_ORDERS_SQL, 0.3, 0.5)}

for suffix, (load, src, lo, hi) in BINDINGS.items():
    def _make(load=load, lo=lo, hi=hi):
        def q_roc(spark, d):
            return _r6(roc.roc_curve(load(spark, d)), "fpr", "tpr")

        def q_auc(spark, d):
            return _r6(roc.partial_auc(load(spark, d)), "auc")

        def q_sweep(spark, d):
            return _r6(roc.precision_sweep(load(spark, d)), "precision", "accuracy")

        def q_pick(spark, d):
            return _r6(roc.threshold_at_precision(roc.precision_sweep(load(spark, d)), lo, hi),
                       "precision", "accuracy")
        return q_roc, q_auc, q_sweep, q_pick

    f_roc, f_auc, f_sweep, f_pick = _make()
    register("roc_curve" + suffix, _roc_sql(src))(f_roc)
    register("partial_auc" + suffix, _auc_sql(src))(f_auc)
    register("precision_sweep" + suffix, _sweep_sql(src))(f_sweep)
    register("threshold_at_precision" + suffix, _pick_sql(src, lo, hi))(f_pick)


@register("scored_labels", "WITH " + b.SCORED_LINES_SQL + " SELECT row_id, score, label FROM sl")
def q_scored_labels(spark, d):
    return b.scored_lines(spark, d)
