"""CLUSTER keys: 2-D line points (quantity, discount in percent) and the
64-dimensional embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import cluster as cl
from . import bindings as b
from .catalog import register

# The reference's five start centroids and its matrix P.
INIT_2D = [[10.0, 10.0], [-10.0, -10.0], [2.0, 2.0], [3.0, 3.0], [-3.0, -3.0]]
P_MATRIX = [[10.0, 0.5], [-10.0, 0.25]]
K_RANDOM = 5

PT = "WITH " + b.POINTS_SQL


def _dist_sql(cs):
    return ", ".join(f"(x - {c[0]!r}) * (x - {c[0]!r}) + (y - {c[1]!r}) * (y - {c[1]!r}) AS d{k}"
                     for k, c in enumerate(cs))


def _argmin_sql(k):
    parts = []
    for i in range(k - 1):
        rest = ", ".join(f"d{j}" for j in range(i + 1, k))
        parts.append(f"WHEN d{i} <= least({rest}) THEN {i}" if k - i > 2 else f"WHEN d{i} <= d{k - 1} THEN {i}")
    return "CASE " + " ".join(parts) + f" ELSE {k - 1} END"


ASSIGN_SQL = PT + f""",
dd AS (SELECT id, x, y, {_dist_sql(INIT_2D)} FROM pt),
lab AS (SELECT id, x, y, {_argmin_sql(len(INIT_2D))} AS cluster FROM dd)"""


def _points(spark, d):
    return b.points_2d(spark, d)


@register("assign_cluster", ASSIGN_SQL + " SELECT id, cluster FROM lab")
def q_assign_cluster(spark, d):
    return cl.assign(_points(spark, d), INIT_2D)


@register("cluster_means", ASSIGN_SQL + """
SELECT cluster, round(avg(x), 6) AS m0, round(avg(y), 6) AS m1 FROM lab GROUP BY cluster""")
def q_cluster_means(spark, d):
    p = _points(spark, d)
    m = cl.cluster_means(cl.labelled(p, INIT_2D), 2)
    return m.select("cluster", F.round("m0", 6).alias("m0"), F.round("m1", 6).alias("m1"))


_W = np.linalg.inv(np.asarray(P_MATRIX)).tolist()
_INIT_W = (np.asarray(INIT_2D) @ np.asarray(_W)).tolist()


@register("assign_cluster_mahalanobis", PT + f""",
wp AS (SELECT id, x * {_W[0][0]!r} + y * {_W[1][0]!r} AS wx, x * {_W[0][1]!r} + y * {_W[1][1]!r} AS wy FROM pt),
dd AS (SELECT id, {_dist_sql(_INIT_W).replace('(x -', '(wx -').replace('(y -', '(wy -')} FROM wp)
SELECT id, {_argmin_sql(len(INIT_2D))} AS cluster FROM dd""")
def q_assign_cluster_mahalanobis(spark, d):
    """One Mahalanobis assignment step with the reference's P."""
    white = cl.transform(_points(spark, d), np.asarray(_W))
    return cl.assign(white, _INIT_W)


@register("random_centroids", PT + f"""
SELECT id, x AS f0, y AS f1 FROM pt ORDER BY md5('0|' || id) LIMIT {K_RANDOM}""")
def q_random_centroids(spark, d):
    r = cl.random_centroids(_points(spark, d), K_RANDOM, seed=0)
    return r.select("id", F.col("features")[0].alias("f0"), F.col("features")[1].alias("f1"))


def _pc_sql(src, group):
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"""cv AS (SELECT {g}var_samp(x) AS sxx, var_samp(y) AS syy, covar_samp(x, y) AS sxy FROM {src}{gb}),
ev AS (SELECT *, (sxx + syy) / 2 + sqrt(((sxx - syy) / 2) * ((sxx - syy) / 2) + sxy * sxy) AS lam FROM cv),
vv AS (SELECT *, CASE WHEN sxy <> 0 THEN lam - syy WHEN sxx >= syy THEN 1.0 ELSE 0.0 END AS vx,
                 CASE WHEN sxy <> 0 THEN sxy WHEN sxx >= syy THEN 0.0 ELSE 1.0 END AS vy FROM ev),
uu AS (SELECT *, vx / sqrt(vx * vx + vy * vy) AS ux, vy / sqrt(vx * vx + vy * vy) AS uy FROM vv),
ff AS (SELECT *, CASE WHEN abs(ux) >= abs(uy) THEN sign(ux) ELSE sign(uy) END AS fl FROM uu)"""


@register("pca_first_component", PT + ",\n" + _pc_sql("pt", None) + """
SELECT round(ux * fl, 6) AS c0, round(uy * fl, 6) AS c1 FROM ff""")
def q_pca_first_component(spark, d):
    r = cl.pca_first_component_2d(_points(spark, d))
    return r.select(F.round("c0", 6).alias("c0"), F.round("c1", 6).alias("c1"))


@register("pca_per_cluster", ASSIGN_SQL + ",\n" + _pc_sql("lab", "cluster") + """
SELECT cluster, round(ux * fl, 6) AS c0, round(uy * fl, 6) AS c1 FROM ff""")
def q_pca_per_cluster(spark, d):
    p = _points(spark, d)
    r = cl.pca_per_cluster_2d(cl.labelled(p, INIT_2D))
    return r.select("cluster", F.round("c0", 6).alias("c0"), F.round("c1", 6).alias("c1"))


def _embedding_init(spark, d):
    """Start centroid per label: the vector with the lowest id (10 rows)."""
    e = b.embedding_points(spark, d)
    rows = (e.groupBy("label").agg(F.min_by("features", "id").alias("f"))
            .orderBy("label").collect())
    return e.select("id", "features"), [list(r["f"]) for r in rows]


STEPS = 3


def _steps_sql(points_sql, init, back="x AS f0, y AS f1"):
    """Lloyd rounds as CTEs: k0 holds the start, k<i> the means of round i."""
    k = len(init)
    sql = points_sql + ",\nk0(k, cx, cy) AS (VALUES " + ", ".join(
        f"({i}, {c[0]!r}::DOUBLE, {c[1]!r}::DOUBLE)" for i, c in enumerate(init)) + ")"
    for s in range(1, STEPS + 1):
        sql += f""",
l{s} AS (SELECT id, x, y, k FROM (SELECT pt.*, k.k, row_number() OVER (PARTITION BY id ORDER BY
           (x - cx) * (x - cx) + (y - cy) * (y - cy), k.k) AS r FROM pt, k{s - 1} k) WHERE r = 1),
k{s} AS (SELECT o.k, coalesce(m.cx, o.cx) AS cx, coalesce(m.cy, o.cy) AS cy FROM k{s - 1} o LEFT JOIN
          (SELECT k, avg(x) AS cx, avg(y) AS cy FROM l{s} GROUP BY k) m ON o.k = m.k)"""
    return sql + f" SELECT k::INTEGER AS cluster, round(cx, 6) AS c0, round(cy, 6) AS c1 FROM k{STEPS}"


@register("kmeans_steps", _steps_sql(PT, INIT_2D))
def q_kmeans_steps(spark, d):
    """The centroids after three Lloyd rounds on the 2-D line points: the
    loop's rounds, one by one, against SQL."""
    cur = cl.rounds(_points(spark, d), INIT_2D, STEPS)
    return spark.createDataFrame([(i, round(c[0], 6), round(c[1], 6)) for i, c in enumerate(cur)],
                                 "cluster int, c0 double, c1 double")


def _lloyd_sql(points, start, most, stable):
    """A whole run as a recursive query over ``points (id, f DOUBLE[])`` from ``start
    (k, c DOUBLE[])``: round i holds the centroids and how far they came; labels are
    those under the centroids of the last round but one, or of the stable one."""
    goes = "(SELECT max(gone) FROM it) > 1e-9 AND" if stable else ""
    return f"""
it AS (SELECT 0 AS i, k, c, 1e9::DOUBLE AS gone FROM {start}
  UNION ALL
  SELECT o.i + 1, o.k, coalesce(n.c, o.c), coalesce(list_distance(n.c, o.c), 0) FROM it o LEFT JOIN (
    SELECT k, list(m ORDER BY j) AS c FROM (
      SELECT k, j, avg(v) AS m FROM (
        SELECT k, unnest(f) AS v, generate_subscripts(f, 1) AS j FROM (
          SELECT any_value(f) AS f, arg_min(k, (list_distance(f, c), k)) AS k FROM {points}, it GROUP BY id))
      GROUP BY k, j) GROUP BY k) n ON n.k = o.k
  WHERE {goes} o.i < {most - 1}),
fin AS (SELECT k, c FROM it WHERE i = (SELECT max(i) FROM it))
SELECT id, arg_min(k, (list_distance(f, c), k))::INTEGER AS cluster FROM {points}, fin GROUP BY id"""


@register("kmeans_euclidean", """
WITH RECURSIVE pt AS (SELECT vec_id AS id, embedding::DOUBLE[] AS f, label FROM embeddings),
k0 AS (SELECT row_number() OVER (ORDER BY label) - 1 AS k, c FROM (SELECT label, arg_min(f, id) AS c FROM pt GROUP BY label)),
""" + _lloyd_sql("pt", "k0", 500, True))
def q_kmeans_euclidean(spark, d):
    """Lloyd to convergence (at most 500 rounds) on the embeddings."""
    pts, init = _embedding_init(spark, d)
    labels, _, _ = cl.kmeans_euclidean(pts, init, 500)
    return labels


@register("kmeans_mahalanobis", "WITH RECURSIVE " + b.POINTS_SQL + f""",
wp AS (SELECT id, [x * {_W[0][0]!r} + y * {_W[1][0]!r}, x * {_W[0][1]!r} + y * {_W[1][1]!r}] AS f FROM pt),
k0 AS (SELECT * FROM (VALUES {", ".join(f"({i}, [{c[0]!r}, {c[1]!r}]::DOUBLE[])" for i, c in enumerate(_INIT_W))}) v(k, c)),
""" + _lloyd_sql("wp", "k0", 100, False))
def q_kmeans_mahalanobis(spark, d):
    """Exactly 100 Mahalanobis rounds on the 2-D line points."""
    labels, _ = cl.kmeans_mahalanobis(_points(spark, d), INIT_2D, np.asarray(P_MATRIX), 100)
    return labels
