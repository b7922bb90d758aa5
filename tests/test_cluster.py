"""CLUSTER: hand cases, Mahalanobis, empty clusters, NumPy brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import cluster as cl
from conftest import SF001, rows


def pts(spark, xs):
    return spark.createDataFrame([(i, [float(a) for a in x]) for i, x in enumerate(xs)],
                                 "id long, features array<double>")


def test_two_clusters_stable(spark):
    p = pts(spark, [(0, 0), (0, 2), (10, 0), (10, 2)])
    labels, used, it = cl.kmeans_euclidean(p, [[0, 0], [10, 0]])
    assert used == [[0.0, 1.0], [10.0, 1.0]] and it == 2
    assert [c for _, c in rows(labels)] == [0, 0, 1, 1]


def test_mahalanobis_changes_winner(spark):
    p = pts(spark, [(3, 0)])
    assert rows(cl.assign(p, [[0, 0], [3, 2]])) == [(0, 1)]
    P = np.diag([2.0, 1.0])
    w = cl.whiten_matrix(P)
    white = cl.transform(p, w)
    init_w = (np.asarray([[0, 0], [3, 2]], float) @ w).tolist()
    assert rows(cl.assign(white, init_w)) == [(0, 0)]


def test_ties_and_empty_cluster(spark):
    p = pts(spark, [(1, 0), (5, 5)])
    assert rows(cl.assign(p, [[0, 0], [2, 0], [100, 100]]))[0] == (0, 0)  # tie -> lower index
    _, used, _ = cl.lloyd(p, [[0, 0], [2, 0], [100, 100]], 1, stop_when_stable=False)
    assert used == [[0.0, 0.0], [2.0, 0.0], [100.0, 100.0]]
    now, before = (np.array(c, float) for c in ([[0, 0], [2, 0], [100, 100]], [[9, 9], [2, 0], [1, 0]]))
    for base in (now, before, now + 3):
        cur, moved = cl._update(cl._bounded(cl.packed(p, 2), base), now, before, base)
        assert moved == 2
        assert cur[2].tolist() == [100.0, 100.0]  # no point: centroid stays


def test_bounds_settle_most_points_and_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 1.0, (400, 3)) for c in ([0, 0, 0], [7, 0, 0], [0, 7, 0])])
    base = np.array([[0.1, 0, 0], [6.8, 0, 0.1], [0, 7.1, 0]])
    blocks = cl._bounded(cl.packed(pts(spark, x.tolist()), 3), base)
    moved = base + 0.05
    want, _ = _numpy_round(x, moved)
    got, changed = cl._update(blocks, moved, base, base)
    assert np.allclose(got, want)
    assert changed == (((x[:, None] - moved) ** 2).sum(2).argmin(1) != ((x[:, None] - base) ** 2).sum(2).argmin(1)).sum()
    margin = np.concatenate([np.frombuffer(r.margin) for r in blocks.collect()])
    assert (margin > 2 * np.sqrt(3) * 0.05 + cl.SLACK).mean() > 0.9


def _numpy_round(x, c):
    lab = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
    return np.array([x[lab == k].mean(0) if (lab == k).any() else c[k] for k in range(len(c))]), lab


def _numpy_lloyd(x, c, max_iter):
    c = c.copy()
    for _ in range(max_iter):
        d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        lab = d.argmin(1)
        new = c.copy()
        for k in range(len(c)):
            if (lab == k).any():
                new[k] = x[lab == k].mean(0)
        if np.array_equal(new, c):
            break
        c = new
    return lab, c


def test_embeddings_match_numpy(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda v: v.cast("double")).alias("features"), "label")
    data = sorted((r.id, list(r.features), r.label) for r in e.collect())
    x = np.array([d[1] for d in data])
    init = {}
    for i, f, lab in data:
        init.setdefault(lab, f)
    c0 = np.array([init[k] for k in sorted(init)])
    lab_np, c_np = _numpy_lloyd(x, c0, 500)
    labels, used, _ = cl.kmeans_euclidean(e.select("id", "features"), c0.tolist(), 500)
    got = dict(rows(labels))
    assert [got[d[0]] for d in data] == lab_np.tolist()
    assert np.allclose(np.array(used), c_np)


def test_pca_2d_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2)) @ np.array([[3.0, 1.0], [0.0, 0.5]])
    p = pts(spark, x.tolist())
    r = cl.pca_first_component_2d(p).first()
    w, v = np.linalg.eigh(np.cov(x.T))
    top = v[:, -1] * np.sign(v[np.argmax(np.abs(v[:, -1])), -1])
    assert (r.c0, r.c1) == (pytest.approx(top[0]), pytest.approx(top[1]))
    assert np.allclose(cl.pca_first_component(p), top, atol=1e-6)


def test_labels_are_from_before_last_update(spark):
    # one round: labels come from the start centroids, not the updated ones
    p = pts(spark, [(0, 0), (4, 0), (10, 0)])
    labels, used, _ = cl.lloyd(p, [[0, 0], [10, 0]], 1, stop_when_stable=False)
    assert used == [[0.0, 0.0], [10.0, 0.0]]
    assert [c for _, c in rows(labels)] == [0, 0, 1]


def test_mahalanobis_any_dimension(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 3))
    P = np.array([[2.0, 0.3, 0.0], [0.1, 1.0, 0.2], [0.0, -0.4, 3.0]])
    init = x[:3].tolist()
    labels, used = cl.kmeans_mahalanobis(pts(spark, x.tolist()), init, P, iterations=1)
    a = np.linalg.inv(P.T @ P)
    d = np.array([[(xi - c) @ a @ (xi - c) for c in np.asarray(init)] for xi in x])
    assert [c for _, c in rows(labels)] == d.argmin(1).tolist()
    assert np.allclose(used, init)


def test_pca_per_cluster_any_dimension(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4)) * [1, 5, 2, 1] @ np.linalg.qr(rng.normal(size=(4, 4)))[0]
    lab = np.arange(60) % 2
    lab[0] = 9                                   # a cluster with one point
    p = spark.createDataFrame([(i, [float(v) for v in x[i]], int(lab[i])) for i in range(60)],
                              "id long, features array<double>, cluster int")
    got = {r.cluster: r.component for r in cl.pca_per_cluster(p, 4).collect()}
    assert got[9] is None
    for c in (0, 1):
        v = np.linalg.eigh(np.cov(x[lab == c].T))[1][:, -1]
        v = v if v[np.abs(v).argmax()] >= 0 else -v
        assert np.allclose(got[c], v)
    two = p.select("id", F.slice("features", 1, 2).alias("features"), "cluster").where("cluster < 2")
    flat = {r.cluster: (r.c0, r.c1) for r in cl.pca_per_cluster_2d(two).collect()}
    for r in cl.pca_per_cluster(two, 2).collect():
        assert np.allclose(r.component, flat[r.cluster])


def test_numpy_steps_hold_few_points(spark, monkeypatch):
    """A batch of blocks is labelled in steps of bounded size, whatever the batch holds."""
    x = np.random.default_rng(3).normal(size=(20_000, 2))
    most, plain = [], cl._squared(x, x[:2]).argmin(axis=1)
    batch = pa.RecordBatch.from_arrays([pa.array([x[i:i + 64].tobytes() for i in range(0, len(x), 64)] * 40, pa.binary())], names=["x"])
    most = max(sum(len(v) for v in b.column("x").to_pylist()) for b in cl._chunks([batch]))
    assert most <= cl.CHUNK_BYTES
    got = cl.lloyd(spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id long, features array<double>"),
                   x[:2].tolist(), 1, stop_when_stable=False)[0]
    assert [r.cluster for r in got.orderBy("id").collect()] == plain.tolist()
