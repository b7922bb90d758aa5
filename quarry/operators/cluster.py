"""k-means (Euclidean and Mahalanobis) and principal components.

Points are ``(id, features array<double>)``. Centroids are K short vectors
(K is a job parameter), never joined to the points:
* a single assignment step (the SQL-checked keys) puts them into the
  distance expression as literals: a map-only projection in codegen;
* the iterative loop labels blocks of points with NumPy (centroids in the
  closure, so no per-round code generation), skips the points whose distance
  bounds settle their label, and adds up K sums per partition. A few rows per
  round reach the driver; blocks and bounds are tables in the shared folder.

Semantics:
* ties go to the lowest centroid index (argmin): ``least(struct(d2, k))``;
* fix: a centroid that attracts no point keeps its previous position (the
  reference produces NaN);
* the reported labels are those computed with the final centroids used,
  i.e. before the last update, as the reference returns them;
* Mahalanobis distance (x-c) (P^T P)^-1 (x-c)^T equals the Euclidean
  distance after multiplying points by P^-1 (row vectors), and means commute
  with that linear map, so the Mahalanobis run is a Euclidean run in the
  whitened space; centroids are mapped back by P.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .dense import matrix, stored, total
from .sampling import md5_key


def distance2(features, centroid) -> F.Column:
    terms = [(features[i] - F.lit(float(c))) * (features[i] - F.lit(float(c)))
             for i, c in enumerate(centroid)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def nearest(features, centroids) -> F.Column:
    """Index of the nearest centroid; ties to the lowest index."""
    cands = [F.struct(distance2(features, c).alias("d2"), F.lit(k).alias("k"))
             for k, c in enumerate(centroids)]
    best = cands[0] if len(cands) == 1 else F.least(*cands)
    return best["k"]


def assign(points: DataFrame, centroids) -> DataFrame:
    """``(id, cluster)`` for every point."""
    return points.select("id", nearest(F.col("features"), centroids).alias("cluster"))


def labelled(points: DataFrame, centroids) -> DataFrame:
    """``points`` with their ``cluster``: one projection, no join."""
    return points.withColumn("cluster", nearest(F.col("features"), centroids))


def cluster_means(points: DataFrame, n_dims: int) -> DataFrame:
    """Mean of each dimension per cluster (non-empty clusters only) of points
    with a ``cluster``."""
    return points.groupBy("cluster").agg(*[F.avg(F.col("features")[i]).alias(f"m{i}")
                                           for i in range(n_dims)])


def _labels_np(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """argmin of squared distances; ties to the lowest index."""
    return _squared(x, c).argmin(axis=1)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d2 = np.zeros((x.shape[0], c.shape[0]))
    for j in range(c.shape[1]):          # per dimension: bounded memory
        diff = x[:, j:j + 1] - c[None, :, j]
        d2 += diff * diff
    return d2


# ------------------------------------------------------------- Lloyd's rounds
BLOCK_BYTES = 1 << 10       # of points in one row: an Arrow batch of 10,000 rows is 10 MB
CHUNK_BYTES = 1 << 20       # of points that one NumPy step takes
SLACK = 1e-9                # distances closer than this are compared in full


def packed(points: DataFrame, n_dims: int) -> DataFrame:
    """``(x binary)``: points in blocks, written once for all rounds."""
    step = max(1, BLOCK_BYTES // (8 * n_dims))

    def pack(batches):
        for b in batches:
            x = matrix(b, "features").astype("<f8")
            for i in range(0, len(x), 10_000 * step):
                rows = [x[j:j + step].tobytes() for j in range(i, min(len(x), i + 10_000 * step), step)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])

    doubles = points.select(F.transform("features", lambda v: v.cast("double")).alias("features"))
    return stored(doubles.mapInArrow(pack, "x binary"), "kmeans-blocks")


def _joined(batch, col: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(col).to_pylist()), kind)


def _chunks(batches):
    """Arrow batches of blocks, cut so that one holds about ``CHUNK_BYTES`` of points."""
    step = max(1, CHUNK_BYTES // BLOCK_BYTES)
    for b in batches:
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def _bounded(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Blocks with each point's label under ``centroids`` and its margin: how much
    farther the second nearest centroid is than the nearest."""
    n = centroids.shape[1]

    def bound(batches):
        for b in _chunks(batches):
            raw = b.column("x").to_pylist()
            ends = np.cumsum([len(r) // (8 * n) for r in raw])[:-1]
            d = np.sqrt(_squared(np.frombuffer(b"".join(raw)).reshape(-1, n), centroids))
            lab = d.argmin(axis=1)
            own = d[np.arange(len(d)), lab]
            d[np.arange(len(d)), lab] = np.inf
            cut = [[v.tobytes() for v in np.split(a, ends)] for a in (lab.astype("<i4"), d.min(axis=1) - own)]
            yield pa.RecordBatch.from_arrays([b.column("x"), *(pa.array(c, pa.binary()) for c in cut)],
                                             names=["x", "label", "margin"])

    path = scratch_path(blocks.sparkSession, "kmeans-bounds")
    out = blocks.select("x").mapInArrow(bound, "x binary, label binary, margin binary")
    out.write.parquet(path)
    return blocks.sparkSession.read.schema(out.schema).parquet(path)


def _update(blocks: DataFrame, centroids: np.ndarray, last: np.ndarray | None, base: np.ndarray) -> tuple[np.ndarray, int]:
    """One Lloyd update: the new centroids, and how many labels differ from those
    under ``last``. ``blocks`` hold labels and margins under ``base``: a point whose
    margin exceeds the way that its centroid and the farthest-moved other one have
    gone since then keeps its label, so only the other points are compared with all
    centroids, under both ``centroids`` and ``last``. Each partition sends K sums."""
    k, n = centroids.shape

    def reach(to):
        gone = np.sqrt(((to - base) ** 2).sum(axis=1))
        others = np.array([np.delete(gone, i).max(initial=0.0) for i in range(k)])
        return gone + others

    far = reach(centroids) if last is None else np.maximum(reach(centroids), reach(last))

    def sums(batch):
        return sum(chunk_sums(b) for b in _chunks([batch]))

    def chunk_sums(b):
        x = _joined(b, "x", "<f8").reshape(-1, n)
        lab, margin = _joined(b, "label", "<i4").astype(np.int64), _joined(b, "margin", "<f8")
        near = np.flatnonzero(margin <= far[lab] + SLACK)
        moved = len(x) if last is None else 0
        for i in range(0, len(near), 20_000):
            some = near[i:i + 20_000]
            new = _labels_np(x[some], centroids)
            if last is not None:
                moved += int((new != _labels_np(x[some], last)).sum())
            lab[some] = new
        return np.concatenate([[moved], np.bincount(lab, minlength=k),
                               *(np.bincount(lab, x[:, j], minlength=k) for j in range(n))])

    got = total(blocks, sums, 1 + k + k * n)
    count, where = got[1:1 + k], got[1 + k:].reshape(n, k).T
    return np.where(count[:, None] > 0, where / np.maximum(count, 1)[:, None], centroids), int(got[0])


def assign_np(points: DataFrame, centroids) -> DataFrame:
    """``(id, cluster)`` with the same NumPy labelling the iterations use."""
    c = np.asarray(centroids, dtype=float)

    def label(batches):
        import pandas as pd
        for pdf in batches:
            x = (np.stack(pdf["features"].to_numpy()).astype(float) if len(pdf)
                 else np.zeros((0, c.shape[1])))
            yield pd.DataFrame({"id": pdf["id"], "cluster": _labels_np(x, c).astype("int32")})
    return points.select("id", "features").mapInPandas(label, "id " + _id_type(points) + ", cluster int")


def _id_type(points: DataFrame) -> str:
    return points.schema["id"].dataType.simpleString()


def lloyd(points: DataFrame, init: list[list[float]], max_iter: int = 500,
          stop_when_stable: bool = True):
    """Lloyd iterations from ``init``. Returns (labels DataFrame, centroids
    used for those labels, iterations run).

    Points are packed into blocks once. Labels and margins are taken anew in rounds
    1, 2, 4, 8, ...; between these, centroids hardly move and most points are
    known to keep their label.

    Stable means that no label changed in a round. Comparing the centroids
    would not do: their sums depend, in the last digit, on the order in which
    partial sums arrive.
    """
    used, last, it, anew = np.asarray(init, dtype=float), None, 0, 1
    blocks = packed(points, used.shape[1])
    bounds, base = None, used
    for it in range(1, max_iter + 1):
        if it == anew:
            bounds, base, anew = _bounded(blocks, used), used, 2 * anew
        new, moved = _update(bounds, used, last, base)
        if (stop_when_stable and moved == 0) or it == max_iter:
            break
        last, used = used, new
    return assign_np(points, used), used.tolist(), it


def rounds(points: DataFrame, init: list[list[float]], n: int) -> list[list[float]]:
    """The centroids after ``n`` rounds."""
    cur = np.asarray(init, dtype=float)
    blocks = packed(points, cur.shape[1])
    for _ in range(n):
        cur, _ = _update(_bounded(blocks, cur), cur, None, cur)
    return cur.tolist()


def kmeans_euclidean(points: DataFrame, init: list[list[float]], max_iter: int = 500):
    """Lloyd until the centroids stop moving (at most ``max_iter`` rounds)."""
    return lloyd(points, init, max_iter, stop_when_stable=True)


def whiten_matrix(p: np.ndarray) -> np.ndarray:
    """P^-1, so that ||(x - c) P^-1||^2 = (x-c)(P^T P)^-1(x-c)^T."""
    return np.linalg.inv(np.asarray(p, dtype=float))


def transform(points: DataFrame, m: np.ndarray) -> DataFrame:
    """Row vectors times matrix ``m``."""
    n = m.shape[0]
    cols = []
    for j in range(m.shape[1]):
        e = None
        for i in range(n):
            t = F.col("features")[i] * F.lit(float(m[i, j]))
            e = t if e is None else e + t
        cols.append(e)
    return points.select("id", F.array(*cols).alias("features"))


def kmeans_mahalanobis(points: DataFrame, init: list[list[float]], p: np.ndarray,
                       iterations: int = 100):
    """Exactly ``iterations`` Lloyd rounds under the Mahalanobis distance
    with matrix ``P`` (any dimension). Returns (labels, centroids used)."""
    if len(init) == 0:
        raise ValueError("initial centroids are required")
    w = whiten_matrix(p)
    white = transform(points, w)
    init_w = (np.asarray(init, dtype=float) @ w).tolist()
    labels, used_w, _ = lloyd(white, init_w, iterations, stop_when_stable=False)
    used = (np.asarray(used_w) @ np.asarray(p, dtype=float)).tolist()
    return labels, used


def random_centroids(points: DataFrame, k: int, seed=0) -> DataFrame:
    """K distinct points as start centroids: the first K in MD5 order
    (without replacement, so no two start equal). A top-K report."""
    return (points.withColumn("_h", md5_key(seed, "id")).orderBy("_h").limit(k)
            .select("id", "features"))


# ---------------------------------------------------------------- PCA
def _covariance_2d(df: DataFrame, group: list[str]):
    x, y = F.col("features")[0], F.col("features")[1]
    return df.groupBy(*group).agg(F.var_samp(x).alias("sxx"), F.var_samp(y).alias("syy"),
                                  F.covar_samp(x, y).alias("sxy"))


def _first_component_2d(sxx, syy, sxy):
    """Unit eigenvector of the largest eigenvalue of [[sxx, sxy], [sxy, syy]],
    sign fixed so its largest-magnitude entry is positive (ties: first)."""
    half = (sxx - syy) / 2
    lam = (sxx + syy) / 2 + F.sqrt(half * half + sxy * sxy)
    vx = F.when(sxy != 0, lam - syy).when(sxx >= syy, F.lit(1.0)).otherwise(F.lit(0.0))
    vy = F.when(sxy != 0, sxy).when(sxx >= syy, F.lit(0.0)).otherwise(F.lit(1.0))
    norm = F.sqrt(vx * vx + vy * vy)
    ux, uy = vx / norm, vy / norm
    flip = F.when(F.abs(ux) >= F.abs(uy), F.signum(ux)).otherwise(F.signum(uy))
    return ux * flip, uy * flip


def pca_first_component_2d(points: DataFrame) -> DataFrame:
    c = _covariance_2d(points, [])
    ux, uy = _first_component_2d(F.col("sxx"), F.col("syy"), F.col("sxy"))
    return c.select(ux.alias("c0"), uy.alias("c1"))


def pca_per_cluster_2d(points: DataFrame) -> DataFrame:
    """First component of the points of each ``cluster``."""
    c = _covariance_2d(points, ["cluster"])
    ux, uy = _first_component_2d(F.col("sxx"), F.col("syy"), F.col("sxy"))
    return c.select("cluster", ux.alias("c0"), uy.alias("c1"))


def pca_per_cluster(points: DataFrame, n_dims: int) -> DataFrame:
    """First component of each ``cluster`` in n dimensions, any n.

    One aggregate gives each cluster's sums and products (n (n + 3) / 2
    numbers a cluster, combined map-side); the eigenvectors of those small
    matrices are taken with NumPy, one row per cluster. A cluster with one
    point has a zero covariance and no component (null).
    """
    f = F.col("features")
    pairs = [(i, j) for i in range(n_dims) for j in range(i, n_dims)]
    cov = points.groupBy("cluster").agg(F.array(*[F.covar_samp(f[i], f[j]) for i, j in pairs]).alias("cov"))

    def first(frames):
        import pandas as pd
        for pdf in frames:
            out = []
            for c in pdf["cov"]:
                m = np.zeros((n_dims, n_dims))
                if any(v is None or np.isnan(v) for v in c):
                    out.append(None)
                    continue
                for (i, j), v in zip(pairs, c):
                    m[i, j] = m[j, i] = v
                v = np.linalg.eigh(m)[1][:, -1]
                i = int(np.argmax(np.abs(v)))
                out.append((v if v[i] >= 0 else -v).tolist())
            yield pd.DataFrame({"cluster": pdf["cluster"], "component": out})

    kind = points.schema["cluster"].dataType.simpleString()
    return cov.mapInPandas(first, f"cluster {kind}, component array<double>")


def pca_first_component(points: DataFrame) -> list[float]:
    """First principal component of n-D points with MLlib's distributed
    covariance (n x n on the driver), same sign convention as the 2-D form."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    v = points.select(array_to_vector("features").alias("v"))
    model = PCA(k=1, inputCol="v", outputCol="p").fit(v)
    comp = model.pc.toArray()[:, 0]
    i = int(np.argmax(np.abs(comp)))
    return (comp * (1 if comp[i] >= 0 else -1)).tolist()
