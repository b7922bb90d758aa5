"""Approximate nearest neighbours by largest cosine: vantage-point trees.

Vectors are dealt by hash to shards of about ``shard_rows``; each builds one
tree over the unit vectors, where the Euclidean distance orders as the cosine
does. An inner node keeps a vantage point and the range of distances to it of
its near and its far half (halves by rank, so equal vectors cannot unbalance
it). A query skips a half whose nearest possible distance, by the triangle
inequality, exceeds ``factor`` times its k-th best distance. Factor 1 is exact;
a smaller one skips more.

Queries are taken in passes of at most about ``PASS_BYTES``, their size checked; a
pass is broadcast to the tasks that hold the trees, so a tree moves once a pass and
not once for each block of queries. The queries of a block go down a tree together.
Every shard returns at most k rows for each query, of which Spark keeps the k best.
Scores are computed in double precision from the original vectors.

Defined results: null, empty and zero vectors and those with a null, NaN or
infinite component take no part; only vectors of the same dimension meet; ties
go to the smaller id; a repeated row is a row of its own (only the query's own
row is no candidate); null ids are candidates after all others, not queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_passes, materialise

SHARD_ROWS = 4096
BLOCK_ROWS = 512
PASS_BYTES = 32 << 20       # of query vectors broadcast at once
LEAF = 64
NO_ID = np.iinfo(np.int64).max
# Distances of unit vectors are rounded; pruning leaves this much room.
SLACK = 1e-7


# --------------------------------------------------------------------- one tree
def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, nodes, bounds)``: rows in leaf order; for each node (from, to,
    vantage row, near child, far child), children -1 in a leaf; for each node
    the least and greatest distance to the vantage point in its two halves."""
    unit = _unit(vectors)
    order = np.arange(len(vectors))
    nodes: list[list[int]] = []
    bounds: list[list[float]] = []
    todo = [(0, len(vectors), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        me = len(nodes)
        nodes.append([lo, hi, -1, -1, -1])
        bounds.append([0.0] * 4)
        if parent >= 0:
            nodes[parent][3 + side] = me
        if hi - lo <= LEAF:
            continue
        idx = order[lo:hi]
        tries = idx[np.linspace(0, len(idx) - 1, 5).astype(int)]
        dist = [_distance(unit[idx] @ unit[v]) for v in tries]
        best = max(range(len(tries)), key=lambda i: dist[i].std())
        d = dist[best]
        rank = np.argsort(d, kind="stable")
        order[lo:hi] = idx[rank]
        d, mid = d[rank], (hi - lo) // 2
        nodes[me][2] = int(tries[best])
        bounds[me] = [d[0], d[mid - 1], d[mid], d[-1]]
        todo += [(lo + mid, hi, me, 1), (lo, lo + mid, me, 0)]
    return order, np.array(nodes, np.int32).reshape(-1, 5), np.array(bounds).reshape(-1, 4)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.clip(2 - 2 * cosine, 0, None))


class Tree:
    """Rows in leaf order with their tree; searched for whole blocks of queries."""

    def __init__(self, ids, uids, vectors, nodes, bounds, vantage):
        self.ids, self.uids = ids, uids
        self.vectors = vectors.astype(np.float64)
        self.norms = np.sqrt(np.einsum("nd,nd->n", self.vectors, self.vectors))
        self.nodes, self.bounds, self.vantage = nodes, bounds, vantage

    def search(self, vectors: np.ndarray, uids: np.ndarray, k: int, factor: float):
        """For each query the k best (scores, ids, uids, all -inf / NO_ID where
        fewer) and the number of candidates scored."""
        q = vectors.astype(np.float64)
        norms = np.sqrt(np.einsum("nd,nd->n", q, q))
        unit = _unit(vectors)
        m = len(q)
        top = np.full((m, k), -np.inf)
        ids = np.full((m, k), NO_ID)
        rows = np.full((m, k), -1, np.int64)
        seen = 0

        def leaf(lo: int, hi: int, at: np.ndarray):
            nonlocal seen
            seen += len(at) * (hi - lo)
            score = (np.einsum("qd,nd->qn", q[at], self.vectors[lo:hi])
                     / (norms[at][:, None] * self.norms[lo:hi][None, :]))
            score[uids[at][:, None] == self.uids[lo:hi][None, :]] = -np.inf
            s = np.concatenate([top[at], score], axis=1)
            i = np.concatenate([ids[at], np.broadcast_to(self.ids[lo:hi], score.shape)], axis=1)
            r = np.concatenate([rows[at], np.broadcast_to(self.uids[lo:hi], score.shape)], axis=1)
            best = np.lexsort((r, i, -s), axis=1)[:, :k]
            top[at] = np.take_along_axis(s, best, axis=1)
            ids[at] = np.take_along_axis(i, best, axis=1)
            rows[at] = np.take_along_axis(r, best, axis=1)

        def allowed(at: np.ndarray, least: np.ndarray) -> np.ndarray:
            worst = top[at, k - 1]
            reach = np.where(np.isneginf(worst), np.inf, _distance(np.where(np.isneginf(worst), 1, worst)))
            return at[least <= factor * reach + SLACK]

        def visit(node: int, at: np.ndarray):
            lo, hi, vantage, near, far = self.nodes[node]
            if not len(at):
                return
            if near < 0:
                leaf(lo, hi, at)
                return
            d = _distance(unit[at] @ self.vantage[node])
            b = self.bounds[node]
            gap = [np.maximum(0, np.maximum(b[0] - d, d - b[1])), np.maximum(0, np.maximum(b[2] - d, d - b[3]))]
            first_near = gap[0] <= gap[1]
            for child, side, mine in ((near, 0, first_near), (far, 1, ~first_near),
                                      (far, 1, first_near), (near, 0, ~first_near)):
                visit(child, allowed(at[mine], gap[side][mine]))

        if len(self.ids) and m:
            visit(0, np.arange(m))
        return top, ids, rows, seen


# ---------------------------------------------------------------------- in Spark
def usable(vector: str) -> Column:
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _unpack(blob: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(blob, "<f8").reshape(-1, dim)


def index(rows: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard and dimension with its tree, from ``rows (uid, id, vec, dim)``."""
    def make(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        vec = np.stack(list(pdf["vec"]))
        order, nodes, bounds = build(vec)
        unit = _unit(vec)
        vantage = np.where((nodes[:, 2] >= 0)[:, None], unit[nodes[:, 2]], 0.0)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]],
                             "ids": [pdf["id"].to_numpy(np.int64)[order].tobytes()],
                             "uids": [pdf["uid"].to_numpy(np.int64)[order].tobytes()],
                             "vecs": [vec[order].astype("<f8").tobytes()], "nodes": [nodes.tobytes()],
                             "bounds": [bounds.tobytes()], "vantage": [vantage.tobytes()]})

    return (rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(n_shards)).cast("int"))
            .groupBy("dim", "shard").applyInPandas(
                make, "dim int, shard int, ids binary, uids binary, vecs binary, nodes binary, "
                      "bounds binary, vantage binary"))


def neighbours(vectors: DataFrame, is_query: Column, k: int, factor: float = 1.0,
               id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id, score)``: the k nearest rows of every query row."""
    rows = materialise(
        vectors.where(usable(vector_col))
        .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"),
                F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .withColumn("uid", F.monotonically_increasing_id())
        .withColumn("dim", F.size("vec")), "vectors")
    n_shards = -(-max(1, rows.count()) // SHARD_ROWS)
    trees = materialise(index(rows.drop("is_query").fillna(int(NO_ID), ["id"]), n_shards), "trees")

    def search(queries: dict):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for r in (r for f in frames for r in f.itertuples()):
                long = lambda b: np.frombuffer(b, np.int64)
                tree = Tree(long(r.ids), long(r.uids), _unpack(r.vecs, r.dim),
                            np.frombuffer(r.nodes, np.int32).reshape(-1, 5), _unpack(r.bounds, 4),
                            _unpack(r.vantage, r.dim))
                q_ids, q_uids, q_vecs = queries.get(r.dim, ((), (), ()))
                for i in range(0, len(q_ids), BLOCK_ROWS):
                    at = slice(i, i + BLOCK_ROWS)
                    top, ids, uids, _ = tree.search(q_vecs[at], q_uids[at], k, factor)
                    q, c = np.nonzero(~np.isneginf(top))
                    yield pd.DataFrame({"query_id": q_ids[at][q], "q_uid": q_uids[at][q], "id": ids[q, c],
                                        "uid": uids[q, c], "score": top[q, c]})
        return run

    best = Window.partitionBy("q_uid").orderBy(F.col("score").desc(), "id", "uid")
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = None
    asked = rows.where(F.col("is_query") & F.col("id").isNotNull()).select("uid", "id", "dim", "vec")
    for part in bounded_passes(asked, "uid", 8 * F.col("dim"), PASS_BYTES):
        queries = {}
        for dim in {r["dim"] for r in part}:
            mine = [r for r in part if r["dim"] == dim]
            queries[dim] = (np.array([r["id"] for r in mine], np.int64), np.array([r["uid"] for r in mine], np.int64),
                            np.array([r["vec"] for r in mine], np.float64))
        found = trees.repartition(spread).mapInPandas(search(queries), "query_id long, q_uid long, id long, uid long, score double")
        got = materialise(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "neighbours")
        out = got if out is None else out.unionByName(got)
    if out is None:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    return out.select("query_id", "rank", F.when(F.col("id") != int(NO_ID), F.col("id")).alias(id_col), "score")
