import numpy as np
from pyspark.sql import functions as F

from quarry.llm import vptree


def brute(ids, vecs, k, queries):
    v = np.asarray(vecs, np.float64)
    n = np.sqrt((v * v).sum(axis=1))
    out = {}
    for q in queries:
        s = (v * v[q]).sum(axis=1) / (n * n[q])
        s[q] = -9
        order = np.lexsort((ids, -np.round(s, 12)))[:min(k, len(ids) - 1)]
        out[ids[q]] = [(int(ids[i]), s[i]) for i in order]
    return out


def table(spark, ids, vecs, more=()):
    rows = [(int(i), [float(x) for x in v], 0) for i, v in zip(ids, vecs)] + list(more)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, uid int")


def test_factor_one_is_exact_with_ties_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 300)
    rng = np.random.default_rng(0)
    vecs = rng.normal(size=(700, 8)).astype(np.float32)
    vecs[100:400] = vecs[50]                     # a large group of copies
    ids = rng.permutation(700)
    bad = [(9000, None, 0), (9050, [0.0] * 8, 0), (9100, [float("nan")] + [1.0] * 7, 0),
           (9150, [float("inf")] + [1.0] * 7, 0), (9200, [None] + [1.0] * 7, 0), (9250, [], 0),
           (9300, [1.0, 2.0], 0), (None, [1e-3] * 8, 0)]
    d = table(spark, ids, vecs, bad)
    got = {}
    for r in vptree.neighbours(d, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    all_ids = np.append(ids, vptree.NO_ID)
    want = brute(all_ids, np.concatenate([vecs, [[1e-3] * 8]]), 5, np.flatnonzero(ids % 50 == 0))
    assert set(got) == set(want)
    for q, rows in want.items():
        assert [i for i, _ in got[q]] == [None if i == vptree.NO_ID else i for i, _ in rows]
        assert np.allclose([s for _, s in got[q]], [s for _, s in rows], atol=1e-12)


def test_relaxed_factor_scores_less_and_keeps_recall():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    v = (centres[rng.integers(0, 40, 4000)] + 0.35 * rng.normal(size=(4000, 16))).astype(np.float64)
    order, nodes, bounds = vptree.build(v)
    unit = vptree._unit(v)
    vantage = np.where((nodes[:, 2] >= 0)[:, None], unit[nodes[:, 2]], 0.0)
    ids = np.arange(4000)
    tree = vptree.Tree(ids[order], ids[order], v[order], nodes, bounds, vantage)
    q = np.arange(0, 4000, 50)
    want = brute(ids, v, 5, q)
    seen = {}
    for factor in (1.0, 0.6):
        _, found, _, seen[factor] = tree.search(v[q], q, 5, factor)
        hits = sum(len({i for i, _ in want[int(a)]} & set(f.tolist())) for a, f in zip(q, found))
        assert hits >= (1.0 if factor == 1 else 0.9) * 5 * len(q)
    assert seen[0.6] < seen[1.0] < 0.8 * 4000 * len(q)


def test_few_rows_repeats_and_empty(spark):
    d = table(spark, [0, 50, 0], [[1, 0], [1, 1], [1, 0]])
    rows = vptree.neighbours(d, F.col("vec_id") % 50 == 0, 5).collect()
    assert len(rows) == 6 and {r["rank"] for r in rows} == {1, 2}
    assert vptree.neighbours(d.where("vec_id < 0"), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert vptree.neighbours(d, F.col("vec_id") == 7, 5).count() == 0
