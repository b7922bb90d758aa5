"""Bucketed global ordering helpers against brute force."""

import numpy as np

from quarry.operators.ordered import range_buckets, running_sums, with_neighbours


def test_running_sums_and_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(1)
    keys = rng.permutation(500).astype(float)
    vals = rng.integers(0, 5, 500)
    df = spark.createDataFrame([(float(k), int(v)) for k, v in zip(keys, vals)], "k double, v long")
    df = range_buckets(df, "k", name="b")
    out = running_sums(df, "b", ["k"], ["v"], ["cum"])
    out = with_neighbours(out, "b", ["k"], ["v"])
    got = sorted((r.k, r.cum, r.prev_v, r.next_v, r.has_prev, r.has_next) for r in out.collect())
    order = np.argsort(keys)
    ks, vs = keys[order], vals[order]
    cum = np.cumsum(vs)
    for i, row in enumerate(got):
        assert row[0] == ks[i] and row[1] == cum[i]
        assert row[2] == (int(vs[i - 1]) if i > 0 else None)
        assert row[3] == (int(vs[i + 1]) if i < len(vs) - 1 else None)
        assert row[4] == (i > 0) and row[5] == (i < len(vs) - 1)
