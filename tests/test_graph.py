"""GRAPH: golden mini-graph of the reference, hub split, partition invariance."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph as g
from quarry.operators import hubs
from conftest import rows

# Adjacency of the reference's worked example.
ADJ = {0: [1, 2, 3, 4], 1: [0, 3, 2], 2: [0, 1, 4], 3: [0, 1], 4: [0, 2]}


def edges_of(spark, adj):
    return spark.createDataFrame([(u, f) for u, fs in adj.items() for f in fs], "src long, dst long")


def users_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id long")


def test_pair_counts_and_recommendations(spark):
    e = edges_of(spark, ADJ)
    nf = g.non_friend_pairs(e)
    assert rows(nf) == [(1, 4, 2), (2, 3, 2), (3, 4, 1)]
    rec = g.recommend(e, k=10)
    got = {}
    for r in rec.orderBy("user_id", "rec_rank").collect():
        got.setdefault(r.user_id, []).append(r.rec_id)
    assert got == {1: [4], 2: [3], 3: [2, 4], 4: [1, 3]}  # user 0 absent


def test_recommendation_properties(spark):
    e = edges_of(spark, ADJ)
    rec = g.recommend(e, k=1)
    assert all(r.rec_rank == 1 for r in rec.collect())
    present = set((r.src, r.dst) for r in e.collect())
    for r in g.recommend(e, k=10).collect():
        assert r.user_id != r.rec_id and (r.user_id, r.rec_id) not in present
    cands = rows(g.mirror_pairs(g.non_friend_pairs(e)))
    assert sorted((b, a, n) for a, b, n in cands) == cands  # symmetric


def test_degree_stats_keep_isolated_user(spark):
    e = edges_of(spark, ADJ)
    deg = g.degree(e, users_of(spark, [0, 1, 2, 3, 4, 9]))
    assert dict(rows(deg)) == {0: 4, 1: 3, 2: 3, 3: 2, 4: 2, 9: 0}
    m = g.mean_degree(deg).first()
    assert m.mean_degree == pytest.approx((4 + 3 + 3 + 2 + 2 + 0) / 6)
    assert rows(g.max_degree(deg)) == [(0, 4)]
    assert rows(g.degree_equals(deg, 2)) == [(3, 2), (4, 2)]
    byd = rows(g.ids_by_degree(deg), "degree", "user_id", "n_with_degree")
    assert (3, 1, 2) in byd and (0, 9, 1) in byd


def test_most_named_and_lone_ids(spark):
    adj = {1: [2, 4, 5, 9, 12], 2: [1, 4], 3: [2, 3, 4, 6], 4: [1, 2, 3, 4]}
    e = edges_of(spark, adj)  # raw lists: self-names kept as in the example
    assert g.most_named(e).first().user_id == 4
    lone = g.lone_ids(e, users_of(spark, list(adj)))
    assert [r[0] for r in rows(lone)] == [5, 6, 9, 12]


def test_clean_edges_drops_loops_and_repeats(spark):
    e = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1)], "src long, dst long")
    assert rows(g.clean_edges(e)) == [(1, 2), (2, 1)]


def test_hub_split_equals_plain_join(spark):
    # a star (hub 0 with 30 leaves) plus a ring: the hub is split in blocks
    adj = {0: list(range(1, 31))}
    for i in range(1, 31):
        adj.setdefault(i, []).extend([0, 1 + i % 30])
    e = g.symmetric(g.clean_edges(edges_of(spark, adj)))
    plain = rows(g.wedges(e, hub_degree=10_000))
    split = rows(g.wedges(e, hub_degree=4))
    assert plain == split and len(plain) > 400
    assert rows(g.recommend(e, 10, hub_degree=4)) == rows(g.recommend(e, 10, hub_degree=10_000))


def test_pairs_sharing_key_hot_key(spark):
    df = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 1), (2, 2)], "k long, v long")
    out = rows(hubs.pairs_sharing_key(df, "k", "v", hub_size=5))
    expect = sorted([(1, a, b) for a in range(40) for b in range(a + 1, 40)] + [(2, 1, 2)])
    assert out == expect


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_partition_invariance(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        rec = g.recommend(edges_of(spark, ADJ), k=10)
        assert rows(rec) == [(1, 1, 4, 2), (2, 1, 3, 2), (3, 1, 2, 2), (3, 2, 4, 1),
                             (4, 1, 1, 2), (4, 2, 3, 1)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_first_lines_sample(spark):
    e = edges_of(spark, ADJ)
    s = g.first_lines(e, users_of(spark, [0, 1, 2, 3, 4, 9]), 3)
    assert rows(s) == [(0, 4, "1,2,3,4"), (1, 3, "0,2,3"), (2, 3, "0,1,4")]


def test_recommendation_lines(spark):
    rec = g.recommend(edges_of(spark, ADJ), k=10)
    lines = sorted(r.value for r in g.recommendation_lines(rec).collect())
    assert lines == ["1\t4", "2\t3", "3\t2,4", "4\t1,3"]


def test_hub_split_on_driver_graph(spark):
    from conftest import SF001
    from quarry.plans import bindings as b
    e1 = b.graph_edges(spark, SF001)
    e2 = b.graph_edges(spark, SF001, hub_size=2)  # every order with > 2 parts split
    assert rows(e1) == rows(e2)
    assert rows(g.recommend(e1, 10)) == rows(g.recommend(e1, 10, hub_degree=3))


def test_pairs_are_dealt_out_by_their_number(spark, monkeypatch):
    """Many pairs from few bytes: the join and the count run in tasks sized by pairs."""
    from quarry.operators import hubs
    e = g.symmetric(spark.createDataFrame([(i, j) for i in range(3) for j in range(10, 40)], "src long, dst long"))
    plain = sorted(map(tuple, g.pair_tally(e).collect()))
    monkeypatch.setattr(hubs, "TASK_PAIRS", 20)
    assert hubs.pair_tasks(e, "src") > int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = g.pair_tally(e)
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 3
    assert sorted(map(tuple, t.collect())) == plain


def test_fewer_tasks_than_shuffle_partitions_are_stated_too(spark, monkeypatch):
    """Adaptive execution would merge the shuffle's small parts, and all pairs with them."""
    e = g.symmetric(spark.createDataFrame([(i, j) for i in range(3) for j in range(10, 40)], "src long, dst long"))
    plain = rows(g.pair_tally(e))
    monkeypatch.setattr(hubs, "TASK_PAIRS", 400)
    n = hubs.pair_tasks(e, "src")
    assert 1 < n < int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = g.pair_tally(e)
    assert t._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 3
    assert t.rdd.getNumPartitions() == n
    assert rows(t) == plain


def test_pair_tasks_count_items_as_well_as_pairs(spark, monkeypatch):
    monkeypatch.setattr(hubs, "TASK_PAIRS", 10)
    assert hubs.pair_tasks(spark.createDataFrame([(i, i) for i in range(95)], "k long, v long"), "k") == 10
    assert hubs.pair_tasks(spark.createDataFrame([(0, i) for i in range(10)], "k long, v long"), "k") == 6
    assert hubs.pair_tasks(spark.createDataFrame([], "k long, v long"), "k") == 1


def test_last_window_is_dealt_out_whatever_the_shuffle(spark, monkeypatch):
    """What the top k sorts per task must not grow with the input at few shuffle partitions."""
    e = g.symmetric(spark.createDataFrame([(i, j) for i in range(3) for j in range(10, 40)], "src long, dst long"))
    plain = rows(g.recommend(e, k=3))
    monkeypatch.setattr(hubs, "TASK_PAIRS", 20)
    n = hubs.pair_tasks(e, "src")
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    rec = g.recommend(e, k=3)
    assert rec.rdd.getNumPartitions() == n
    assert rows(rec) == plain and len(plain) > 90


def test_distinct_rows_are_dealt_out_by_their_number(spark, monkeypatch):
    df = spark.createDataFrame([(i % 30, None if i % 3 else i) for i in range(90)], "k long, v long")
    plain = sorted(map(str, df.distinct().collect()))
    monkeypatch.setattr(hubs, "TASK_PAIRS", 7)
    got = hubs.distinct_rows(df)
    assert got.rdd.getNumPartitions() == 13
    assert sorted(map(str, got.collect())) == plain
    assert hubs.distinct_rows(df.limit(0)).count() == 0


def test_edges_are_made_distinct_in_tasks_dealt_out_by_pairs(spark, tmp_dir, monkeypatch):
    """The part graph's edges come in as many parts as there are pairs for, not in shuffle partitions."""
    from quarry.plans import bindings as b
    lines = [(o, p, "R") for o in range(12) for p in range(o % 3, 9)] + [(0, 20, "N"), (None, 3, "R"), (1, None, "R")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_returnflag string") \
        .write.parquet(f"{tmp_dir}/lineitem.parquet")
    plain = rows(b.graph_edges(spark, tmp_dir))
    assert plain == [(i, j) for i in range(9) for j in range(9) if i != j]
    monkeypatch.setattr(hubs, "TASK_PAIRS", 20)
    e = b.graph_edges(spark, tmp_dir)
    assert e.rdd.getNumPartitions() > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows(e) == plain


def test_items_are_not_shuffled_to_find_their_hubs(spark):
    """Items sorted by key beside all keys' sizes would be tasks that grow with the input."""
    df = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 1), (2, 2), (None, 3)], "k long, v long")
    out = hubs.pairs_sharing_key(df, "k", "v", hub_size=5)
    left = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "LeftOuter" in x]
    assert left and all("BroadcastHashJoin" in x for x in left)
    assert out.count() == 40 * 39 / 2 + 1
    assert rows(hubs.pairs_sharing_key(df, "k", "v", 5, tasks=7)) == rows(out)


@pytest.mark.parametrize("tasks, line", [(1, 1000), (4, 2)])
def test_candidate_lists_hold_every_candidate(spark, tasks, line):
    adj = {**ADJ, 5: [0, 1, 2, 3, 4]}
    e = g.symmetric(edges_of(spark, adj))
    cands = g.mirror_pairs(g.non_friend_pairs(e))
    want = {}
    for u, c, n in rows(cands, "user_id", "cand_id", "n"):
        want.setdefault(u, []).append((c, n))
    got = {}
    for r in g.candidate_lists(cands, tasks, line).orderBy("user_id", "list_line").collect():
        part = [tuple(map(int, x.split(":"))) for x in r.candidates.split(",")]
        assert 0 < len(part) <= line and r.list_line == len(got.setdefault(r.user_id, [])) // line
        got[r.user_id] += part
        assert (r.n_candidates, r.sum_mutual) == (len(want[r.user_id]), sum(n for _, n in want[r.user_id]))
    assert got == want and got


def test_candidate_lists_query_returns_the_lists(spark, tmp_path):
    lines = [(1, 1, "R"), (1, 2, "R"), (2, 2, "R"), (2, 3, "R"), (3, 2, "R"), (3, 4, "R"), (4, 3, "N"), (4, 1, "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_returnflag string") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    from quarry.plans import q_graph
    got = rows(q_graph.q_candidate_lists(spark, str(tmp_path)), "user_id", "list_line", "n_candidates", "sum_mutual", "candidates")
    assert got == [(1, 0, 2, 2, "3:1,4:1"), (3, 0, 2, 2, "1:1,4:1"), (4, 0, 2, 2, "1:1,3:1")]
