"""Adjacency statistics and "people you might know" recommendations.

The graph is held as an edge table ``(src bigint, dst bigint)``: one row per
directed edge, symmetric for an undirected graph. Lists (the adjacency file's
form) are built only where a list has a fixed bound (a sample of lines,
top-k output), never for a whole neighbourhood, so a hub never becomes one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hubs

LIST_LINE = 1000            # candidates of a user on one line


def clean_edges(edges: DataFrame) -> DataFrame:
    """Distinct directed edges without self-loops.

    Fix: a friend repeated in one list, or a user naming itself, would create
    a pair (f, f) and doubled counts; both are removed here.
    """
    return edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct()


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, in one pass (no union re-scan)."""
    both = F.explode(F.array(F.struct(F.col("src").alias("s"), F.col("dst").alias("d")),
                             F.struct(F.col("dst").alias("s"), F.col("src").alias("d"))))
    return edges.select(both.alias("e")).select(F.col("e.s").alias("src"),
                                                F.col("e.d").alias("dst")).distinct()


def degree(edges: DataFrame, users: DataFrame) -> DataFrame:
    """``(user_id, degree)`` for every user; a user without edges has 0.

    Fix: the reference fails on a user without a list; here degree 0.
    """
    d = edges.groupBy(F.col("src").alias("user_id")).agg(F.count(F.lit(1)).alias("degree"))
    return (users.select("user_id").distinct().join(d, "user_id", "left")
            .select("user_id", F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree")))


def degree_equals(deg: DataFrame, n: int) -> DataFrame:
    return deg.where(F.col("degree") == n)


def max_degree(deg: DataFrame) -> DataFrame:
    """The user with most friends; ties to the lowest id (a top-1 report)."""
    return deg.orderBy(F.desc("degree"), F.asc("user_id")).limit(1)


def ids_by_degree(deg: DataFrame) -> DataFrame:
    """Degree -> its ids, in long form ``(degree, user_id, n_with_degree)``.

    The list per degree is unbounded (one degree may hold a third of all
    users), so it stays as rows; the count per degree is a partial aggregate.
    """
    n = deg.groupBy("degree").agg(F.count(F.lit(1)).alias("n_with_degree"))
    return deg.join(n, "degree").select("degree", "user_id",
                                        F.col("n_with_degree").cast("bigint"))


def mean_degree(deg: DataFrame) -> DataFrame:
    """Average list size; users without edges stay in the denominator."""
    return deg.agg(F.avg("degree").alias("mean_degree"),
                   F.count(F.lit(1)).alias("n_users"))


def in_degree(edges: DataFrame) -> DataFrame:
    """How many lists name each id."""
    return edges.groupBy(F.col("dst").alias("user_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("named_by"))


def most_named(edges: DataFrame) -> DataFrame:
    return in_degree(edges).orderBy(F.desc("named_by"), F.asc("user_id")).limit(1)


def lone_ids(edges: DataFrame, subjects: DataFrame) -> DataFrame:
    """Ids that are named in some list but never head a list themselves."""
    named = edges.select(F.col("dst").alias("user_id")).distinct()
    return named.join(subjects.select("user_id"), "user_id", "left_anti")


def first_lines(edges: DataFrame, users: DataFrame, n: int) -> DataFrame:
    """The first ``n`` adjacency lines in file order (the file is ordered by
    user id): ``(user_id, degree, friends)`` with the list as text.

    The sample is the feature: n is bounded, so the lists are bounded by n
    users; their edges are found with a semi-join, not by collecting.
    """
    head = users.select("user_id").orderBy("user_id").limit(n)
    e = edges.join(head.withColumnRenamed("user_id", "src"), "src", "left_semi")
    lists = e.groupBy(F.col("src").alias("user_id")).agg(
        F.sort_array(F.collect_list("dst")).alias("fl"))
    return (head.join(lists, "user_id", "left")
            .select("user_id",
                    F.coalesce(F.size("fl"), F.lit(0)).cast("bigint").alias("degree"),
                    F.coalesce(F.concat_ws(",", F.transform("fl", lambda x: x.cast("string"))),
                               F.lit("")).alias("friends")))


def wedges(edges: DataFrame, hub_degree: int = hubs.DEFAULT_HUB) -> DataFrame:
    """Every unordered pair ``(a, b)``, a < b, with a common friend ``via``.

    Self-join of the edge table on the common friend; hubs are split (see
    ``hubs.pairs_sharing_key``) so one hub's pairs are spread over many tasks.
    """
    return hubs.pairs_sharing_key(edges, key="src", item="dst", hub_size=hub_degree) \
        .select(F.col("left").alias("a"), F.col("right").alias("b"), F.col("src").alias("via"))


def pair_tally(edges: DataFrame, hub_degree: int = hubs.DEFAULT_HUB) -> DataFrame:
    """``(a, b, n, linked)`` for every unordered pair with a common friend.

    Mutual-friend counts and the "already friends" tombstone come out of ONE
    aggregate over wedges plus canonical edges, so removing present friends
    needs no separate anti-join shuffle. Wedges of one pair come from different
    friends, so few meet before the shuffle: many wedges are dealt out first and
    a task tallies a bounded number of them.
    """
    w = wedges(edges, hub_degree).select("a", "b", F.lit(1).alias("w"), F.lit(False).alias("l"))
    t = (edges.where(F.col("src") < F.col("dst"))
         .select(F.col("src").alias("a"), F.col("dst").alias("b"),
                 F.lit(0).alias("w"), F.lit(True).alias("l")))
    return (hubs.deal(w.unionByName(t), hubs.pair_tasks(edges, "src"), "a", "b")
            .groupBy("a", "b")
            .agg(F.sum("w").cast("bigint").alias("n"), F.bool_or("l").alias("linked"))
            .where(F.col("n") > 0))


def mutual_friend_counts(edges: DataFrame, hub_degree: int = hubs.DEFAULT_HUB) -> DataFrame:
    """Common-friend count per unordered pair (friends included)."""
    return pair_tally(edges, hub_degree).select("a", "b", "n")


def non_friend_pairs(edges: DataFrame, hub_degree: int = hubs.DEFAULT_HUB) -> DataFrame:
    """Pairs with a common friend that are not friends already."""
    return pair_tally(edges, hub_degree).where(~F.col("linked")).select("a", "b", "n")


def mirror_pairs(pairs: DataFrame) -> DataFrame:
    """(a, b, n) -> (user_id, cand_id, n) in both directions, one pass."""
    both = F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("c")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("c"))))
    return pairs.select(both.alias("p"), "n").select(
        F.col("p.u").alias("user_id"), F.col("p.c").alias("cand_id"), "n")


def candidate_counts(cands: DataFrame) -> DataFrame:
    """Per user: number of candidates and their mutual-friend total."""
    return cands.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_candidates"),
        F.sum("n").cast("bigint").alias("sum_mutual"))


def candidate_lists(cands: DataFrame, tasks: int = 1, line: int = LIST_LINE) -> DataFrame:
    """Per user the list of its candidates and their counts, in the order of their ids, as
    text ``cand:n,cand:n,...``, beside the user's ``candidate_counts``.

    A list of more than ``line`` candidates goes over several rows, numbered ``list_line``
    from 0, so no row grows with a hub. Users are dealt out over ``tasks`` once, for the
    counts, the lists and their join.
    """
    dealt = hubs.deal(cands, tasks, "user_id")
    w = Window.partitionBy("user_id").orderBy("cand_id")
    lists = (dealt.withColumn("list_line", F.floor((F.row_number().over(w) - 1) / line).cast("bigint"))
             .groupBy("user_id", "list_line").agg(F.sort_array(F.collect_list(F.struct("cand_id", "n"))).alias("l")))
    text = F.transform("l", lambda x: F.concat_ws(":", x["cand_id"].cast("string"), x["n"].cast("string")))
    return candidate_counts(dealt).join(lists, "user_id").select(
        "user_id", "list_line", "n_candidates", "sum_mutual", F.concat_ws(",", text).alias("candidates"))


def top_n(cands: DataFrame, k: int = 10, tasks: int = 1) -> DataFrame:
    """Top ``k`` candidates per user by count desc, id asc.

    Users are dealt out over ``tasks``, so that what a task sorts does not grow with
    the input. With one task, ``row_number() <= k`` lets Spark insert a map-side
    WindowGroupLimit; over many, a user has few candidates in each and none would be
    left out. Users with no candidate are absent (as in the reference).
    """
    w = Window.partitionBy("user_id").orderBy(F.desc("n"), F.asc("cand_id"))
    return (hubs.deal(cands, tasks, "user_id").withColumn("rec_rank", F.row_number().over(w))
            .where(F.col("rec_rank") <= k)
            .select("user_id", F.col("rec_rank").cast("bigint"),
                    F.col("cand_id").alias("rec_id"), F.col("n").alias("mutual")))


def recommend(edges: DataFrame, k: int = 10, hub_degree: int = hubs.DEFAULT_HUB) -> DataFrame:
    """The whole job: wedges -> tally with tombstones -> mirror -> top k."""
    return top_n(mirror_pairs(non_friend_pairs(edges, hub_degree)), k, hubs.pair_tasks(edges, "src"))


def recommendation_lines(recs: DataFrame) -> DataFrame:
    """Text form ``user<TAB>id,id,...`` (bounded: at most k ids per user)."""
    g = recs.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("rec_rank", "rec_id"))).alias("r"))
    return g.select(F.concat_ws("\t", F.col("user_id").cast("string"),
                                F.concat_ws(",", F.transform("r", lambda x: x["rec_id"].cast("string"))))
                    .alias("value"))
