"""Binding of each job to the driver tables.

The driver tables are a TPC-H-like schema; each job of the reference reads its
own kind of file. These functions derive the job's input from the tables with
Spark (scan -> prune -> filter -> join), so every job's work grows with them.
Only the columns a job needs are read, so Parquet pruning and pushdown apply.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# A line item is identified by order, line number, part and supplier (the
# line number alone repeats within an order in the driver data).
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_ID_SQL = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


def line_id():
    return F.concat_ws("-", *[F.col(c).cast("string") for c in LINE_KEY])


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


# ---------------------------------------------------------------- GRAPH
def graph_edges(spark: SparkSession, sf_dir: str, hub_size: int | None = None) -> DataFrame:
    """Undirected part graph: two parts are friends when they sit in the same
    order, both lines returned (``l_returnflag = 'R'``). Distinct, no loops,
    both directions. Pairs are dealt out by their number before they are made distinct,
    so a task's edges do not grow with the input."""
    from ..operators import hubs
    li = hubs.distinct_rows(table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_returnflag")
                            .where(F.col("l_returnflag") == "R").select("l_orderkey", "l_partkey"))
    n = hubs.pair_tasks(li, "l_orderkey")
    pairs = hubs.deal(hubs.pairs_sharing_key(li, "l_orderkey", "l_partkey", hub_size or hubs.DEFAULT_HUB, n)
                      .select("left", "right"), n, "left", "right").distinct()
    both = F.explode(F.array(F.struct(F.col("left").alias("s"), F.col("right").alias("d")),
                             F.struct(F.col("right").alias("s"), F.col("left").alias("d"))))
    return (pairs.select(both.alias("e"))
            .select(F.col("e.s").alias("src"), F.col("e.d").alias("dst")))


def graph_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey").select(F.col("p_partkey").alias("user_id"))


GRAPH_EDGES_SQL = """
li AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'),
e AS (SELECT DISTINCT x.l_partkey AS src, y.l_partkey AS dst
      FROM li x JOIN li y ON x.l_orderkey = y.l_orderkey
      WHERE x.l_partkey <> y.l_partkey),
u AS (SELECT p_partkey AS user_id FROM part)"""


# ---------------------------------------------------------------- RATING
def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating log: user = customer, movie = part, rate from the line number,
    date = ship date."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_partkey").alias("movie_id"),
                    F.col("o_custkey").alias("user_id"),
                    (F.col("l_linenumber") % 5 + 1).cast("int").alias("rate"),
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("rated_on")))


RATINGS_SQL = """
r AS (SELECT l_partkey AS movie_id, o_custkey AS user_id,
             CAST(l_linenumber % 5 + 1 AS INTEGER) AS rate,
             strftime(l_shipdate, '%Y-%m-%d') AS rated_on
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", "p_partkey", "p_name").select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"))


# ---------------------------------------------------------------- BASKET
def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exploded baskets ``(basket_id, item)``: an order's distinct brands."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("basket_id"), F.col("p_brand").alias("item"))
            .distinct())


BASKETS_SQL = """
bk AS (SELECT DISTINCT l_orderkey AS basket_id, p_brand AS item
       FROM lineitem JOIN part ON l_partkey = p_partkey)"""


# ---------------------------------------------------------------- EVAL-ROC
def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score/label table with many ties: score = discount, label = returned."""
    li = table(spark, sf_dir, "lineitem", *LINE_KEY, "l_discount", "l_returnflag")
    return li.select(line_id().alias("row_id"),
                     (F.col("l_discount") + F.lit(0.0)).alias("score"),
                     (F.col("l_returnflag") == "R").cast("int").alias("label"))


SCORED_LINES_SQL = """
sl AS (SELECT """ + LINE_ID_SQL + """ AS row_id, l_discount + 0.0 AS score,
              CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem)"""


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score/label table with few ties: score = total price, label = filled."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    return o.select(F.col("o_orderkey").alias("row_id"),
                    (F.col("o_totalprice") + F.lit(0.0)).alias("score"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("label"))


SCORED_ORDERS_SQL = """
sl AS (SELECT o_orderkey AS row_id, o_totalprice + 0.0 AS score,
              CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders)"""


# ---------------------------------------------------------------- TEXT
def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review table: text of labelled documents; a star rating 5.0 for a
    good-quality document and 1.0 otherwise, so ``liked`` = quality."""
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality")
    return d.join(lab, "doc_id").select(
        "doc_id", F.col("text").alias("review"),
        (F.col("quality") * 4 + 1).cast("double").alias("overall"))


REVIEWS_SQL = """
rv AS (SELECT doc_id, text AS review, CAST(quality * 4 + 1 AS DOUBLE) AS overall
       FROM documents JOIN labels USING (doc_id)),
lr AS (SELECT doc_id, review, CAST(coalesce(overall > 3, false) AS INTEGER) AS liked FROM rv
       WHERE overall IS DISTINCT FROM 3.0 AND review IS NOT NULL),
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)))
                      <= ceil(0.1 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM lr)"""


# ---------------------------------------------------------------- CLUSTER
def points_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", *LINE_KEY, "l_quantity", "l_discount")
    return li.select(line_id().alias("id"),
                     F.array(F.col("l_quantity").cast("double"),
                             (F.col("l_discount") * 100).cast("double")).alias("features"))


POINTS_SQL = """
pt AS (SELECT """ + LINE_ID_SQL + """ AS id, CAST(l_quantity AS DOUBLE) AS x,
              CAST(l_discount * 100 AS DOUBLE) AS y FROM lineitem)"""


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return e.select(F.col("vec_id").alias("id"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"),
                    "label")
