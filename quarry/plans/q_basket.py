"""BASKET keys: orders as baskets of part brands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import basket as bk
from . import bindings as b
from .catalog import register

B = "WITH " + b.BASKETS_SQL


@register("item_cardinality", B + " SELECT CAST(count(DISTINCT item) AS BIGINT) AS n_items FROM bk")
def q_item_cardinality(spark, d):
    return bk.item_cardinality(b.baskets(spark, d))


@register("k_itemsets", B + """
SELECT x.basket_id, CAST(count(*) AS BIGINT) AS n_sets, min(x.item || '|' || y.item) AS first_set,
       max(x.item || '|' || y.item) AS last_set
FROM bk x JOIN bk y ON x.basket_id = y.basket_id AND x.item < y.item GROUP BY x.basket_id""")
def q_k_itemsets(spark, d):
    """The 2-combinations of each basket, as a summary of every basket."""
    both = F.concat_ws("|", "i1", "i2")
    return bk.k_itemsets(b.baskets(spark, d), 2).groupBy("basket_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_sets"), F.min(both).alias("first_set"),
        F.max(both).alias("last_set"))


@register("itemset_support", B + """
SELECT x.item || '|' || y.item AS itemset, CAST(count(*) AS BIGINT) AS n_baskets
FROM bk x JOIN bk y ON x.basket_id = y.basket_id AND x.item < y.item GROUP BY 1""")
def q_itemset_support(spark, d):
    return bk.itemset_support(b.baskets(spark, d), 2)


@register("itemset_support_3", B + """
SELECT x.item || '|' || y.item || '|' || z.item AS itemset, CAST(count(*) AS BIGINT) AS n_baskets
FROM bk x JOIN bk y ON x.basket_id = y.basket_id AND x.item < y.item
JOIN bk z ON z.basket_id = x.basket_id AND y.item < z.item GROUP BY 1""")
def q_itemset_support_3(spark, d):
    return bk.itemset_support(b.baskets(spark, d), 3)
