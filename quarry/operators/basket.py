"""Market baskets in exploded form ``(basket_id, item)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hubs


def item_cardinality(b: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct items over all baskets; blank items do not count."""
    items = b.where(F.trim("item") != "")
    agg = F.approx_count_distinct("item") if approx else F.countDistinct("item")
    return items.agg(agg.cast("bigint").alias("n_items"))


def k_itemsets(b: DataFrame, k: int, hub_size: int = hubs.DEFAULT_HUB) -> DataFrame:
    """All k-combinations of each basket's distinct items, items ascending:
    ``(basket_id, i1..ik)``.

    Built as k-1 theta self-joins ``i1 < i2 < ... < ik`` on the basket id.
    The first is hub-split, and in each later one the sets of a huge basket are
    dealt to as many cells as it has hub-sized parts, its items going to all of
    them: a huge basket is spread over many tasks. k = 0 gives one empty set per
    basket. The distinct baskets are written once.
    """
    from ..session import shared_dir
    shared_dir(b.sparkSession)
    b = b.select("basket_id", "item").distinct().checkpoint()
    if k == 0:
        return b.select("basket_id").distinct()
    if k == 1:
        return b.select("basket_id", F.col("item").alias("i1"))
    sets = hubs.pairs_sharing_key(b, "basket_id", "item", hub_size) \
        .select("basket_id", F.col("left").alias("i1"), F.col("right").alias("i2"))
    big = hubs.hub_table(b, "basket_id", hub_size)
    cells = F.coalesce(F.col("_r"), F.lit(1))
    for j in range(3, k + 1):
        own = F.pmod(F.xxhash64(*[f"i{i}" for i in range(1, j)]), cells.cast("long")).cast("int")
        left = sets.join(big, "basket_id", "left").withColumn("_c", own).drop("_r")
        nxt = (b.join(big, "basket_id", "left").withColumn("_c", F.explode(F.sequence(F.lit(0), cells - 1)))
               .select("basket_id", "_c", F.col("item").alias(f"i{j}")))
        sets = (left.join(nxt, ["basket_id", "_c"]).where(F.col(f"i{j}") > F.col(f"i{j - 1}"))
                .drop("_c"))
    return sets


def itemset_support(b: DataFrame, k: int) -> DataFrame:
    """Support of each k-itemset: ``(itemset, n_baskets)``, the itemset as
    text ``a|b|...`` in ascending item order."""
    s = k_itemsets(b, k)
    key = F.concat_ws("|", *[F.col(f"i{j}") for j in range(1, k + 1)])
    return s.groupBy(key.alias("itemset")).agg(F.count(F.lit(1)).cast("bigint").alias("n_baskets"))
