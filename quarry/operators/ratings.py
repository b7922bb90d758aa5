"""Profile of a rating log ``(movie_id, user_id, rate, rated_on)`` and its
title table ``(movie_id, title)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(r: DataFrame) -> DataFrame:
    """Count, distinct users and date range in ONE aggregate pass.

    Fix: the reference's ``if/elif`` never tests a new minimum for the
    maximum; here plain ``min``/``max``.
    """
    return r.agg(F.count(F.lit(1)).cast("bigint").alias("n_ratings"),
                 F.countDistinct("user_id").cast("bigint").alias("n_users"),
                 F.min("rated_on").alias("first_date"),
                 F.max("rated_on").alias("last_date"))


def rating_count(r: DataFrame) -> DataFrame:
    return r.agg(F.count(F.lit(1)).cast("bigint").alias("n_ratings"))


def rating_users(r: DataFrame) -> DataFrame:
    return r.agg(F.countDistinct("user_id").cast("bigint").alias("n_users"))


def rating_date_range(r: DataFrame) -> DataFrame:
    return r.agg(F.min("rated_on").alias("first_date"), F.max("rated_on").alias("last_date"))


def distinct_titles(t: DataFrame) -> DataFrame:
    return t.agg(F.countDistinct("title").cast("bigint").alias("n_titles"))


def titles_shared_by_n(t: DataFrame, n: int) -> DataFrame:
    """Number of titles owned by exactly ``n`` ids."""
    per = t.groupBy("title").agg(F.count(F.lit(1)).alias("ids"))
    return per.where(F.col("ids") == n).agg(F.count(F.lit(1)).cast("bigint").alias("n_titles"))


def user_counts(r: DataFrame) -> DataFrame:
    """Ratings per user, repeats counted."""
    return r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def users_with_n_ratings(r: DataFrame, n: int) -> DataFrame:
    return (user_counts(r).where(F.col("n") == n)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_users"),
                 F.min("user_id").alias("lowest_user")))


def lowest_user_favourites(r: DataFrame, n: int) -> DataFrame:
    """Rate-5 movies of the numerically lowest user among those with exactly
    ``n`` ratings; a movie rated twice appears twice. No such user -> empty.

    The lowest id is a scalar subquery, so the filter is a plain predicate on
    the scan side; nothing is collected.
    """
    lowest = users_with_n_ratings(r, n).select("lowest_user")
    return (r.where((F.col("rate") == 5) & (F.col("user_id") == lowest.scalar()))
            .select("user_id", "movie_id"))


def with_titles(fav: DataFrame, t: DataFrame) -> DataFrame:
    """Titles for movie ids; unknown id -> NULL title (left join)."""
    return fav.join(t, "movie_id", "left").select("user_id", "movie_id", "title")


def user_rate_histogram(r: DataFrame) -> DataFrame:
    """Per user: count of each rate 1..5 and total (a pivot with fixed
    values, so no extra pass to find them)."""
    p = r.groupBy("user_id").pivot("rate", [1, 2, 3, 4, 5]).agg(F.count(F.lit(1)))
    cols = [F.coalesce(F.col(str(i)), F.lit(0)).cast("bigint").alias(f"n{i}") for i in range(1, 6)]
    out = p.select("user_id", *cols)
    return out.withColumn("total", sum(F.col(f"n{i}") for i in range(1, 6)))
