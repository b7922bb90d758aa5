"""RATING keys: profile of the customer x part rating log and part titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ratings as rt
from . import bindings as b
from .catalog import register

R = "WITH " + b.RATINGS_SQL
N_RATINGS = 37   # "users with exactly N ratings" (the reference asks for 200)
N_TITLE_IDS = 26  # "titles owned by exactly N ids" (the reference asks for 4)


@register("rating_records", R + " SELECT movie_id, user_id, rate, rated_on FROM r")
def q_rating_records(spark, d):
    return b.ratings(spark, d)


@register("rating_count", R + " SELECT CAST(count(*) AS BIGINT) AS n_ratings FROM r")
def q_rating_count(spark, d):
    return rt.rating_count(b.ratings(spark, d))


@register("rating_users", R + " SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_users FROM r")
def q_rating_users(spark, d):
    return rt.rating_users(b.ratings(spark, d))


@register("rating_date_range", R + " SELECT min(rated_on) AS first_date, max(rated_on) AS last_date FROM r")
def q_rating_date_range(spark, d):
    return rt.rating_date_range(b.ratings(spark, d))


@register("rating_profile", R + """
SELECT CAST(count(*) AS BIGINT) AS n_ratings, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       min(rated_on) AS first_date, max(rated_on) AS last_date FROM r""")
def q_rating_profile(spark, d):
    return rt.profile(b.ratings(spark, d))


@register("distinct_titles", "SELECT CAST(count(DISTINCT p_name) AS BIGINT) AS n_titles FROM part")
def q_distinct_titles(spark, d):
    return rt.distinct_titles(b.titles(spark, d))


@register("titles_shared_by_n", f"""
SELECT CAST(count(*) AS BIGINT) AS n_titles FROM
 (SELECT p_name FROM part GROUP BY p_name HAVING count(*) = {N_TITLE_IDS})""")
def q_titles_shared_by_n(spark, d):
    return rt.titles_shared_by_n(b.titles(spark, d), N_TITLE_IDS)


@register("users_with_n_ratings", R + f"""
SELECT CAST(count(*) AS BIGINT) AS n_users, min(user_id) AS lowest_user FROM
 (SELECT user_id FROM r GROUP BY user_id HAVING count(*) = {N_RATINGS})""")
def q_users_with_n_ratings(spark, d):
    return rt.users_with_n_ratings(b.ratings(spark, d), N_RATINGS)


FAV_SQL = R + f""",
lo AS (SELECT min(user_id) AS u FROM
       (SELECT user_id FROM r GROUP BY user_id HAVING count(*) = {N_RATINGS})),
f AS (SELECT user_id, movie_id FROM r WHERE rate = 5 AND user_id = (SELECT u FROM lo))"""


@register("lowest_user_favourites", FAV_SQL + " SELECT user_id, movie_id FROM f")
def q_lowest_user_favourites(spark, d):
    return rt.lowest_user_favourites(b.ratings(spark, d), N_RATINGS)


@register("top_user_titles", FAV_SQL + """
SELECT f.user_id, f.movie_id, p.p_name AS title FROM f LEFT JOIN part p ON f.movie_id = p.p_partkey""")
def q_top_user_titles(spark, d):
    fav = rt.lowest_user_favourites(b.ratings(spark, d), N_RATINGS)
    return rt.with_titles(fav, b.titles(spark, d))


@register("user_rate_histogram", R + """
SELECT user_id,
  CAST(count(*) FILTER (WHERE rate = 1) AS BIGINT) AS n1,
  CAST(count(*) FILTER (WHERE rate = 2) AS BIGINT) AS n2,
  CAST(count(*) FILTER (WHERE rate = 3) AS BIGINT) AS n3,
  CAST(count(*) FILTER (WHERE rate = 4) AS BIGINT) AS n4,
  CAST(count(*) FILTER (WHERE rate = 5) AS BIGINT) AS n5,
  CAST(count(*) AS BIGINT) AS total
FROM r GROUP BY user_id""")
def q_user_rate_histogram(spark, d):
    return rt.user_rate_histogram(b.ratings(spark, d))
