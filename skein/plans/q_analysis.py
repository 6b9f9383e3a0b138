"""Queries for location matching, counts, pivots and samples (F1, F2, A1-A6, A13, A16, F11, W-rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import dims
from skein.operators import analysis as an
from skein.plans.registry import register, tables
from skein.plans.sqlbits import match_expr

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("f01_location_match", f"""
SELECT user_id, location, search_location, {match_expr('location', 'search_location')} AS location_match
FROM fx_users""")
def f01_location_match(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.location_matches(users)


@register("f02_location_match_bare", """
SELECT user_id, coalesce(strpos(lower(location), search_location) > 0
  OR (search_location = 'kolkata' AND (strpos(lower(location), 'calcutta') > 0 OR strpos(lower(location), 'kolkatta') > 0 OR strpos(lower(location), 'calcuta') > 0))
  OR (search_location = 'new york' AND (strpos(lower(location), 'new york city') > 0 OR strpos(lower(location), 'nyc') > 0))
  OR (search_location = 'guatemala' AND (strpos(lower(location), 'ciudad de guatemala') > 0 OR strpos(lower(location), 'cd. de guatemala') > 0
      OR strpos(lower(location), 'guatemala, ciudad') > 0 OR strpos(lower(location), 'guatemala ciudad') > 0
      OR strpos(lower(location), 'guatemala city') > 0 OR strpos(lower(location), 'guatemala, guatemala') > 0)), false) AS location_match
FROM fx_users""")
def f02_location_match_bare(spark, sf_dir):
    """F2 off: the network-side twin where a bare 'guatemala' also matches."""
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.location_matches(users, exclude_bare=None).select("user_id", "location_match")


@register("a01_location_counts", f"""
SELECT location_match, search_location, count(user_id) AS n_users
FROM (SELECT user_id, search_location, {match_expr('location', 'search_location')} AS location_match FROM fx_users) m
GROUP BY location_match, search_location""")
def a01_location_counts(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.location_counts(an.location_matches(users))


@register("a02_location_pivot", f"""
SELECT search_location AS location,
  nullif(count(CASE WHEN NOT m THEN user_id END), 0) AS n_false,
  nullif(count(CASE WHEN m THEN user_id END), 0) AS n_true,
  nullif(count(CASE WHEN NOT m THEN user_id END), 0) + nullif(count(CASE WHEN m THEN user_id END), 0) AS total,
  round(CAST(nullif(count(CASE WHEN m THEN user_id END), 0) AS DOUBLE)
    / (nullif(count(CASE WHEN NOT m THEN user_id END), 0) + nullif(count(CASE WHEN m THEN user_id END), 0)), 2) AS match_percentage
FROM (SELECT user_id, search_location, {match_expr('location', 'search_location')} AS m FROM fx_users) t
GROUP BY search_location""")
def a02_location_pivot(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.location_pivot(an.location_matches(users))


@register("a03_users_by_type", """
SELECT search_location, search_account_type, count(user_id) AS n_users FROM fx_users
WHERE search_location IS NOT NULL AND search_account_type IS NOT NULL
GROUP BY search_location, search_account_type""")
def a03_users_by_type(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.users_by(users, ["search_location", "search_account_type"])


@register("a04_users_by_label", """
SELECT search_location, content_labels, count(user_id) AS n_users FROM fx_users
WHERE search_location IS NOT NULL AND content_labels IS NOT NULL
GROUP BY search_location, content_labels""")
def a04_users_by_label(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.users_by(users, ["search_location", "content_labels"])


_A5_COLS = ",\n  ".join(f"CAST(sum(CASE WHEN content_labels = '{s}' THEN n END) AS BIGINT) AS {s}" for s in SEGMENTS)
_A5_TOTAL = " + ".join(f"coalesce(sum(CASE WHEN content_labels = '{s}' THEN n END), 0)" for s in SEGMENTS)


@register("a05_label_pivot", f"""
SELECT search_location,
  {_A5_COLS},
  CAST({_A5_TOTAL} AS BIGINT) AS total_per_city
FROM (SELECT search_location, content_labels, count(user_id) AS n FROM fx_users
      WHERE search_location IS NOT NULL AND content_labels IS NOT NULL GROUP BY 1, 2) c
GROUP BY search_location""")
def a05_label_pivot(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    out = an.label_pivot(users, SEGMENTS)
    return out.select("search_location", *[F.col(s).cast("bigint").alias(s) for s in SEGMENTS], "total_per_city")


@register("a06_label_pivot_master", f"""
WITH master AS (
  SELECT search_location, content_labels, user_id FROM fx_users
  UNION ALL
  SELECT search_location, content_labels, user_id FROM fx_users WHERE followers_count > 0)
SELECT search_location,
  {_A5_COLS},
  CAST({_A5_TOTAL} AS BIGINT) AS total_per_city
FROM (SELECT search_location, content_labels, count(user_id) AS n FROM master
      WHERE search_location IS NOT NULL AND content_labels IS NOT NULL GROUP BY 1, 2) c
GROUP BY search_location""")
def a06_label_pivot_master(spark, sf_dir):
    """A6 on a master set: all users ++ 'expanded' users (positive balance), no dedupe between."""
    (users,) = tables(spark, sf_dir, "fx_users")
    from skein.operators.dedupe import master_dataset
    master = master_dataset(users, users.filter("followers_count > 0"))
    out = an.analysis_suite(users, master, SEGMENTS)["user_analysis_with_expansions_pivot"]
    return out.select("search_location", *[F.col(s).cast("bigint").alias(s) for s in SEGMENTS], "total_per_city")


_BY = """SELECT search_location, content_labels, count(user_id) AS n_users FROM {} WHERE search_location IS NOT NULL
  AND content_labels IS NOT NULL GROUP BY 1, 2"""
_MASTER = "(SELECT * FROM fx_users UNION ALL SELECT * FROM fx_users WHERE followers_count > 0) m"


def _suite(spark, sf_dir):
    from skein.operators.dedupe import master_dataset
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.analysis_suite(users, master_dataset(users, users.filter("followers_count > 0")), SEGMENTS)


@register("a06_user_analysis", _BY.format("fx_users"))
def a06_user_analysis(spark, sf_dir):
    return _suite(spark, sf_dir)["user_analysis"]


@register("a06_user_analysis_with_expansions", _BY.format(_MASTER))
def a06_user_analysis_with_expansions(spark, sf_dir):
    return _suite(spark, sf_dir)["user_analysis_with_expansions"]


@register("a06_label_pivot_users", f"""
SELECT search_location, {_A5_COLS}, CAST({_A5_TOTAL} AS BIGINT) AS total_per_city
FROM (SELECT search_location, content_labels, count(user_id) AS n FROM fx_users
      WHERE search_location IS NOT NULL AND content_labels IS NOT NULL GROUP BY 1, 2) c
GROUP BY search_location""")
def a06_label_pivot_users(spark, sf_dir):
    out = _suite(spark, sf_dir)["user_analysis_pivot"]
    return out.select("search_location", *[F.col(s).cast("bigint").alias(s) for s in SEGMENTS], "total_per_city")


@register("a13_dispatch_counters", """
SELECT CAST(count(*) AS BIGINT) AS n_users,
  CAST(sum(CASE WHEN followers_count > 100 AND tweets_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_root_candidates,
  CAST(sum(CASE WHEN description IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_without_description
FROM fx_users""")
def a13_dispatch_counters(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.conditional_counts(users, {
        "n_users": F.lit(True),
        "n_root_candidates": (F.col("followers_count") > dims.ROOT_MIN_FOLLOWERS) & (F.col("tweets_count") > 0),
        "n_without_description": F.col("description").isNull(),
    })


@register("a16_distinct_sources", """
SELECT count(DISTINCT source) AS n_distinct FROM fx_interactions""")
def a16_distinct_sources(spark, sf_dir):
    (inter,) = tables(spark, sf_dir, "fx_interactions")
    return an.distinct_count(inter, "source")


@register("f11_matched_city_users", f"""
SELECT DISTINCT user_id, search_location FROM fx_users
WHERE {match_expr('location', 'search_location')}""")
def f11_matched_city_users(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.matched_city_users(users)


@register("w01_sorted_counts", f"""
SELECT search_location, location_match, count(user_id) AS n_users
FROM (SELECT user_id, search_location, {match_expr('location', 'search_location')} AS location_match FROM fx_users) m
GROUP BY 1, 2 ORDER BY search_location, location_match""")
def w01_sorted_counts(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return (an.location_counts(an.location_matches(users))
            .select("search_location", "location_match", "n_users")
            .orderBy("search_location", "location_match"))


@register("w02_top_followers", """
SELECT user_id, followers_count FROM fx_users ORDER BY followers_count DESC, user_id ASC LIMIT 3""")
def w02_top_followers(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.top_k(users.select("user_id", "followers_count"), "followers_count", 3, "user_id")


@register("w03_first_n_matched", f"""
SELECT user_id FROM (SELECT DISTINCT user_id, ord FROM fx_users WHERE {match_expr('location', 'search_location')}
  AND search_location = 'kolkata') t ORDER BY ord LIMIT 50""")
def w03_first_n_matched(spark, sf_dir):
    """First n matched ids of one city in arrival order (the feature is the limit)."""
    (users,) = tables(spark, sf_dir, "fx_users")
    m = an.location_matches(users).filter("location_match AND search_location = 'kolkata'")
    return m.join(users.select("user_id", "ord"), "user_id").select("user_id", "ord").distinct() \
        .orderBy("ord").limit(50).select("user_id")


@register("w05_cap_per_entity", """
SELECT target, source, ord, pos FROM (
  SELECT target, source, ord, pos, row_number() OVER (PARTITION BY target ORDER BY ord, pos) AS rn
  FROM fx_interactions) t WHERE rn <= 500""")
def w05_cap_per_entity(spark, sf_dir):
    """At most 500 retweeters per entity, first by arrival (the reference's API cap)."""
    (inter,) = tables(spark, sf_dir, "fx_interactions")
    return an.per_group_first_n(inter.select("target", "source", "ord", "pos"), ["target"],
                                [F.col("ord"), F.col("pos")], dims.CAP_RETWEETERS).drop("rn")


@register("w06_random_sample", """
SELECT user_id, search_location, content_labels FROM fx_users
ORDER BY md5('1236|' || user_id), user_id LIMIT 1200""")
def w06_random_sample(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.random_sample(users.select("user_id", "search_location", "content_labels"))


@register("w09_even_split", """
WITH g AS (SELECT DISTINCT search_account_type FROM fx_users),
n AS (SELECT count(*) AS n FROM g),
r AS (SELECT search_account_type, row_number() OVER (ORDER BY search_account_type) AS rn FROM g)
SELECT search_account_type, CAST(CASE WHEN rn = n THEN floor(50 / n) + 50 % n ELSE floor(50 / n) END AS BIGINT) AS budget
FROM r, n""")
def w09_even_split(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.even_split(users.select("search_account_type").distinct(), 50, "search_account_type")


@register("w10_floor_share", """
WITH g AS (SELECT DISTINCT search_account_type FROM fx_users)
SELECT search_account_type, CAST(floor(99 / (SELECT count(*) FROM g)) AS BIGINT) AS budget FROM g""")
def w10_floor_share(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return an.floor_share(users.select("search_account_type").distinct(), 99, "search_account_type")
