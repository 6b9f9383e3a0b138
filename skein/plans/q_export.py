"""Queries for the bulk-load exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import export as ex
from skein.plans.q_network import net_tables
from skein.plans.registry import register, tables
from skein.plans.sqlbits import EDGE_CTE, NET_CTES, match_expr


def _typed(spark, sf_dir):
    roots, root_tweets, retweeters, followers = net_tables(spark, sf_dir)
    return ex.typed_tables(roots, root_tweets, retweeters, followers)


_TXT = "CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) = '' THEN 'null' ELSE CAST({c} AS VARCHAR) END"
_INT = "CASE WHEN {c} IS NULL OR {c} = 0 THEN -99 ELSE {c} END"

_TYPED_SQL = f"""
{NET_CTES},
valid AS (SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY user_id ORDER BY ord) AS rn FROM net_roots r
  WHERE user_id IS NOT NULL AND city IS NOT NULL AND city = target_location) x WHERE rn = 1),
lt AS (SELECT root_id, max(created_on) AS last_tweeted_at FROM net_tweets GROUP BY root_id),
rows_all AS (
  SELECT v.user_id, v.username, v.profile_location, v.target_location, v.followers_count, v.following_count,
    v.tweets_count, v.city, lt.last_tweeted_at, v.ord AS o1, 0 AS sec, CAST(0 AS BIGINT) AS o2, CAST(0 AS BIGINT) AS o3
  FROM valid v LEFT JOIN lt ON lt.root_id = v.user_id
  UNION ALL
  SELECT r.user_id, r.username, r.profile_location, v.target_location, r.followers_count, r.following_count,
    NULL, CASE WHEN {match_expr('r.profile_location', 'v.target_location', None)} THEN v.target_location END, NULL,
    v.ord, 1, t.ord, r.pos
  FROM net_rt r JOIN valid v ON v.user_id = r.root_id LEFT JOIN net_tweets t ON t.root_id = r.root_id AND t.tweet_id = r.tweet_id
  UNION ALL
  SELECT f.user_id, f.username, f.profile_location, v.target_location, f.followers_count, f.following_count,
    NULL, CASE WHEN {match_expr('f.profile_location', 'v.target_location', None)} THEN v.target_location END, NULL,
    v.ord, 2, f.ord, f.pos
  FROM net_fol f JOIN valid v ON v.user_id = f.root_id),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o1, sec, o2, o3) AS rn2
  FROM rows_all) x WHERE rn2 = 1)"""


@register("k09_typed_vertices", f"""
WITH {_TYPED_SQL}
SELECT user_id AS "~id", 'User' AS "~label", {_TXT.format(c='username')} AS username, {_TXT.format(c='city')} AS city,
  {_TXT.format(c='profile_location')} AS profile_location, {_TXT.format(c='target_location')} AS target_location,
  {_INT.format(c='followers_count')} AS "followers_count:Int", {_INT.format(c='following_count')} AS "following_count:Int",
  {_INT.format(c='tweets_count')} AS "tweets_count:Int", 'null' AS category, 'null' AS treatment_arm, 'null' AS verified,
  'null' AS created_at,
  CASE WHEN last_tweeted_at IS NULL THEN 'null' ELSE strftime(CAST(last_tweeted_at AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S+00:00') END AS last_tweeted_at,
  'null' AS retweeter_status, 'null' AS retweeter_last_processed, 'null' AS follower_status,
  'null' AS follower_last_processed, 'null' AS extracted_at, 'null' AS last_updated
FROM firsts""")
def k09_typed_vertices(spark, sf_dir):
    return _typed(spark, sf_dir)["vertices"]


@register("g12_belongs_to", f"""
WITH {_TYPED_SQL}
SELECT sha256(concat_ws('|', user_id, city, 'BELONGS_TO')) AS "~id", user_id AS "~from", city AS "~to",
  'BELONGS_TO' AS "~label" FROM (SELECT user_id, city FROM firsts WHERE city IS NOT NULL AND city = target_location
  UNION SELECT user_id, city FROM valid)""")
def g12_belongs_to(spark, sf_dir):
    return _typed(spark, sf_dir)["belongs_to"]


@register("g14_typed_retweets", f"""
WITH {_TYPED_SQL}
SELECT sha256(concat_ws('|', r.user_id, r.root_id, 'RETWEETED')) AS "~id", r.user_id AS "~from", r.root_id AS "~to",
  'RETWEETED' AS "~label", count(*) AS "weight:Int", string_agg(r.tweet_id, ';' ORDER BY t.ord, r.pos, r.tweet_id) AS tweet_ids
FROM net_rt r JOIN valid v ON v.user_id = r.root_id LEFT JOIN net_tweets t ON t.root_id = r.root_id AND t.tweet_id = r.tweet_id
GROUP BY r.user_id, r.root_id""")
def g14_typed_retweets(spark, sf_dir):
    return _typed(spark, sf_dir)["retweeted"]


@register("g15_typed_follows", f"""
WITH {_TYPED_SQL}
SELECT DISTINCT sha256(concat_ws('|', f.user_id, f.root_id, 'FOLLOWS')) AS "~id", f.user_id AS "~from", f.root_id AS "~to",
  'FOLLOWS' AS "~label" FROM net_fol f JOIN valid v ON v.user_id = f.root_id""")
def g15_typed_follows(spark, sf_dir):
    return _typed(spark, sf_dir)["follows"]


@register("k08_simple_vertices", f"""
WITH {EDGE_CTE},
ends AS (SELECT source AS id, source_username AS username, source_followers AS followers, ord, pos, 0 AS side FROM ie
  UNION ALL SELECT target, target_username, target_followers, ord, pos, 1 FROM ie)
SELECT id AS "~id", 'user' AS "~label", username, followers, 'chicago' AS location FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC, pos DESC, side DESC) AS rn FROM ends) x WHERE rn = 1""")
def k08_simple_vertices(spark, sf_dir):
    users, inter = tables(spark, sf_dir, "fx_users", "fx_interactions")
    v, _ = ex.export_graph_simple(inter, "retweet", "chicago", users)
    return v


@register("w08_k08_simple_edges", """
WITH g AS (SELECT source, target, count(*) AS w, min(ord) AS o,
    string_agg(tweet_id, ',' ORDER BY ord, pos, tweet_id) AS ids FROM fx_interactions GROUP BY source, target),
g2 AS (SELECT g.*, (SELECT min(pos) FROM fx_interactions i WHERE i.source = g.source AND i.target = g.target AND i.ord = g.o) AS p FROM g)
SELECT 'e' || CAST(row_number() OVER (ORDER BY o, p, source, target) AS VARCHAR) AS "~id", source AS "~from",
  target AS "~to", 'retweeted' AS "~label", w AS weight, ids AS "tweet_ids:String", 'chicago' AS location FROM g2""")
def w08_k08_simple_edges(spark, sf_dir):
    users, inter = tables(spark, sf_dir, "fx_users", "fx_interactions")
    _, e = ex.export_graph_simple(inter, "retweet", "chicago", users)
    return e


@register("k08_simple_follow_edges", """
WITH g AS (SELECT source, target, min(ord) AS o FROM fx_interactions GROUP BY source, target),
g2 AS (SELECT g.*, (SELECT min(pos) FROM fx_interactions i WHERE i.source = g.source AND i.target = g.target AND i.ord = g.o) AS p FROM g)
SELECT 'e' || CAST(row_number() OVER (ORDER BY o, p, source, target) AS VARCHAR) AS "~id", source AS "~from",
  target AS "~to", 'follows' AS "~label", 'chicago' AS location FROM g2""")
def k08_simple_follow_edges(spark, sf_dir):
    users, inter = tables(spark, sf_dir, "fx_users", "fx_interactions")
    _, e = ex.export_graph_simple(inter, "follower", "chicago", users)
    return e


@register("p16_export_props", """
SELECT username, CASE WHEN location IS NULL OR trim(location) = '' THEN 'null'
  ELSE replace(replace(location, '\\', '\\\\'), '"', '\\"') END AS location, followers_count
FROM fx_users""")
def p16_export_props(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return ex.export_props(users.select("user_id", "description", "username", "location", "followers_count"))


@register("p18_migrate_status", """
SELECT user_id, CASE WHEN followers_count > 5000 THEN 'completed' ELSE 'pending' END AS retweeter_status,
  CASE WHEN followers_count > 5000 THEN 'completed' ELSE 'pending' END AS follower_status,
  CASE WHEN followers_count > 5000 THEN '2025-01-' || lpad(CAST(tweets_count + 1 AS VARCHAR), 2, '0') END AS retweeter_last_processed,
  CASE WHEN followers_count > 5000 THEN '2025-01-' || lpad(CAST(tweets_count + 1 AS VARCHAR), 2, '0') END AS follower_last_processed
FROM fx_users""")
def p18_migrate_status(spark, sf_dir):
    """Legacy records (one processing status + time) migrated to the two-status shape."""
    (users,) = tables(spark, sf_dir, "fx_users")
    legacy = users.select(
        "user_id",
        F.when(F.col("followers_count") > 5000, "completed").otherwise("pending").alias("processing_status"),
        F.concat(F.lit("2025-01-"), F.lpad((F.col("tweets_count") + 1).cast("string"), 2, "0")).alias("last_processed"))
    return ex.migrate_status(legacy)
