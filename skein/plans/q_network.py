"""Queries for edge building and coverage statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions.predicates import location_match, with_city_targets
from skein.functions.text import iso
from skein.operators import network as nw
from skein.operators import enrich as en
from skein.plans.registry import register, tables
from skein.plans.sqlbits import NET_CTES, match_expr
from skein.session import stored


def net_tables(spark, sf_dir, need: tuple[str, ...] = ("retweeters", "followers")):
    """The four flat network tables derived from the fixture views.

    Like the pipeline's explode step, the large tables a query needs (``need``)
    are materialised once (compressed columns in the session's scratch folder)
    so that every consumer in the plan reads them instead of re-deriving them from
    the base tables; the small ones stay lazy projections.
    """
    users, tweets, rts, inter = tables(spark, sf_dir, "fx_users", "fx_tweets", "fx_net_retweeters",
                                       "fx_interactions")
    t = with_city_targets(users, "search_location", out="__t")
    roots = t.select("user_id", "username", F.col("location").alias("profile_location"),
                     F.col("search_location").alias("target_location"), "followers_count",
                     "following_count", "tweets_count", "ord",
                     F.when(location_match("location", "__t"), F.col("search_location")).alias("city"))
    root_tweets = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text", "created_on",
                                "retweet_count", "ord")
    attrs = users.select("user_id", "username", F.col("location").alias("profile_location"),
                         "followers_count", "following_count")
    retweeters = rts.join(attrs, "user_id", "left").select(
        "root_id", "tweet_id", "user_id", "username", "profile_location", "followers_count",
        "following_count", "ord", "pos")
    root_city = users.select(F.col("user_id").alias("root_id"), F.col("search_location").alias("target_location"))
    followers = inter.select(F.col("target").alias("root_id"), F.col("source").alias("user_id"), "ord", "pos") \
        .join(root_city, "root_id", "left").join(attrs, "user_id", "left") \
        .select("root_id", "user_id", "username", "profile_location", "target_location", "followers_count",
                "following_count", "ord", "pos")
    if "retweeters" in need:
        retweeters = stored(retweeters, "retweeters")
    if "followers" in need:
        followers = stored(followers, "followers")
    return roots, root_tweets, retweeters, followers


_RT_EDGES_SQL = f"""
rt_first AS (
  SELECT * FROM (
    SELECT r.*, row_number() OVER (PARTITION BY r.root_id, r.tweet_id ORDER BY r.ord, r.pos) AS rn
    FROM net_rt r
    JOIN net_tweets tw ON tw.root_id = r.root_id AND tw.tweet_id = r.tweet_id
      AND coalesce(tw.tweet_text NOT LIKE 'RT @%', true)
    LEFT JOIN net_roots c ON c.user_id = r.root_id
    WHERE {match_expr('r.profile_location', 'c.target_location', None)}) x WHERE rn = 1),
rt_edges AS (
  SELECT f.user_id AS source, f.username AS source_username, f.followers_count AS source_followers,
    f.following_count AS source_following, f.tweet_id, f.root_id AS target, t.username AS target_username,
    t.followers_count AS target_followers, t.following_count AS target_following, f.ord, f.pos
  FROM rt_first f LEFT JOIN net_roots t ON t.user_id = f.root_id)"""

_FOL_EDGES_SQL = f"""
fol_first AS (
  SELECT * FROM (
    SELECT r.*, row_number() OVER (PARTITION BY r.root_id, r.user_id ORDER BY r.ord, r.pos) AS rn
    FROM net_fol r LEFT JOIN net_roots c ON c.user_id = r.root_id
    WHERE {match_expr('r.target_location', 'c.target_location', None)}) x WHERE rn = 1),
fol_edges AS (
  SELECT f.user_id AS source, f.username AS source_username, f.followers_count AS source_followers,
    f.following_count AS source_following, CAST(NULL AS VARCHAR) AS tweet_id, f.root_id AS target,
    t.username AS target_username, t.followers_count AS target_followers,
    t.following_count AS target_following, f.ord, f.pos
  FROM fol_first f LEFT JOIN net_roots t ON t.user_id = f.root_id)"""


@register("g01_retweet_interactions", f"WITH {NET_CTES}, {_RT_EDGES_SQL} SELECT * FROM rt_edges")
def g01_retweet_interactions(spark, sf_dir):
    roots, root_tweets, retweeters, _ = net_tables(spark, sf_dir, need=('retweeters',))
    return nw.retweet_edges(roots, root_tweets, retweeters)


@register("g01_follower_interactions", f"WITH {NET_CTES}, {_FOL_EDGES_SQL} SELECT * FROM fol_edges")
def g01_follower_interactions(spark, sf_dir):
    roots, _, _, followers = net_tables(spark, sf_dir, need=('followers',))
    return nw.follower_edges(roots, followers)


@register("d08_all_matching_retweeters", f"""
WITH {NET_CTES}
SELECT r.user_id AS source, r.tweet_id, r.root_id AS target, r.ord, r.pos
FROM net_rt r
JOIN net_tweets tw ON tw.root_id = r.root_id AND tw.tweet_id = r.tweet_id AND coalesce(tw.tweet_text NOT LIKE 'RT @%', true)
LEFT JOIN net_roots c ON c.user_id = r.root_id
WHERE {match_expr('r.profile_location', 'c.target_location', None)}""")
def d08_all_matching_retweeters(spark, sf_dir):
    """Option ``all_retweeters``: every matching retweeter of an original yields an edge."""
    roots, root_tweets, retweeters, _ = net_tables(spark, sf_dir, need=('retweeters',))
    return nw.retweet_edges(roots, root_tweets, retweeters, all_retweeters=True) \
        .select("source", "tweet_id", "target", "ord", "pos")


_STATS_SQL = f"""
{NET_CTES}, {_RT_EDGES_SQL}, {_FOL_EDGES_SQL},
nrt AS (SELECT root_id, tweet_id, count(*) AS n_rt FROM net_rt GROUP BY 1, 2),
tw AS (SELECT t.root_id, t.tweet_id, t.retweet_count, coalesce(t.tweet_text NOT LIKE 'RT @%', true) AS orig,
  coalesce(n.n_rt, 0) AS n_rt FROM net_tweets t LEFT JOIN nrt n ON n.root_id = t.root_id AND n.tweet_id = t.tweet_id),
per_root AS (SELECT root_id,
  sum(CASE WHEN orig THEN 1 ELSE 0 END) AS originals,
  sum(CASE WHEN orig AND retweet_count > 0 THEN 1 ELSE 0 END) AS originals_with_retweets,
  sum(CASE WHEN orig AND retweet_count > 0 THEN retweet_count ELSE 0 END) AS retweets_total,
  sum(CASE WHEN orig AND n_rt > 0 THEN 1 ELSE 0 END) AS originals_with_collected,
  sum(CASE WHEN orig THEN n_rt ELSE 0 END) AS collected_retweeters
  FROM tw GROUP BY root_id),
nfol AS (SELECT root_id, count(*) AS n FROM net_fol GROUP BY 1),
cf AS (SELECT target, count(*) AS n FROM fol_edges GROUP BY 1),
cr AS (SELECT target, count(*) AS n FROM rt_edges GROUP BY 1),
stats AS (
  SELECT r.user_id, r.followers_count, r.following_count,
    CAST(coalesce(p.originals, 0) AS BIGINT) AS originals,
    CAST(coalesce(p.originals_with_retweets, 0) AS BIGINT) AS originals_with_retweets,
    CAST(coalesce(p.retweets_total, 0) AS BIGINT) AS retweets_total,
    CAST(coalesce(p.originals_with_collected, 0) AS BIGINT) AS originals_with_collected,
    CAST(coalesce(p.collected_retweeters, 0) AS BIGINT) AS collected_retweeters,
    CAST(coalesce(nf.n, 0) AS BIGINT) AS collected_followers,
    CAST(coalesce(cf.n, 0) AS BIGINT) AS city_followers,
    CAST(coalesce(cr.n, 0) AS BIGINT) AS city_retweeters
  FROM net_roots r LEFT JOIN per_root p ON p.root_id = r.user_id LEFT JOIN nfol nf ON nf.root_id = r.user_id
  LEFT JOIN cf ON cf.target = r.user_id LEFT JOIN cr ON cr.target = r.user_id
  WHERE r.followers_count IS NOT NULL),
stats2 AS (
  SELECT *, CASE WHEN originals = 0 THEN 0.0 ELSE CAST(originals_with_retweets AS DOUBLE) / originals END AS share_with_retweets,
    CASE WHEN originals_with_retweets > 0 THEN CAST(originals_with_collected AS DOUBLE) / originals_with_retweets END AS share_collected
  FROM stats)"""


@register("a09_root_stats", f"WITH {_STATS_SQL} SELECT * FROM stats2")
def a09_root_stats(spark, sf_dir):
    roots, root_tweets, retweeters, followers = net_tables(spark, sf_dir)
    fe = nw.follower_edges(roots, followers)
    re_ = nw.retweet_edges(roots, root_tweets, retweeters)
    return nw.root_stats(roots, root_tweets, retweeters, followers, fe, re_)


@register("a10_network_medians", f"""
WITH {_STATS_SQL},
m AS (SELECT
  median(CASE WHEN originals_with_retweets > 0 THEN originals END) AS m_originals,
  median(CASE WHEN followers_count > 0 THEN followers_count END) AS m_followers,
  median(CASE WHEN following_count > 0 THEN following_count END) AS m_following,
  median(collected_followers) AS m_collected_followers,
  median(CASE WHEN originals_with_retweets > 0 THEN city_followers END) AS m_city_followers,
  median(share_with_retweets) AS m_share_with_retweets,
  median(retweets_total) AS m_retweets_total,
  median(CASE WHEN originals_with_retweets > 0 THEN share_collected END) AS m_share_collected,
  median(collected_retweeters) AS m_collected_retweeters,
  median(CASE WHEN originals_with_retweets > 0 THEN city_retweeters END) AS m_city_retweeters
  FROM stats2)
SELECT round(m_originals, 2) AS median_originals, round(m_followers, 2) AS median_followers,
  round(m_following, 2) AS median_following, round(m_collected_followers, 2) AS median_collected_followers,
  round(m_collected_followers / nullif(m_followers, 0), 2) AS collected_over_followers,
  round(m_city_followers, 2) AS median_city_followers,
  round(m_city_followers / nullif(m_collected_followers, 0), 2) AS city_over_collected_followers,
  round(m_city_followers / nullif(m_followers, 0), 2) AS city_over_followers,
  round(m_share_with_retweets, 2) AS median_share_with_retweets, round(m_retweets_total, 2) AS median_retweets_total,
  round(m_share_collected, 2) AS median_share_collected, round(m_collected_retweeters, 2) AS median_collected_retweeters,
  round(m_collected_retweeters / nullif(m_retweets_total, 0), 2) AS collected_over_retweets,
  round(m_city_retweeters, 2) AS median_city_retweeters,
  round(m_city_retweeters / nullif(m_collected_retweeters, 0), 2) AS city_over_collected_retweeters,
  round(m_city_retweeters / nullif(m_retweets_total, 0), 2) AS city_over_retweets
FROM m""")
def a10_network_medians(spark, sf_dir):
    return nw.network_medians(a09_root_stats(spark, sf_dir))


@register("a11_query_shares", f"""
WITH {NET_CTES},
per AS (SELECT root_id, count(*) AS n, sum(CASE WHEN coalesce(tweet_text NOT LIKE 'RT @%', true) THEN 0 ELSE 1 END) AS n_rt
  FROM net_tweets GROUP BY root_id)
SELECT round(median(CAST(n_rt AS DOUBLE) / n), 2) AS median_rt_share,
  round(median(CAST(n - n_rt AS DOUBLE) / n), 2) AS median_original_share FROM per WHERE n > 0""")
def a11_query_shares(spark, sf_dir):
    _, root_tweets, _, _ = net_tables(spark, sf_dir, need=())
    return nw.query_shares(root_tweets)


@register("a12_last_tweeted_at", f"""
WITH {NET_CTES} SELECT root_id AS user_id, max(created_on) AS last_tweeted_at FROM net_tweets GROUP BY root_id""")
def a12_last_tweeted_at(spark, sf_dir):
    _, root_tweets, _, _ = net_tables(spark, sf_dir, need=())
    return nw.last_tweeted_at(root_tweets)


@register("j07_count_city_edges", f"""
WITH {NET_CTES}, {_FOL_EDGES_SQL}
SELECT r.user_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_edges FROM net_roots r
LEFT JOIN (SELECT target, count(*) AS n FROM fol_edges GROUP BY target) c ON c.target = r.user_id""")
def j07_count_city_edges(spark, sf_dir):
    roots, _, _, followers = net_tables(spark, sf_dir, need=('followers',))
    fe = nw.follower_edges(roots, followers)
    return en.count_city_edges(roots.select("user_id"), fe)


@register("j13_user_catalog", f"""
WITH {NET_CTES},
allu AS (
  SELECT user_id, username, profile_location, followers_count, 0 AS src, ord AS o, 0 AS p FROM net_roots
  UNION ALL SELECT user_id, username, profile_location, followers_count, 1, ord, pos FROM net_rt
  UNION ALL SELECT user_id, username, profile_location, followers_count, 2, ord, pos FROM net_fol)
SELECT user_id, username, profile_location, followers_count FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY src, o, p) AS rn FROM allu) x
WHERE rn = 1 AND user_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""")
def j13_user_catalog(spark, sf_dir):
    """Catalogue of all users seen in the network, minus those already stored (ids in ``labels``)."""
    roots, _, retweeters, followers = net_tables(spark, sf_dir)
    (labels,) = tables(spark, sf_dir, "labels")
    stored = labels.select(F.col("doc_id").cast("string").alias("user_id"))
    return en.user_catalog(roots, retweeters, followers, stored)


_P5_NOW = "2025-02-01T00:00:00+00:00"
_P5_SQL = f"""
SELECT user_id, username, description, location AS profile_location, search_location AS target_location,
  coalesce(followers_count, -99) AS followers_count, coalesce(following_count, -99) AS following_count,
  coalesce(tweets_count, -99) AS tweets_count, ord % 3 = 0 AS verified,
  CASE WHEN ord % 7 <> 0 THEN '2015-0' || CAST(1 + ord % 9 AS VARCHAR) || '-11T10:20:30+00:00' END AS created_at,
  CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS treatment_arm, 'pending' AS retweeter_status,
  CAST(NULL AS VARCHAR) AS retweeter_last_processed, 'pending' AS follower_status,
  CAST(NULL AS VARCHAR) AS follower_last_processed, CAST(NULL AS VARCHAR) AS last_tweeted_at,
  '{_P5_NOW}' AS extracted_at, '{_P5_NOW}' AS last_updated,
  CASE WHEN {match_expr('location', 'search_location')} THEN search_location END AS city
FROM fx_users"""


def _landed_users(spark, sf_dir):
    """Accounts with a verified flag (missing for some) and a creation time (missing for some)."""
    (users,) = tables(spark, sf_dir, "fx_users")
    day = F.concat(F.lit("2015-0"), (F.col("ord") % 9 + 1).cast("string"), F.lit("-11T10:20:30+00:00"))
    return users.withColumns({
        "verified": F.when(F.col("ord") % 3 == 0, F.lit(True)).when(F.col("ord") % 3 == 1, F.lit(False)),
        "created_at": F.when(F.col("ord") % 7 != 0, day)})


def _text_times(df):
    """Times as ISO text, the form both sides of the comparison share."""
    return df.select(*[iso(f.name).alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
                       for f in df.schema.fields])


@register("p05_normalize_net_user", _P5_SQL)
def p05_normalize_net_user(spark, sf_dir):
    return _text_times(nw.normalize_net_user(_landed_users(spark, sf_dir), now=_P5_NOW))


@register("p05_api_shape", _P5_SQL)
def p05_api_shape(spark, sf_dir):
    """The same accounts landed by the API: nested metrics, ``id``."""
    u = _landed_users(spark, sf_dir).select(
        F.col("user_id").alias("id"), "username", "description", "location", "search_location", "verified", "created_at",
        F.struct("followers_count", "following_count", F.col("tweets_count").alias("tweet_count")).alias("public_metrics"))
    return _text_times(nw.normalize_net_user(u, now=_P5_NOW, shape="api"))


@register("p05_scraper_shape", _P5_SQL)
def p05_scraper_shape(spark, sf_dir):
    """The same accounts landed by the scraper: ``screen_name``, ``statuses_count``, post-style dates."""
    posted = F.date_format(F.to_timestamp("created_at"), "EEE MMM dd HH:mm:ss '+0000' yyyy")
    u = _landed_users(spark, sf_dir).select(
        F.col("user_id").alias("id"), F.col("username").alias("screen_name"), "description", "location", "search_location",
        "verified", posted.alias("created_at"), "followers_count", "following_count",
        F.col("tweets_count").alias("statuses_count"))
    return _text_times(nw.normalize_net_user(u, now=_P5_NOW, shape="scraper"))


@register("p07_legacy_follower", _P5_SQL)
def p07_legacy_follower(spark, sf_dir):
    """Legacy follower records renamed to the API shape (P7), then normalised (P5)."""
    from skein.operators.normalize import legacy_follower_to_v2
    u = _landed_users(spark, sf_dir)
    old = u.select(F.col("user_id").alias("id_str"), F.col("username").alias("screen_name"), "name", "description",
                   "location", "followers_count", F.col("following_count").alias("friends_count"),
                   F.col("tweets_count").alias("statuses_count"))
    extra = u.select(F.col("user_id").alias("id"), "search_location", "verified", "created_at")
    return _text_times(nw.normalize_net_user(legacy_follower_to_v2(old).join(extra, "id"), now=_P5_NOW, shape="api"))


@register("p06_normalize_net_tweet", """
SELECT tweet_id, tweet_text, created_on AS created_at, coalesce(retweet_count, 0) AS retweet_count,
  CAST(0 AS BIGINT) AS favorite_count FROM fx_tweets""")
def p06_normalize_net_tweet(spark, sf_dir):
    (tweets,) = tables(spark, sf_dir, "fx_tweets")
    return nw.normalize_net_tweet(tweets)
