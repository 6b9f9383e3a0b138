"""Flat network tables, edge building and coverage statistics.

A root document (root user > posts > retweeters, root user > followers) is
kept as four flat tables instead of nested arrays:

* ``roots``       user_id, username, profile_location, target_location, followers_count,
                  following_count, tweets_count, city, ord
* ``root_tweets`` root_id, tweet_id, tweet_text, created_on, retweet_count, ord
* ``retweeters``  root_id, tweet_id, user_id, username, profile_location, followers_count,
                  following_count, ord, pos
* ``followers``   root_id, user_id, username, profile_location, target_location,
                  followers_count, following_count, ord, pos

Everything below is joins and hash aggregates over these tables, so a root with
millions of retweeters is processed by many tasks, never held in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.predicates import is_original, location_match, with_city_targets
from skein.functions.text import iso, parse_any_date
from skein.operators.dedupe import keep_first
from skein.operators.long_lists import numbered
from skein.operators.medians import exact_medians

EDGE_COLUMNS = ["source", "source_username", "source_followers", "source_following", "tweet_id",
                "target", "target_username", "target_followers", "target_following"]


def explode_roots(net_root: DataFrame) -> dict[str, DataFrame]:
    """S3 -> flat tables: explode nested root documents once (bounded per document). Roots are numbered in the
    order of their landed files (``file``, ``pos``), where the documents have them."""
    user_cols = [c for c in net_root.columns if c not in ("tweets", "followers", "file", "pos")]
    if {"file", "pos"} <= set(net_root.columns):
        roots = numbered(net_root.select(*user_cols, "file", "pos"), ["file", "pos"], "ord").drop("file", "pos")
    else:
        roots = net_root.select(*user_cols, F.monotonically_increasing_id().alias("ord"))
    tw = net_root.select(F.col("user_id").alias("root_id"), F.posexplode_outer("tweets").alias("ord", "t")) \
        .filter(F.col("t").isNotNull())
    root_tweets = tw.select("root_id", "t.tweet_id", "t.tweet_text", F.col("t.created_at").alias("created_on"),
                            "t.retweet_count", "ord")
    retweeters = tw.select("root_id", F.col("t.tweet_id").alias("tweet_id"), F.col("ord"),
                           F.posexplode("t.retweeters").alias("pos", "r")) \
        .select("root_id", "tweet_id", "r.*", "ord", "pos")
    followers = net_root.select(F.col("user_id").alias("root_id"), F.lit(0).cast("bigint").alias("ord"),
                                F.posexplode("followers").alias("pos", "f")) \
        .select("root_id", "f.*", "ord", "pos")
    return {"roots": roots, "root_tweets": root_tweets, "retweeters": retweeters, "followers": followers}


def _edge_rows(actors: DataFrame, roots: DataFrame, with_tweet: bool) -> DataFrame:
    """Edge row = actor (source) -> root (target) with both sides' attributes."""
    r = roots.select(F.col("user_id").alias("target"), F.col("username").alias("target_username"),
                     F.col("followers_count").alias("target_followers"),
                     F.col("following_count").alias("target_following"))
    a = actors.select(F.col("root_id").alias("target"), F.col("user_id").alias("source"),
                      F.col("username").alias("source_username"),
                      F.col("followers_count").alias("source_followers"),
                      F.col("following_count").alias("source_following"),
                      (F.col("tweet_id") if with_tweet else F.lit(None).cast("string")).alias("tweet_id"),
                      "ord", "pos")
    return a.join(r, "target", "left").select(*EDGE_COLUMNS, "ord", "pos")


def retweet_edges(roots: DataFrame, root_tweets: DataFrame, retweeters: DataFrame,
                  all_retweeters: bool = False, exclude_bare: list[str] | None = None) -> DataFrame:
    """G1 (retweet) with D8: per root and original post, the first retweeter whose
    profile location matches the root's city yields the edge (``all_retweeters``
    keeps every matching retweeter). The network twins test bare city names too.
    """
    originals = root_tweets.filter(is_original("tweet_text")).select("root_id", "tweet_id")
    city = roots.select(F.col("user_id").alias("root_id"), F.col("target_location").alias("__city"))
    cand = retweeters.join(originals, ["root_id", "tweet_id"], "left_semi").join(city, "root_id", "left")
    cand = with_city_targets(cand, "__city", exclude_bare, out="__targets")
    matched = cand.filter(location_match("profile_location", "__targets")).drop("__city", "__targets")
    if not all_retweeters:
        matched = keep_first(matched, ["root_id", "tweet_id"], ["ord", "pos"])
    return _edge_rows(matched, roots, with_tweet=True)


def follower_edges(roots: DataFrame, followers: DataFrame, test_profile: bool = False,
                   exclude_bare: list[str] | None = None) -> DataFrame:
    """G1 (follow) with D9: per root a follower yields one edge if its location
    matches; the reference tests ``target_location`` (option: ``profile_location``).
    """
    city = roots.select(F.col("user_id").alias("root_id"), F.col("target_location").alias("__city"))
    cand = with_city_targets(followers.join(city, "root_id", "left"), "__city", exclude_bare, out="__targets")
    loc = "profile_location" if test_profile else "target_location"
    matched = cand.filter(location_match(loc, "__targets")).drop("__city", "__targets")
    first = keep_first(matched, ["root_id", "user_id"], ["ord", "pos"])
    return _edge_rows(first, roots, with_tweet=False)


def root_stats(roots: DataFrame, root_tweets: DataFrame, retweeters: DataFrame, followers: DataFrame,
               follow_edges: DataFrame, rt_edges: DataFrame) -> DataFrame:
    """Per root coverage figures (roots lacking ``followers_count`` are skipped, F15)."""
    t = root_tweets.withColumn("__orig", is_original("tweet_text"))
    n_rt = retweeters.groupBy("root_id", "tweet_id").agg(F.count(F.lit(1)).alias("__n_rt"))
    t = t.join(n_rt, ["root_id", "tweet_id"], "left").withColumn("__n_rt", F.coalesce("__n_rt", F.lit(0)))
    per_root = t.groupBy(F.col("root_id").alias("user_id")).agg(
        F.sum(F.when(F.col("__orig"), 1).otherwise(0)).alias("originals"),
        F.sum(F.when(F.col("__orig") & (F.col("retweet_count") > 0), 1).otherwise(0)).alias("originals_with_retweets"),
        F.sum(F.when(F.col("__orig") & (F.col("retweet_count") > 0), F.col("retweet_count")).otherwise(0)).alias("retweets_total"),
        F.sum(F.when(F.col("__orig") & (F.col("__n_rt") > 0), 1).otherwise(0)).alias("originals_with_collected"),
        F.sum(F.when(F.col("__orig"), F.col("__n_rt")).otherwise(0)).alias("collected_retweeters"))
    n_fol = followers.groupBy(F.col("root_id").alias("user_id")).agg(F.count(F.lit(1)).alias("collected_followers"))
    city_f = follow_edges.groupBy(F.col("target").alias("user_id")).agg(F.count(F.lit(1)).alias("city_followers"))
    city_r = rt_edges.groupBy(F.col("target").alias("user_id")).agg(F.count(F.lit(1)).alias("city_retweeters"))
    base = roots.filter(F.col("followers_count").isNotNull()).select(
        "user_id", "followers_count", "following_count")
    out = base.join(per_root, "user_id", "left").join(n_fol, "user_id", "left") \
        .join(city_f, "user_id", "left").join(city_r, "user_id", "left")
    zero = ["originals", "originals_with_retweets", "retweets_total", "originals_with_collected",
            "collected_retweeters", "collected_followers", "city_followers", "city_retweeters"]
    out = out.fillna(0, subset=zero)
    for c in zero:
        out = out.withColumn(c, F.col(c).cast("bigint"))
    return out.withColumn(
        "share_with_retweets",
        F.when(F.col("originals") == 0, F.lit(0.0)).otherwise(F.col("originals_with_retweets") / F.col("originals"))
    ).withColumn(
        "share_collected",
        F.when(F.col("originals_with_retweets") > 0,
               F.col("originals_with_collected") / F.col("originals_with_retweets")))


def network_medians(stats: DataFrame) -> DataFrame:
    """A10: exact medians of the A9 columns and the ratio-of-median figures, rounded to 2.

    Inclusion rules: followers/following only when > 0; city counts and original
    counts only for roots with at least one original that was retweeted. All ten are found
    in one pass over value counts (``exact_medians``), so no task holds a column's values.
    """
    active = F.col("originals_with_retweets") > 0
    m = exact_medians(stats, {
        "m_originals": F.when(active, F.col("originals")),
        "m_followers": F.when(F.col("followers_count") > 0, F.col("followers_count")),
        "m_following": F.when(F.col("following_count") > 0, F.col("following_count")),
        "m_collected_followers": F.col("collected_followers"),
        "m_city_followers": F.when(active, F.col("city_followers")),
        "m_share_with_retweets": F.col("share_with_retweets"),
        "m_retweets_total": F.col("retweets_total"),
        "m_share_collected": F.when(active, F.col("share_collected")),
        "m_collected_retweeters": F.col("collected_retweeters"),
        "m_city_retweeters": F.when(active, F.col("city_retweeters"))})
    r = F.round
    return m.select(
        r("m_originals", 2).alias("median_originals"),
        r("m_followers", 2).alias("median_followers"),
        r("m_following", 2).alias("median_following"),
        r("m_collected_followers", 2).alias("median_collected_followers"),
        r(F.try_divide(F.col("m_collected_followers"), F.col("m_followers")), 2).alias("collected_over_followers"),
        r("m_city_followers", 2).alias("median_city_followers"),
        r(F.try_divide(F.col("m_city_followers"), F.col("m_collected_followers")), 2).alias("city_over_collected_followers"),
        r(F.try_divide(F.col("m_city_followers"), F.col("m_followers")), 2).alias("city_over_followers"),
        r("m_share_with_retweets", 2).alias("median_share_with_retweets"),
        r("m_retweets_total", 2).alias("median_retweets_total"),
        r("m_share_collected", 2).alias("median_share_collected"),
        r("m_collected_retweeters", 2).alias("median_collected_retweeters"),
        r(F.try_divide(F.col("m_collected_retweeters"), F.col("m_retweets_total")), 2).alias("collected_over_retweets"),
        r("m_city_retweeters", 2).alias("median_city_retweeters"),
        r(F.try_divide(F.col("m_city_retweeters"), F.col("m_collected_retweeters")), 2).alias("city_over_collected_retweeters"),
        r(F.try_divide(F.col("m_city_retweeters"), F.col("m_retweets_total")), 2).alias("city_over_retweets"))


def query_shares(root_tweets: DataFrame) -> DataFrame:
    """Per root, share of collected posts that are reposts vs originals;
    roots without posts are skipped; medians of both shares (rounded to 2)."""
    per = root_tweets.groupBy("root_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(is_original("tweet_text"), 0).otherwise(1)).alias("n_rt"))
    per = per.filter(F.col("n") > 0).select(
        (F.col("n_rt") / F.col("n")).alias("rt_share"),
        ((F.col("n") - F.col("n_rt")) / F.col("n")).alias("original_share"))
    m = exact_medians(per, {"rt": F.col("rt_share"), "original": F.col("original_share")})
    return m.select(F.round("rt", 2).alias("median_rt_share"), F.round("original", 2).alias("median_original_share"))


def last_tweeted_at(root_tweets: DataFrame, created: str = "created_on") -> DataFrame:
    """Latest post time per root over all posts, reposts included."""
    return root_tweets.groupBy(F.col("root_id").alias("user_id")).agg(F.max(created).alias("last_tweeted_at"))


#: Where each landed shape keeps the fields of a vertex (fixed names of the landed records).
_USER_SHAPES = {
    "flat": {"user_id": "user_id", "username": "username", "followers_count": "followers_count",
             "following_count": "following_count", "tweets_count": "tweets_count"},
    "api": {"user_id": "id", "username": "username", "followers_count": "public_metrics.followers_count",
            "following_count": "public_metrics.following_count", "tweets_count": "public_metrics.tweet_count"},
    "scraper": {"user_id": "id", "username": "screen_name", "followers_count": "followers_count",
                "following_count": "following_count", "tweets_count": "statuses_count"},
}


def normalize_net_user(users: DataFrame, now: str | None = None, exclude_bare=dims.EXCLUDE_BARE,
                       shape: str = "flat", keep: list[str] = ()) -> DataFrame:
    """P5: the 20-field vertex shape from one of the landed shapes (``flat``, ``api``, ``scraper``; a
    legacy follower goes through P7 to ``api``). Status ``pending``; category/arm null; missing
    counts -> -99; city = target city when the profile location matches. ``verified`` and ``created_at``
    are the record's own (false and null where it has none; a scraper's post-style date becomes ISO).
    ``keep`` names columns that stay in front of them."""
    t = with_city_targets(users, "search_location", exclude_bare, out="__t")
    at = _USER_SHAPES[shape]
    match = location_match("location", "__t")
    cnt = lambda c: F.coalesce(F.col(at[c]).cast("bigint"), F.lit(-99)).alias(c)
    ts = F.lit(now).cast("timestamp") if now else F.lit(None).cast("timestamp")
    verified = F.coalesce(F.col("verified").cast("boolean"), F.lit(False)) if "verified" in users.columns else F.lit(False)
    created = F.col("created_at").cast("string") if "created_at" in users.columns else F.lit(None).cast("string")
    if shape == "scraper":
        created = iso(parse_any_date(created, lenient=True))
    return t.select(
        *keep, F.col(at["user_id"]).alias("user_id"), F.col(at["username"]).alias("username"), "description",
        F.col("location").alias("profile_location"), F.col("search_location").alias("target_location"),
        cnt("followers_count"), cnt("following_count"), cnt("tweets_count"), verified.alias("verified"),
        created.alias("created_at"), F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("treatment_arm"), F.lit("pending").alias("retweeter_status"),
        F.lit(None).cast("timestamp").alias("retweeter_last_processed"), F.lit("pending").alias("follower_status"),
        F.lit(None).cast("timestamp").alias("follower_last_processed"),
        F.lit(None).cast("timestamp").alias("last_tweeted_at"), ts.alias("extracted_at"), ts.alias("last_updated"),
        F.when(match, F.col("search_location")).alias("city"))


def normalize_net_tweet(tweets: DataFrame, keep: list[str] = ()) -> DataFrame:
    """5 fields; ``like_count`` -> ``favorite_count``, missing -> 0."""
    fav = F.col("like_count") if "like_count" in tweets.columns else F.lit(None)
    rt = F.col("retweet_count") if "retweet_count" in tweets.columns else F.lit(None)
    return tweets.select(*keep, "tweet_id", "tweet_text", F.col("created_on").alias("created_at"),
                         F.coalesce(rt.cast("bigint"), F.lit(0)).alias("retweet_count"),
                         F.coalesce(fav.cast("bigint"), F.lit(0)).alias("favorite_count"))
