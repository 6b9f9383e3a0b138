"""Record-shape projections on hand-written API-shaped rows."""

from pyspark.sql import functions as F

from skein.operators import normalize as nm
from skein.operators.network import normalize_net_tweet, normalize_net_user


def test_tweets_full_and_users_search(spark):
    t = spark.createDataFrame([("1", "smog today", "7", "Fri Dec 06 18:09:05 +0000 2024", "en")],
                              "id STRING, text STRING, author_id STRING, created_at STRING, lang STRING")
    r = nm.normalize_tweets_full(t).first()
    assert (r.tweet_id, r.created_at, r.lang, r.geo) == ("1", "2024-12-06T18:09:05+00:00", "en", None)
    u = spark.createDataFrame([("7", "asha", None, "Kolkata, India", "Asha", None, (150, 10, 3, 1))],
                              "id STRING, username STRING, description STRING, location STRING, name STRING, url STRING, "
                              "public_metrics STRUCT<followers_count: BIGINT, following_count: BIGINT, tweet_count: BIGINT, "
                              "listed_count: BIGINT>")
    r = nm.normalize_users_search(u).first()
    assert (r.user_id, r.followers_count, r.listed_count, r.tweets, r.geo_code) == ("7", 150, 1, [], [])


def test_explode_lists_and_split_scraped(spark):
    ul = spark.createDataFrame([("7", [("9", "Air Quality", None, "", 3, 4, False, "8")]), ("8", [])],
                               "user_id STRING, lists ARRAY<STRUCT<id: STRING, name: STRING, created_at: STRING, "
                               "description: STRING, follower_count: BIGINT, member_count: BIGINT, private: BOOLEAN, "
                               "owner_id: STRING>>")
    rows = nm.explode_lists(ul).collect()
    assert [(r.user_id, r.list_id, r.name) for r in rows] == [("7", "9", "Air Quality")]
    posts = spark.createDataFrame([("t1", "hello", "2025-01-02T10:00:00", ("7", "Asha", "bio", "Kolkata", "asha", None, 5, 6))],
                                  "tweet_id STRING, text STRING, created_at STRING, user STRUCT<id: STRING, name: STRING, "
                                  "description: STRING, location: STRING, screen_name: STRING, url: STRING, "
                                  "followers_count: INT, following_count: INT>")
    tw, us = nm.split_scraped(posts)
    assert tw.first().author_id == "7"
    r = us.first()
    assert (r.username, r.tweets, r.tweet_date, r.user_date_id) == ("Asha", ["hello"], "2025-01-02", "7-2025-01-02")


def test_legacy_follower_and_net_shapes(spark):
    legacy = spark.createDataFrame([("5", "bob", "Bob", None, "NYC", 120, 7, 30)],
                                   "id_str STRING, screen_name STRING, name STRING, description STRING, location STRING, "
                                   "followers_count BIGINT, friends_count BIGINT, statuses_count BIGINT")
    r = nm.legacy_follower_to_v2(legacy).first()
    assert (r.id, r.username, r.public_metrics.following_count, r.public_metrics.tweet_count) == ("5", "bob", 7, 30)
    users = spark.createDataFrame([("1", "a", None, "NYC ", "new york", None, 3, 2)],
                                  "user_id STRING, username STRING, description STRING, location STRING, "
                                  "search_location STRING, followers_count BIGINT, following_count BIGINT, tweets_count BIGINT")
    v = normalize_net_user(users).first()
    assert (v.followers_count, v.city, v.retweeter_status, v.follower_status) == (-99, "new york", "pending", "pending")
    tw = spark.createDataFrame([("t", "x", "2025-01-01", None, 4)],
                               "tweet_id STRING, tweet_text STRING, created_on STRING, retweet_count BIGINT, like_count BIGINT")
    r = normalize_net_tweet(tw).first()
    assert (r.retweet_count, r.favorite_count) == (0, 4)


def test_reset_status_and_geo_placeholder(spark):
    df = spark.createDataFrame([("1", "completed")], "user_id STRING, follower_status STRING")
    r = nm.geo_placeholder(nm.reset_status(df)).first()
    assert r.follower_status == "pending" and r.retweeter_last_processed is None
    assert r.geo_location.lat is None and r.geo_location.lng is None


def test_render_queries_unknown_city_has_no_template(spark):
    cities = spark.createDataFrame([("calcutta",), ("atlantis",)], "city STRING")
    got = {(r.city, r.account_type): r.query for r in nm.render_queries(cities, "city").collect()}
    assert got[("calcutta", "politicians")] == "(calcutta) (politics OR politicians OR politician) -is:retweet"
    assert got[("atlantis", "media")] is None
