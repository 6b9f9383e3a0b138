"""Queries for keyed dedupe, page merges, unions and enrichment joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import dedupe as dd
from skein.operators import enrich as en
from skein.plans.registry import register, tables


def _queue_records(spark, sf_dir):
    """Landed records of three kinds in one key space (fx_queue):
    'view' rows carry a user_date_id, 'click' rows a tweet_id, the rest only a user_id."""
    (q,) = tables(spark, sf_dir, "fx_queue")
    return q.select(
        F.when(F.col("topic") == "view", F.concat_ws("-", "user_id", F.substring(F.col("ts").cast("string"), 1, 10)))
        .alias("user_date_id"),
        F.when(F.col("topic") == "click", F.col("seq").cast("string")).alias("tweet_id"),
        "user_id", "topic", "seq", "page")


_RECORDS_SQL = """
recs AS (SELECT CASE WHEN topic = 'view' THEN concat_ws('-', user_id, substr(CAST(ts AS VARCHAR), 1, 10)) END AS user_date_id,
  CASE WHEN topic = 'click' THEN CAST(seq AS VARCHAR) END AS tweet_id, user_id, topic, seq, page FROM fx_queue)"""


@register("d01_dedupe_by_key", f"""
WITH {_RECORDS_SQL}
SELECT user_date_id, tweet_id, user_id, topic, seq, page FROM (
  SELECT *, row_number() OVER (PARTITION BY coalesce(user_date_id, tweet_id, user_id) ORDER BY seq) AS rn FROM recs
  WHERE coalesce(user_date_id, tweet_id, user_id) IS NOT NULL) x WHERE rn = 1""")
def d01_dedupe_by_key(spark, sf_dir):
    return dd.dedupe_by_key(_queue_records(spark, sf_dir), ["seq"])


@register("d02_dedupe_whole", """
SELECT DISTINCT source, target FROM fx_interactions""")
def d02_dedupe_whole(spark, sf_dir):
    (inter,) = tables(spark, sf_dir, "fx_interactions")
    return dd.dedupe_whole(inter.select("source", "target"))


@register("d03_unique_users", """
WITH both_sets AS (
  SELECT user_id, search_location, ord, 0 AS batch FROM fx_users
  UNION ALL SELECT user_id, 'expanded' AS search_location, ord, 1 AS batch FROM fx_users WHERE followers_count > 0)
SELECT user_id, search_location FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch, ord) AS rn FROM both_sets) x WHERE rn = 1""")
def d03_unique_users(spark, sf_dir):
    """Normal ++ expanded copies of the users; the first occurrence per user_id stays."""
    (users,) = tables(spark, sf_dir, "fx_users")
    both = users.select("user_id", "search_location", "ord", F.lit(0).alias("batch")).unionByName(
        users.filter("followers_count > 0").select("user_id", F.lit("expanded").alias("search_location"), "ord",
                                                    F.lit(1).alias("batch")))
    return dd.unique_by(both, "user_id", ["batch", "ord"]).select("user_id", "search_location")


@register("d04_unique_lists", """
SELECT list_id, user_id, name, description FROM (
  SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY ord) AS rn FROM (
    SELECT list_id, user_id, name, description, ord FROM fx_lists
    UNION ALL SELECT list_id, user_id, upper(name), description, ord + 1000000000 FROM fx_lists) y) x WHERE rn = 1""")
def d04_unique_lists(spark, sf_dir):
    """Lists landed twice (the second copy later): the first copy per list_id stays."""
    (lists,) = tables(spark, sf_dir, "fx_lists")
    a = lists.select("list_id", "user_id", "name", "description", "ord")
    b = lists.select("list_id", "user_id", F.upper("name").alias("name"), "description",
                     (F.col("ord") + 1000000000).alias("ord"))
    return dd.unique_by(a.unionByName(b), "list_id", ["ord"]).select("list_id", "user_id", "name", "description")


@register("d05_merge_pages", """
SELECT user_id, topic, seq, page FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY page DESC, seq ASC) AS rn FROM fx_queue) x WHERE rn = 1""")
def d05_merge_pages(spark, sf_dir):
    """Result pages of one query: the last page wins per id, first record within a page."""
    (q,) = tables(spark, sf_dir, "fx_queue")
    return dd.merge_pages(q.select("user_id", "topic", "seq", "page"), "user_id", page="page", pos="seq")


@register("d07_first_occurrence", """
WITH ends AS (SELECT source AS id, ord, pos, 0 AS side FROM fx_interactions
  UNION ALL SELECT target, ord, pos, 1 FROM fx_interactions)
SELECT id, ord, pos, side FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord, pos, side) AS rn FROM ends) x
WHERE rn = 1""")
def d07_first_occurrence(spark, sf_dir):
    (inter,) = tables(spark, sf_dir, "fx_interactions")
    ends = inter.select(F.explode(F.array(
        F.struct(F.col("source").alias("id"), "ord", "pos", F.lit(0).alias("side")),
        F.struct(F.col("target").alias("id"), "ord", "pos", F.lit(1).alias("side")))).alias("e")).select("e.*")
    return dd.first_occurrence(ends, "id", ["ord", "pos", "side"])


@register("u01_union_files", """
SELECT user_id, name, description, NULL AS list_id, search_location FROM fx_users
UNION ALL SELECT user_id, name, description, list_id, NULL FROM fx_lists""")
def u01_union_files(spark, sf_dir):
    users, lists = tables(spark, sf_dir, "fx_users", "fx_lists")
    return dd.union_files([users.select("user_id", "name", "description", "search_location"),
                           lists.select("user_id", "name", "description", "list_id")]) \
        .select("user_id", "name", "description", "list_id", "search_location")


@register("u02_master_dataset", """
SELECT search_location, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM (
  SELECT user_id, search_location FROM fx_users
  UNION ALL SELECT user_id, search_location FROM fx_users WHERE followers_count > 0) m GROUP BY search_location""")
def u02_master_dataset(spark, sf_dir):
    """Master = distinct users ++ expanded users, duplicates kept; rows vs users per city."""
    (users,) = tables(spark, sf_dir, "fx_users")
    u = users.select("user_id", "search_location")
    m = dd.master_dataset(u, users.filter("followers_count > 0").select("user_id", "search_location"))
    return m.groupBy("search_location").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.countDistinct("user_id").alias("n_users"))


@register("u04_missing_users", """
SELECT user_id FROM fx_users WHERE user_id NOT IN (SELECT author_id FROM fx_tweets)""")
def u04_missing_users(spark, sf_dir):
    """Requested users (all accounts) whose posts were never collected."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    return dd.missing(users.select("user_id"), tweets.select(F.col("author_id").alias("user_id")))


@register("j01_attach_tweets", """
SELECT u.user_id, u.search_location, t.tweet_id, t.tweet_text, t.ord AS seq FROM fx_users u
LEFT JOIN fx_tweets t ON t.author_id = u.user_id""")
def j01_attach_tweets(spark, sf_dir):
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    out = en.attach_tweets(users.select("user_id", "search_location"),
                           tweets.select("author_id", "tweet_id", "tweet_text", "ord"))
    return out.select("user_id", "search_location", "tweet_id", "tweet_text", "seq")


@register("j02_attach_date", """
SELECT u.user_id, coalesce(d.last_date, '2025-02-01') AS tweet_date FROM fx_users u LEFT JOIN (
  SELECT author_id, arg_max(substr(CAST(created_on AS VARCHAR), 1, 10), ord) AS last_date FROM fx_tweets GROUP BY author_id) d
ON d.author_id = u.user_id""")
def j02_attach_date(spark, sf_dir):
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    return en.attach_date(users.select("user_id"), tweets, default="2025-02-01").select("user_id", "tweet_date")


@register("j03_attach_date_backfill", """
SELECT u.user_id, coalesce(d.last_date, CASE WHEN u.tweets_count > 2 THEN '2024-12-31' END) AS tweet_date
FROM fx_users u LEFT JOIN (
  SELECT author_id, arg_max(substr(CAST(created_on AS VARCHAR), 1, 10), ord) AS last_date FROM fx_tweets
  WHERE retweet_count > 0 GROUP BY author_id) d ON d.author_id = u.user_id""")
def j03_attach_date_backfill(spark, sf_dir):
    """Backfill from deduped posts (those with reposts) over users that may already hold a date."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    u = users.select("user_id", F.when(F.col("tweets_count") > 2, F.lit("2024-12-31")).alias("tweet_date"))
    return en.attach_date_backfill(u, tweets.filter("retweet_count > 0")).select("user_id", "tweet_date")


@register("j04_zip_batches", """
SELECT t.batch, t.n_posts, u.n_users FROM
  (SELECT retweet_count AS batch, count(*) AS n_posts FROM fx_tweets GROUP BY 1) t
JOIN (SELECT tweets_count AS batch, count(*) AS n_users FROM fx_users GROUP BY 1) u ON u.batch = t.batch""")
def j04_zip_batches(spark, sf_dir):
    """i-th post batch with i-th user batch (batch = position); unmatched batches drop."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    t = tweets.groupBy(F.col("retweet_count").alias("batch")).agg(F.count(F.lit(1)).alias("n_posts"))
    u = users.groupBy(F.col("tweets_count").alias("batch")).agg(F.count(F.lit(1)).alias("n_users"))
    return en.zip_batches(t, u, "batch")


@register("j04_zip_records", """
SELECT t.tweet_id, u.user_id AS author_id, u.username, u.ord % 3 AS batch FROM fx_tweets t
JOIN fx_users u ON u.user_id = t.author_id AND u.ord % 3 = t.ord % 5""")
def j04_zip_records(spark, sf_dir):
    """Five batches of posts with three of users: posts meet the users of the batch in the same place."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    t = tweets.select("tweet_id", "author_id", (F.col("ord") % 5).alias("batch"))
    return en.zip_batches(t, users.select("user_id", "username", (F.col("ord") % 3).alias("batch")), author="author_id")


@register("j05_unprocessed", """
SELECT user_id, search_location FROM fx_users WHERE user_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""")
def j05_unprocessed(spark, sf_dir):
    """Users not yet classified (classified ids = labelled doc ids)."""
    users, labels = tables(spark, sf_dir, "fx_users", "labels")
    done = labels.select(F.col("doc_id").cast("string").alias("user_id"))
    return en.unprocessed(users.select("user_id", "search_location"), done)


@register("j06_exists", """
SELECT user_id FROM fx_users WHERE user_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""")
def j06_exists(spark, sf_dir):
    """Users that already exist as vertices (vertex ids = supplier accounts)."""
    users, supplier = tables(spark, sf_dir, "fx_users", "supplier")
    v = supplier.select(F.col("s_suppkey").cast("string").alias("id"))
    return en.exists_in(users.select("user_id"), v)


@register("j09_cached_attributes", """
SELECT r.user_id, r.root_id, coalesce(CASE WHEN c.user_id IS NOT NULL THEN c.followers_count END, r.followers_count) AS followers_count
FROM (SELECT source AS user_id, target AS root_id, CAST(-1 AS BIGINT) AS followers_count FROM fx_interactions) r
LEFT JOIN (SELECT user_id, followers_count FROM fx_users WHERE tweets_count > 0) c ON c.user_id = r.user_id""")
def j09_cached_attributes(spark, sf_dir):
    """Nested followers replaced by their cached record where one exists."""
    users, inter = tables(spark, sf_dir, "fx_users", "fx_interactions")
    nested = inter.select(F.col("source").alias("user_id"), F.col("target").alias("root_id"),
                          F.lit(-1).cast("bigint").alias("followers_count"))
    cache = users.filter("tweets_count > 0").select("user_id", "followers_count")
    return en.with_cached_attributes(nested, cache)


@register("j11_edge_endpoints", """
SELECT source, target, ord, pos FROM fx_interactions
WHERE source IN (SELECT user_id FROM fx_users WHERE followers_count > 0)
  AND target IN (SELECT user_id FROM fx_users WHERE followers_count > 0)""")
def j11_edge_endpoints(spark, sf_dir):
    users, inter = tables(spark, sf_dir, "fx_users", "fx_interactions")
    v = users.filter("followers_count > 0").select("user_id")
    return en.edge_endpoints(inter.select("source", "target", "ord", "pos"), v)


@register("j12_attribute", """
SELECT max(search_location) AS search_location FROM fx_users WHERE user_id = '7'""")
def j12_attribute(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return en.attribute(users, "user_id", "7", "search_location")


@register("w04_recent_per_user", """
SELECT author_id, tweet_id FROM (
  SELECT t.author_id, t.tweet_id, u.tweets_count,
    row_number() OVER (PARTITION BY t.author_id ORDER BY t.ord DESC) AS rn
  FROM fx_tweets t JOIN fx_users u ON u.user_id = t.author_id) x WHERE rn <= least(tweets_count, 5)""")
def w04_recent_per_user(spark, sf_dir):
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    return en.recent_per_user(tweets.select("author_id", "tweet_id", "ord"), users).select("author_id", "tweet_id")
