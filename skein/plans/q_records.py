"""Queries for landed record shapes, files and row gates."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skein.functions import predicates as pr
from skein.functions import text as tx
from skein.operators import analysis as an
from skein.operators import dedupe as dd
from skein.operators import export as ex
from skein.operators import normalize as nm
from skein.operators.upsert import city_must_exist
from skein.plans.registry import register, tables
from skein.plans.sqlbits import match_expr
from skein.session import scratch_dir

_AT = "T10:20:30+00:00"


def _posted(day):
    """A date as a post-style time."""
    return F.concat(F.date_format(day, "EEE MMM dd"), F.lit(" 10:20:30 +0000 "), F.date_format(day, "yyyy"))


_TWEET_NULLS = ["conversation_id", "geo", "possibly_sensitive", "reply_settings", "attachments", "context_annotations",
                "entities", "public_metrics", "non_public_metrics", "organic_metrics", "promoted_metrics", "withheld"]


@register("p01_normalize_tweets_full", f"""
SELECT CAST(doc_id AS VARCHAR) AS tweet_id, text, CAST(doc_id % 97 AS VARCHAR) AS author_id,
  CASE WHEN doc_id % 9 <> 0 THEN CAST(DATE '2025-01-01' + CAST(doc_id % 28 AS INT) AS VARCHAR) || '{_AT}' END AS created_at,
  lang, source, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id % 13 AS VARCHAR) END AS in_reply_to_user_id,
  {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _TWEET_NULLS)}
FROM documents""")
def p01_normalize_tweets_full(spark, sf_dir):
    """Landed posts (ISO, post-style or unreadable times; most optional fields missing) to 19 fields."""
    (docs,) = tables(spark, sf_dir, "documents")
    day = F.expr("DATE '2025-01-01' + CAST(doc_id % 28 AS INT)")
    raw = docs.select(
        F.col("doc_id").cast("string").alias("id"), "text", (F.col("doc_id") % 97).cast("string").alias("author_id"),
        F.when(F.col("doc_id") % 9 == 0, F.lit("no time")).when(F.col("doc_id") % 2 == 0, _posted(day))
        .otherwise(F.concat(day.cast("string"), F.lit("T10:20:30Z"))).alias("created_at"), "lang", "source",
        F.when(F.col("doc_id") % 4 == 0, (F.col("doc_id") % 13).cast("string")).alias("in_reply_to_user_id"))
    return nm.normalize_tweets_full(raw)


@register("p02_normalize_users_search", """
SELECT user_id, username, description, location, name, 'https://x/' || username AS url, CAST(0 AS BIGINT) AS n_tweets,
  CAST(0 AS BIGINT) AS n_geo, followers_count, following_count, tweets_count AS tweet_count, ord AS listed_count FROM fx_users""")
def p02_normalize_users_search(spark, sf_dir):
    """Search results with nested metrics to flat user records with empty posts and place."""
    (users,) = tables(spark, sf_dir, "fx_users")
    raw = users.select(F.col("user_id").alias("id"), "username", "description", "location", "name",
                       F.concat(F.lit("https://x/"), "username").alias("url"),
                       F.struct("followers_count", "following_count", F.col("tweets_count").alias("tweet_count"),
                                F.col("ord").alias("listed_count")).alias("public_metrics"))
    out = nm.normalize_users_search(raw)
    return out.withColumns({"n_tweets": F.size("tweets").cast("bigint"), "n_geo": F.size("geo_code").cast("bigint")}) \
        .drop("tweets", "geo_code")


@register("p03_explode_lists", """
SELECT user_id, list_id, name, '2020-01-01' AS created_at, description, ord AS follower_count, ord % 5 AS member_count,
  ord % 2 = 0 AS private, user_id AS owner_id FROM fx_lists""")
def p03_explode_lists(spark, sf_dir):
    """One record per user holding its lists -> one row per list."""
    (lists,) = tables(spark, sf_dir, "fx_lists")
    landed = lists.groupBy("user_id").agg(F.collect_list(F.struct(
        F.col("list_id").alias("id"), "name", F.lit("2020-01-01").alias("created_at"), "description",
        F.col("ord").alias("follower_count"), (F.col("ord") % 5).alias("member_count"),
        (F.col("ord") % 2 == 0).alias("private"), F.col("user_id").alias("owner_id"))).alias("lists"))
    return nm.explode_lists(landed)


def _scraped(spark, sf_dir):
    tweets, users = tables(spark, sf_dir, "fx_tweets", "fx_users")
    u = users.select(F.col("user_id").alias("author_id"), F.struct(
        F.col("user_id").alias("id"), "name", "description", "location", F.col("username").alias("screen_name"),
        F.concat(F.lit("https://x/"), "username").alias("url"), F.col("followers_count").cast("string").alias("followers_count"),
        "following_count").alias("user"))
    posts = tweets.select("tweet_id", F.col("tweet_text").alias("text"), _posted(F.col("created_on")).alias("created_at"), "author_id")
    return posts.join(u, "author_id").drop("author_id")


@register("p04_scraped_posts", """
SELECT t.tweet_id, t.tweet_text AS text, strftime(t.created_on, '%a %b %d') || ' 10:20:30 +0000 ' || strftime(t.created_on, '%Y') AS created_at,
  t.author_id FROM fx_tweets t JOIN fx_users u ON u.user_id = t.author_id""")
def p04_scraped_posts(spark, sf_dir):
    return nm.split_scraped(_scraped(spark, sf_dir))[0]


@register("p04_scraped_users", """
SELECT u.user_id, u.name AS username, u.description, u.location, u.username AS name, 'https://x/' || u.username AS url,
  u.followers_count, u.following_count, t.tweet_text AS tweet, CAST(t.created_on AS VARCHAR) AS tweet_date,
  u.user_id || '-' || CAST(t.created_on AS VARCHAR) AS user_date_id
FROM fx_tweets t JOIN fx_users u ON u.user_id = t.author_id""")
def p04_scraped_users(spark, sf_dir):
    return nm.split_scraped(_scraped(spark, sf_dir))[1].withColumn("tweet", F.get("tweets", F.lit(0))).drop("tweets")


def _judged_lists(spark, sf_dir):
    (lists,) = tables(spark, sf_dir, "fx_lists")
    return lists.select("user_id", "list_id", "name", F.when(F.col("ord") % 3 != 0, F.col("ord") % 3 == 1).alias("relevant"))


@register("p10_conform_lists", """
SELECT user_id, list_id, name, CASE WHEN ord % 3 <> 0 THEN ord % 3 = 1 END AS relevant, 'kolkata' AS search_location
FROM fx_lists WHERE ord % 3 <> 0
UNION ALL SELECT user_id, list_id, name, CASE WHEN ord % 3 <> 0 THEN ord % 3 = 1 END, 'manually_added' FROM fx_lists""")
def p10_conform_lists(spark, sf_dir):
    """Judged lists of a city, and all lists of the manually added ones."""
    lists = _judged_lists(spark, sf_dir)
    return nm.conform_lists(lists, F.lit("kolkata")).unionByName(
        nm.conform_lists(lists, F.lit("manually_added"), manually_added=True))


@register("p11_classification_text", """
SELECT user_id, coalesce(description, '') || ' ' || CASE WHEN ord % 4 = 0 THEN '' WHEN ord % 4 = 1 THEN username
  ELSE username || ' ' || name END AS text FROM fx_users""")
def p11_classification_text(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    posts = F.when(F.col("ord") % 4 == 0, F.lit(None)).when(F.col("ord") % 4 == 1, F.array("username")) \
        .otherwise(F.array("username", "name"))
    return users.select("user_id", tx.classification_text(F.col("description"), posts).alias("text"))


@register("p23_geo_placeholder", """
SELECT user_id, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lng, false AS missing FROM fx_users""")
def p23_geo_placeholder(spark, sf_dir):
    """The place is there (not missing) and holds no coordinates."""
    (users,) = tables(spark, sf_dir, "fx_users")
    out = nm.geo_placeholder(users.select("user_id"))
    return out.select("user_id", "geo_location.lat", "geo_location.lng", F.col("geo_location").isNull().alias("missing"))


@register("f04_is_original_api", """
SELECT tweet_id, ord % 5 <> 0 AS original FROM fx_tweets""")
def f04_is_original_api(spark, sf_dir):
    """References of landed posts: reposts among others, quotes, none at all."""
    (tweets,) = tables(spark, sf_dir, "fx_tweets")
    ref = lambda kind: F.struct(F.lit(kind).alias("type"), F.lit("1").alias("id"))
    refs = F.when(F.col("ord") % 5 == 0, F.array(ref("quoted"), ref("retweeted"))).when(
        F.col("ord") % 5 == 1, F.array(ref("replied_to"))).when(F.col("ord") % 5 == 2, F.filter(F.array(ref("x")), lambda r: F.lit(False)))
    return tweets.select("tweet_id", pr.is_original_api(refs).alias("original"))


@register("f17_row_shape_gate", """
SELECT user_id, description IS NOT NULL AND location IS NOT NULL AS accepted FROM fx_users""")
def f17_row_shape_gate(spark, sf_dir):
    """Export records (null fields are left out of them) against the header: accepted and rejected ones."""
    (users,) = tables(spark, sf_dir, "fx_users")
    records = users.select(F.to_json(F.struct("user_id", "description", "location")).alias("record"))
    ok, rejected = ex.conform_to_header(records, "record", ["user_id", "location", "description"])
    key = F.get_json_object("record", "$.user_id").alias("user_id")
    return ok.select(key, F.lit(True).alias("accepted")).unionAll(rejected.select(key, F.lit(False)))


@register("f19_city_must_exist", f"""
SELECT user_id, search_location FROM fx_users WHERE search_location = 'kolkata' AND {match_expr('location', 'search_location')}""")
def f19_city_must_exist(spark, sf_dir):
    """Users of a city, dispatched only after its vertex was found."""
    (users,) = tables(spark, sf_dir, "fx_users")
    cities = users.select(F.col("search_location").alias("id"), F.lit("City").alias("label")).distinct()
    city_must_exist(cities, "kolkata")
    return an.matched_city_users(users, "kolkata")


@register("u03_classified_union", """
SELECT CAST(doc_id AS VARCHAR) AS user_id, quality = 1 AS content_is_relevant, CAST(NULL AS VARCHAR) AS content_labels FROM labels
UNION ALL SELECT user_id, content_labels IS NOT NULL, content_labels FROM fx_users""")
def u03_classified_union(spark, sf_dir):
    """Earlier classifications (without labels) ++ new ones."""
    users, labels = tables(spark, sf_dir, "fx_users", "labels")
    before = labels.select(F.col("doc_id").cast("string").alias("user_id"), (F.col("quality") == 1).alias("content_is_relevant"))
    return dd.classified_union(before, users.select("user_id", "content_labels",
                                                    F.col("content_labels").isNotNull().alias("content_is_relevant")))


@register("w07_train_test_split", """
SELECT doc_id, CASE WHEN CAST('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 2000
  THEN 'test' ELSE 'train' END AS part FROM documents""")
def w07_train_test_split(spark, sf_dir):
    (docs,) = tables(spark, sf_dir, "documents")
    train, test = an.train_test_split(docs.select("doc_id"), 0.2, 42)
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


@register("s04_two_headers", """
SELECT user_id, username, CASE WHEN search_location = 'kolkata' THEN followers_count END AS followers_count FROM fx_users""")
def s04_two_headers(spark, sf_dir):
    """One folder with CSV files of two headers (other order, a column less) read by column name."""
    from skein.sources.readers import read_csv
    (users,) = tables(spark, sf_dir, "fx_users")
    path = scratch_dir(spark, f"csv-{uuid.uuid4().hex[:12]}")
    here = F.col("search_location") == "kolkata"
    users.filter(here).select("user_id", "username", "followers_count").write.option("header", True).csv(path)
    users.filter(~here).select("username", "user_id").write.mode("append").option("header", True).csv(path)
    return read_csv(spark, path, "user_id STRING, username STRING, followers_count BIGINT")


@register("k07_s08_roundtrip", """
SELECT u.search_location AS location, t.author_id AS user_id, 'tweet_' || t.tweet_id AS name, t.tweet_text AS value
FROM fx_tweets t JOIN fx_users u ON u.user_id = t.author_id""")
def k07_s08_roundtrip(spark, sf_dir):
    """Posts written as text objects (line ends, quotes and other scripts included) and read back."""
    from skein.sources.readers import read_text_objects
    from skein.sources.sinks import write_text_objects
    tweets, users = tables(spark, sf_dir, "fx_tweets", "fx_users")
    objects = tweets.join(users.select(F.col("user_id").alias("author_id"), F.col("search_location").alias("location")), "author_id") \
        .select("location", F.col("author_id").alias("user_id"), F.concat(F.lit("tweet_"), "tweet_id").alias("name"),
                F.col("tweet_text").alias("value"))
    path = scratch_dir(spark, f"objects-{uuid.uuid4().hex[:12]}")
    write_text_objects(objects, path)
    return read_text_objects(spark, path)


@register("k07_object_files", """
SELECT u.search_location AS location, t.author_id AS user_id, 'tweet_' || t.tweet_id AS name, t.tweet_text AS value
FROM fx_tweets t JOIN fx_users u ON u.user_id = t.author_id
UNION ALL SELECT search_location, user_id, 'description', coalesce(description, '') FROM fx_users""")
def k07_object_files(spark, sf_dir):
    """Descriptions and posts written as one ``.txt`` each in the layout that other programs read (K7), read back through the
    text branch of S8."""
    from skein.sources.objects import write_object_files
    from skein.sources.readers import read_text_objects
    tweets, users = tables(spark, sf_dir, "fx_tweets", "fx_users")
    who = users.select(F.col("user_id").alias("author_id"), F.col("search_location").alias("location"))
    posts = tweets.join(who, "author_id").select("location", F.col("author_id").alias("user_id"),
                                                 F.concat(F.lit("tweet_"), "tweet_id").alias("name"), F.col("tweet_text").alias("value"))
    bios = users.select(F.col("search_location").alias("location"), "user_id", F.lit("description").alias("name"),
                        F.coalesce("description", F.lit("")).alias("value"))
    path = scratch_dir(spark, f"networks-{uuid.uuid4().hex[:12]}")
    write_object_files(posts.unionByName(bios), path)
    return read_text_objects(spark, path)


@register("k10_second_sync", """
SELECT search_location || '/part.csv' AS relative, TRUE AS first_copied, FALSE AS second_copied FROM fx_users GROUP BY 1""")
def k10_second_sync(spark, sf_dir):
    """A tree of users by city synchronised twice: the first run copies every file, the second none."""
    from skein.sources import objects as ob
    (users,) = tables(spark, sf_dir, "fx_users")
    base = scratch_dir(spark, f"sync-{uuid.uuid4().hex[:12]}")
    users.select("search_location", "user_id", "username").repartition("search_location") \
        .write.partitionBy("search_location").option("header", True).csv(f"{base}/source")
    first = ob.sync_directory(spark, f"{base}/source", f"{base}/target")
    second = ob.sync_directory(spark, f"{base}/source", f"{base}/target")
    city = F.url_decode(F.regexp_extract("relative", "search_location=([^/]+)/", 1))
    there = ob.listing(spark, f"{base}/target").join(first.select("relative", F.lit(True).alias("f")), "relative", "left") \
        .join(second.select("relative", F.lit(True).alias("s")), "relative", "left")
    return there.select(F.concat(city, F.lit("/part.csv")).alias("relative"), F.coalesce("f", F.lit(False)).alias("first_copied"),
                        F.coalesce("s", F.lit(False)).alias("second_copied"))
