"""Registered round trips of readers and sinks (S2, S3, S5-S7, S12, K2, K3, K5, K6, Q9) and the tables of jobs that have
several (L7, L11, L12). What is landed comes from the given tables, in pages of bounded size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import network as nw
from skein.plans import jobs
from skein.plans.q_network import _FOL_EDGES_SQL, _RT_EDGES_SQL, a10_network_medians, a11_query_shares, net_tables
from skein.plans.registry import load_sql, register, tables
from skein.plans.sqlbits import NET_CTES, match_expr
from skein.session import scratch_dir
from skein.sources import objects, readers, schemas, sinks
from skein.streaming import queues as qu

#: Records of a landed page.
PAGE = 1000


def _scratch(spark, name: str) -> str:
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _land(records: DataFrame, path: str, folders: list[str]) -> None:
    """Write ``folders``, ``ord``, ``element`` (JSON text) as JSON arrays, a file for each ``PAGE`` of ``ord`` in a folder."""
    records.groupBy(*folders, F.floor(F.col("ord") / PAGE).alias("page")) \
        .agg(F.array_sort(F.collect_list(F.struct("ord", "element"))).alias("r")) \
        .select(*folders, "page", F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["element"]), ",\n"), F.lit("]")).alias("value")) \
        .write.partitionBy(*folders, "page").text(path)


@register("s02_ragged_json", "SELECT user_id, username, description, followers_count, ord FROM fx_users")
def s02_ragged_json(spark, sf_dir):
    """Pages whose elements are records, arrays of records and junk: every record once, the junk dropped."""
    (users,) = tables(spark, sf_dir, "fx_users")
    path = _scratch(spark, "ragged")
    record = F.to_json(F.struct("user_id", "username", "description", "followers_count", "ord"))
    landed = users.withColumn("kind", F.col("ord") % 4).select("ord", F.when(
        F.col("kind") == 0, F.concat(F.lit("["), record, F.lit("]"))).when(
        F.col("kind") == 1, F.concat(F.lit('[], 7, "a, [b", null, '), record)).otherwise(record).alias("element"))
    pages = landed.groupBy(F.floor(F.col("ord") / PAGE).alias("page")).agg(F.collect_list("element").alias("r")) \
        .select("page", F.concat(F.lit("["), F.array_join("r", ", "), F.lit("]")).alias("value"))
    pages.write.partitionBy("page").text(path)
    got = readers.read_ragged_json(spark, path, "user_id STRING, username STRING, description STRING, followers_count BIGINT, ord BIGINT")
    return got.select("user_id", "username", "description", "followers_count", "ord")


def _root_documents(spark, sf_dir) -> str:
    """Root documents landed as JSON arrays, at most one of each root in a file; a root's posts lie in several documents
    of at most 100 posts."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    path = _scratch(spark, "roots")
    part = F.floor(F.col("ord") / F.lit(97 * 100))
    posts = tweets.groupBy(F.col("author_id").alias("user_id"), part.alias("part")).agg(F.array_sort(F.collect_list(F.struct(
        "ord", "tweet_id", "tweet_text", F.col("created_on").cast("string").alias("created_at"), "retweet_count"))).alias("t"))
    docs = posts.join(users.select("user_id", "username", "location", "search_location"), "user_id", "left")
    record = F.to_json(F.struct(
        "user_id", "username", F.col("location").alias("profile_location"), F.col("search_location").alias("target_location"),
        F.transform("t", lambda x: F.struct(x["tweet_id"].alias("tweet_id"), x["tweet_text"].alias("tweet_text"),
                                            x["created_at"].alias("created_at"), x["retweet_count"].alias("retweet_count"))).alias("tweets")))
    docs.groupBy("part").agg(F.collect_list(record).alias("r")).select(
        "part", F.concat(F.lit("["), F.array_join("r", ",\n"), F.lit("]")).alias("value")).write.partitionBy("part").text(path)
    return path


@register("s03_network_posts", f"""
WITH {NET_CTES} SELECT root_id, tweet_id, tweet_text, CAST(created_on AS VARCHAR) AS created_on, retweet_count FROM net_tweets""")
def s03_network_posts(spark, sf_dir):
    """Root documents read from their files (S3) and exploded: every post with its root."""
    flat = nw.explode_roots(readers.read_network(spark, _root_documents(spark, sf_dir)))
    return flat["root_tweets"].select("root_id", "tweet_id", "tweet_text", "created_on", "retweet_count")


def _named_pages(spark, sf_dir) -> str:
    """Users and lists of each city as files that tell city and kind by name, a page of ``PAGE`` records a file."""
    users, lists = tables(spark, sf_dir, "fx_users", "fx_lists")
    path = _scratch(spark, "cities")
    city = F.replace("search_location", F.lit(" "), F.lit("_"))
    record = F.to_json(F.struct("user_id", "username", "description", "followers_count"))
    kind = F.when(F.col("ord") % 5 == 0, "users_expanded_filtered").otherwise("users_filtered")
    named = users.select("ord", F.concat_ws("_", city, F.lit("media"), kind).alias("name"), record.alias("element")).unionByName(
        lists.select("ord", F.lit("kolkata_media_list").alias("name"), F.to_json(F.struct("user_id", F.col("name").alias("username"))).alias("element")))
    _land(named, path, ["name"])
    return path


@register("s05_city_files", """
SELECT 'users' AS kind, user_id, username, description, followers_count FROM fx_users
WHERE search_location = 'new york' AND ord % 5 <> 0
UNION ALL SELECT 'expanded', user_id, username, description, followers_count FROM fx_users
WHERE search_location = 'new york' AND ord % 5 = 0""")
def s05_city_files(spark, sf_dir):
    """A city's collected and expanded users, from files chosen by name (S5); files of other cities and kinds stay closed."""
    path = _named_pages(spark, sf_dir)
    ddl = "user_id STRING, username STRING, description STRING, followers_count BIGINT"
    kinds = [objects.read_city_files(spark, path, "new york", k, ddl, strict=True).withColumn("kind", F.lit(k))
             for k in ("users", "expanded")]
    return kinds[0].unionByName(kinds[1]).select("kind", "user_id", "username", "description", "followers_count")


@register("s06_dated", """
SELECT tweet_id, author_id, tweet_text, created_on AS run_date FROM fx_tweets WHERE created_on >= DATE '2025-01-10'""")
def s06_dated(spark, sf_dir):
    """Posts landed in a folder per date; those of some dates read back."""
    (tweets,) = tables(spark, sf_dir, "fx_tweets")
    path = _scratch(spark, "dated")
    _land(tweets.select("ord", F.col("created_on").alias("run_date"), F.to_json(F.struct("tweet_id", "author_id", "tweet_text"))
                        .alias("element")), path, ["run_date"])
    return readers.read_dated(spark, path, "tweet_id STRING, author_id STRING, tweet_text STRING", "run_date >= DATE '2025-01-10'")


@register("s07_csv_family", """
SELECT user_id, username, CASE WHEN search_location <> 'kolkata' THEN nullif(location, '') END AS location FROM fx_users WHERE ord % 5 <> 0""")
def s07_csv_family(spark, sf_dir):
    """Tabulated users of each city in folders by name, with and without a location column; the family of distinct users,
    without the expanded ones, united by header (S7)."""
    (users,) = tables(spark, sf_dir, "fx_users")
    path = _scratch(spark, "families")
    for family, rows in (("distinct_users", users.filter("ord % 5 <> 0")), ("distinct_users_expanded", users.filter("ord % 5 = 0"))):
        sinks.write_csv(rows.filter("search_location = 'kolkata'").select("user_id", "username"), f"{path}/{family}-kolkata")
        sinks.write_csv(rows.filter("search_location <> 'kolkata'").select("username", "location", "user_id"), f"{path}/{family}-others")
    files = objects.listing(spark, path)
    fits = F.contains("relative", F.lit("distinct_users")) & ~F.contains("relative", F.lit("expanded")) & F.endswith("name", F.lit(".csv"))
    return readers.read_csv(spark, objects.select_paths(files, fits, strict=True), "user_id STRING, username STRING, location STRING")


@register("s12_read_labelled", """
SELECT nullif(d.source, '') AS description, nullif(d.text, '') AS tweets, CAST(l.quality AS VARCHAR) AS label
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def s12_read_labelled(spark, sf_dir):
    """The labelled sheet with whole texts (line ends, quotes and commas inside), written as CSV and read back."""
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    path = _scratch(spark, "sheet")
    sinks.write_csv(docs.join(labels.select("doc_id", "quality"), "doc_id").select(
        F.col("quality").cast("string").alias("manual classification"), F.col("source").alias("description"), F.col("text").alias("tweets")), path)
    return readers.read_labelled(spark, path).select("description", "tweets", F.col("manual classification").alias("label"))


@register("k02_k03_append_overwrite", """
SELECT user_id, username, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT user_id, username FROM fx_users UNION ALL SELECT user_id, username FROM fx_users WHERE ord % 2 = 0) u GROUP BY 1, 2""")
def k02_k03_append_overwrite(spark, sf_dir):
    """A folder overwritten by all users (K3) and appended half of them again (K2, no dedupe)."""
    (users,) = tables(spark, sf_dir, "fx_users")
    path = _scratch(spark, "store")
    rows = users.select("user_id", "username")
    sinks.append(rows, path)
    sinks.overwrite(rows, path)
    sinks.append(rows.filter(F.col("user_id").cast("bigint") % 2 == 0), path)
    return spark.read.parquet(path).groupBy("user_id", "username").agg(F.count(F.lit(1)).alias("n"))


@register("k05_interactions", f"WITH {NET_CTES}, {_RT_EDGES_SQL} SELECT source, source_username, source_followers, tweet_id, target, target_username FROM rt_edges")
def k05_interactions(spark, sf_dir):
    """Edge records written as JSON lines (K5) and read back with the declared schema."""
    roots, root_tweets, retweeters, _ = net_tables(spark, sf_dir, need=("retweeters",))
    path = _scratch(spark, "edges")
    sinks.write_interactions(nw.retweet_edges(roots, root_tweets, retweeters), path)
    return spark.read.schema(schemas.INTERACTION).json(path).select(
        "source", "source_username", "source_followers", "tweet_id", "target", "target_username")


@register("k06_records_json", "SELECT tweet_id, author_id, tweet_text, lang, retweet_count FROM fx_tweets")
def k06_records_json(spark, sf_dir):
    """Posts with whole texts written as JSON records (K6) and read back."""
    (tweets,) = tables(spark, sf_dir, "fx_tweets")
    path = _scratch(spark, "records")
    kind = dict(tweets.dtypes)["retweet_count"]
    sinks.write_records_json(tweets.select("tweet_id", "author_id", "tweet_text", "lang", "retweet_count"), path)
    return spark.read.schema(f"tweet_id STRING, author_id STRING, tweet_text STRING, lang STRING, retweet_count {kind}").json(path)


@register("q09_message_topics", """
SELECT topic, user_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(seq) AS BIGINT) AS seqs FROM fx_queue GROUP BY 1, 2""")
def q09_message_topics(spark, sf_dir):
    """Landed messages streamed (S9) into files per topic, those of a user together (Q9), and read back."""
    (queue,) = tables(spark, sf_dir, "fx_queue")
    base = _scratch(spark, "topics")
    queue.select("user_id", "topic", "seq").write.json(f"{base}/landing")
    stream = qu.read_queue(spark, f"{base}/landing", "user_id STRING, topic STRING, seq BIGINT")
    qu.run_available(qu.write_messages(stream, f"{base}/out", f"{base}/progress", "topic", "user_id"))
    sent = spark.read.schema("user_id STRING, seq BIGINT, topic STRING").json(f"{base}/out")
    return sent.groupBy("topic", "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs"))


@register("q03_vertex_records", f"""
WITH {NET_CTES},
f AS (SELECT user_id, username, profile_location, target_location, followers_count FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY root_id, ord, pos) AS rn FROM net_fol) x
  WHERE rn = 1 AND user_id NOT IN (SELECT user_id FROM net_roots))
SELECT user_id, username, profile_location, target_location, followers_count, tweets_count, city FROM net_roots
UNION ALL SELECT user_id, username, profile_location, target_location, followers_count, NULL, NULL FROM f""")
def q03_vertex_records(spark, sf_dir):
    """The vertex store after processing follower pages, with the vertices' fields."""
    from skein.plans.q_queue import _processed_followers
    return _processed_followers(spark, sf_dir)["vertices"].select(
        "user_id", "username", "profile_location", "target_location", "followers_count", "tweets_count", "city")


@register("l07_analysis_matches", f"""
SELECT user_id, search_location, {match_expr('location', 'search_location')} AS location_match FROM fx_users""")
def l07_analysis_matches(spark, sf_dir):
    """The analysis job's table of users with their match."""
    (users,) = tables(spark, sf_dir, "fx_users")
    return jobs.analysis(users, users, ["BUILDING"])["location_matches"].select("user_id", "search_location", "location_match")


def _statistics(spark, sf_dir) -> dict[str, DataFrame]:
    return jobs.edges_and_stats(*net_tables(spark, sf_dir))


@register("l12_follower_edges", f"WITH {NET_CTES}, {_FOL_EDGES_SQL} SELECT * FROM fol_edges")
def l12_follower_edges(spark, sf_dir):
    """The statistics job's edge file of followers."""
    return _statistics(spark, sf_dir)["follower_edges"]


@register("l12_retweet_edges", f"WITH {NET_CTES}, {_RT_EDGES_SQL} SELECT * FROM rt_edges")
def l12_retweet_edges(spark, sf_dir):
    """The statistics job's edge file of reposts."""
    return _statistics(spark, sf_dir)["retweet_edges"]


@register("l12_medians", load_sql(a10_network_medians.__name__))
def l12_medians(spark, sf_dir):
    """The statistics job's medians."""
    return _statistics(spark, sf_dir)["medians"]


@register("l12_query_shares", load_sql(a11_query_shares.__name__))
def l12_query_shares(spark, sf_dir):
    """The statistics job's shares of reposts and originals."""
    return _statistics(spark, sf_dir)["query_shares"]


@register("l11_user_catalogue", load_sql("j13_user_catalog"))
def l11_user_catalogue(spark, sf_dir):
    """The catalogue job: every user of the network once, minus those stored."""
    roots, _, retweeters, followers = net_tables(spark, sf_dir)
    (labels,) = tables(spark, sf_dir, "labels")
    return jobs.user_catalogue(roots, retweeters, followers, labels.select(F.col("doc_id").cast("string").alias("user_id")))
