"""Registered end-to-end jobs (L2, L4, L9, L10, L11, L13) over the fixture views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skein.fixtures import KEYWORDS
from skein.functions import dims
from skein.plans import jobs
from skein.plans.q_classify import _score_sql
from skein.plans.q_graph import PAGERANK_ITERATIONS, interaction_edges, pagerank_sql
from skein.plans.q_network import _RT_EDGES_SQL, _STATS_SQL, net_tables
from skein.plans.registry import register, tables
from skein.plans.sqlbits import NET_CTES, in_list, match_expr, words_expr
from skein.session import scratch_dir


def _matrix(spark, sf_dir):
    users, tweets, labels = tables(spark, sf_dir, "fx_users", "fx_tweets", "labels")
    prev = labels.select(F.col("doc_id").cast("string").alias("user_id"), F.lit("other").alias("content_labels"),
                         F.lit(False).alias("content_is_relevant"))
    return jobs.run_matrix(users, tweets, prev, 50, KEYWORDS, skip=["BUILDING"])


@register("l02_run_matrix_budgets", """
WITH g AS (SELECT DISTINCT search_account_type FROM fx_users WHERE search_account_type NOT IN ('BUILDING')),
n AS (SELECT count(*) AS n FROM g),
r AS (SELECT search_account_type, row_number() OVER (ORDER BY search_account_type) AS rn FROM g)
SELECT search_account_type, CAST(CASE WHEN rn = n THEN floor(50 / n) + 50 % n ELSE floor(50 / n) END AS BIGINT) AS budget
FROM r, n""")
def l02_run_matrix_budgets(spark, sf_dir):
    """City x type run with one type skipped: the per-type request budgets."""
    return _matrix(spark, sf_dir)["budgets"]


@register("l02_run_matrix_table", f"""
WITH prev AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS user_id FROM labels),
u AS (SELECT * FROM fx_users WHERE search_account_type <> 'BUILDING'),
todo AS (SELECT user_id, description FROM u WHERE user_id NOT IN (SELECT user_id FROM prev)),
{_score_sql('todo')}
SELECT u.user_id, u.search_location, u.search_account_type, 'https://twitter.com/' || u.username AS user_url,
  coalesce(lab.content_labels, 'other') AS content_labels, coalesce(lab.content_labels, 'other') <> 'other' AS content_is_relevant,
  false AS list_expansion
FROM u LEFT JOIN lab ON lab.user_id = u.user_id""")
def l02_run_matrix_table(spark, sf_dir):
    """City x type run: the tabulated, classified accounts."""
    return _matrix(spark, sf_dir)["table"].select("user_id", "search_location", "search_account_type", "user_url",
                                                  "content_labels", "content_is_relevant", "list_expansion")


@register("l04_reclassify_table", f"""
WITH todo AS (SELECT user_id, description FROM fx_users), {_score_sql('todo')}
SELECT u.user_id, u.search_location, 'https://twitter.com/' || u.username AS user_url, lab.content_labels,
  lab.content_labels <> 'other' AS content_is_relevant
FROM fx_users u JOIN lab ON lab.user_id = u.user_id""")
def l04_reclassify_table(spark, sf_dir):
    """Reclassify every account and tabulate it (one row per user with its URL and new label)."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    out = jobs.reclassify(users.select("user_id", "username", "name", "description", "location", "followers_count",
                                       "following_count", "search_account_type", "search_location", "ord"), tweets, KEYWORDS)
    return out.select("user_id", "search_location", "user_url", "content_labels", "content_is_relevant")


@register("l05_tabulate_city", """
SELECT user_id, username, name, description, location, followers_count, following_count, content_labels,
  content_labels <> 'BUILDING' AS content_is_relevant, search_account_type, search_location,
  'https://twitter.com/' || username AS user_url, true AS list_expansion
FROM fx_users WHERE content_labels IS NOT NULL""")
def l05_tabulate_city(spark, sf_dir):
    """Accounts landed twice (the later records differ) conformed and reduced to one row per user;
    those without a relevance are dropped."""
    (users,) = tables(spark, sf_dir, "fx_users")
    u = users.withColumn("content_is_relevant", F.col("content_labels") != "BUILDING")
    later = u.withColumns({"name": F.lit("later"), "followers_count": F.lit(0).cast("bigint"), "ord": F.col("ord") + (1 << 40)})
    out = jobs.tabulate_city(u.unionByName(later), list_expansion=True)
    return out.select("user_id", "username", "name", "description", "location", "followers_count", "following_count",
                      "content_labels", "content_is_relevant", "search_account_type", "search_location", "user_url",
                      "list_expansion")


@register("l06_master_dataset", """
WITH a AS (SELECT user_id, username, CAST(NULL AS VARCHAR) AS location, 'distinct' AS family FROM fx_users WHERE search_location = 'kolkata'
  UNION ALL SELECT user_id, username, location, 'distinct' FROM fx_users WHERE search_location <> 'kolkata'),
b AS (SELECT user_id, CAST(NULL AS VARCHAR) AS username, location, 'expanded' AS family FROM fx_users WHERE tweets_count < 2
  UNION ALL SELECT user_id, username, location, 'expanded' FROM fx_users WHERE tweets_count >= 2)
SELECT * FROM a UNION ALL SELECT * FROM b""")
def l06_master_dataset(spark, sf_dir):
    """Files of two families with different columns united, then distinct ++ expanded users."""
    (users,) = tables(spark, sf_dir, "fx_users")
    d = users.withColumn("family", F.lit("distinct"))
    e = users.withColumn("family", F.lit("expanded"))
    return jobs.master_dataset(
        [d.filter("search_location = 'kolkata'").select("user_id", "username", "family"),
         d.filter("search_location <> 'kolkata'").select("location", "user_id", "username", "family")],
        [e.filter("tweets_count < 2").select("user_id", "location", "family"),
         e.filter("tweets_count >= 2").select("user_id", "username", "location", "family")])


@register("l07_analysis_locations", f"""
WITH m AS (SELECT user_id, search_location, {match_expr('location', 'search_location')} AS hit FROM fx_users),
c AS (SELECT search_location AS location, nullif(sum(CASE WHEN hit THEN 0 ELSE 1 END), 0) AS f,
  nullif(sum(CASE WHEN hit THEN 1 ELSE 0 END), 0) AS t FROM m GROUP BY 1)
SELECT location, CAST(f AS BIGINT) AS n_false, CAST(t AS BIGINT) AS n_true, CAST(t + f AS BIGINT) AS total,
  round(CAST(t AS DOUBLE) / (t + f), 2) AS match_percentage FROM c""")
def l07_analysis_locations(spark, sf_dir):
    """The analysis job's location table."""
    (users,) = tables(spark, sf_dir, "fx_users")
    return jobs.analysis(users, users, ["BUILDING"])["location_matches_counts"]


@register("l08_extra_tweets", """
SELECT DISTINCT tweet_id, author_id, tweet_text FROM (
  SELECT t.*, u.tweets_count, row_number() OVER (PARTITION BY t.author_id ORDER BY t.ord DESC) AS rn
  FROM fx_tweets t JOIN fx_users u ON u.user_id = t.author_id) x WHERE rn <= least(tweets_count, 5)""")
def l08_extra_tweets(spark, sf_dir):
    """The latest posts of each user (as many as it has, five at most), appended to a store that
    holds some of them already."""
    from skein.sources.sinks import append_distinct, read_distinct
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    got = jobs.extra_tweets(tweets, users).select("tweet_id", "author_id", "tweet_text")
    path = scratch_dir(spark, f"extra-{uuid.uuid4().hex[:12]}")
    append_distinct(got.filter("cast(tweet_id AS bigint) % 3 = 0"), path)
    append_distinct(got, path)
    return read_distinct(spark, path)


@register("l09_root_network_todo", f"""
SELECT DISTINCT user_id, search_location FROM fx_users
WHERE {match_expr('location', 'search_location')}
  AND user_id NOT IN (SELECT DISTINCT author_id FROM fx_tweets)""")
def l09_root_network_todo(spark, sf_dir):
    """Matched city users whose root documents were not built yet (built = has collected posts)."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    done = tweets.select(F.col("author_id").alias("user_id")).distinct()
    return jobs.root_network(users, done, {})["todo"]


def _built(spark, sf_dir):
    """Root network of users not built yet (built = collected posts with an even day), from two
    landed runs of post and follower pages: the second run's post pages carry fresher repost counts."""
    users, tweets, inter = tables(spark, sf_dir, "fx_users", "fx_tweets", "fx_interactions")
    done = tweets.filter("ord % 4 = 0").select(F.col("author_id").alias("user_id")).distinct()
    posts = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text", "created_on", "retweet_count",
                          F.lit(0).alias("page"), F.col("ord").alias("pos"))
    fresher = posts.filter("pos % 2 = 0").withColumns({"page": F.lit(1), "retweet_count": F.col("retweet_count") + 10})
    people = users.select("user_id", "username", "description", "location", "followers_count", "following_count", "tweets_count")
    followers = inter.select(F.col("target").alias("root_id"), F.col("source").alias("user_id"), F.lit(0).alias("page"),
                             (F.col("ord") * 10 + F.col("pos")).alias("pos")).join(people, "user_id")
    return jobs.root_network(users, done, {"tweets": [posts, fresher], "followers": [followers]})


_TODO_SQL = f"""
todo AS (SELECT DISTINCT user_id, search_location FROM fx_users WHERE {match_expr('location', 'search_location')}
  AND user_id NOT IN (SELECT author_id FROM fx_tweets WHERE ord % 4 = 0))"""


@register("l09_root_network_posts", f"""
WITH {_TODO_SQL}
SELECT t.author_id AS root_id, t.tweet_id, t.tweet_text, t.created_on AS created_at,
  CAST(coalesce(t.retweet_count + CASE WHEN t.ord % 2 = 0 THEN 10 ELSE 0 END, 0) AS BIGINT) AS retweet_count,
  CAST(0 AS BIGINT) AS favorite_count
FROM fx_tweets t JOIN todo ON todo.user_id = t.author_id""")
def l09_root_network_posts(spark, sf_dir):
    """Posts of the roots to build, landed pages merged (S11), in the P6 shape."""
    return _built(spark, sf_dir)["tweets"]


@register("l09_root_network_followers", f"""
WITH {_TODO_SQL},
f AS (SELECT DISTINCT i.target AS root_id, i.source AS user_id, todo.search_location AS sl
  FROM fx_interactions i JOIN todo ON todo.user_id = i.target)
SELECT f.root_id, f.user_id, u.username, f.sl AS target_location, u.location AS profile_location,
  coalesce(u.followers_count, -99) AS followers_count, 'pending' AS follower_status,
  CASE WHEN {match_expr('u.location', 'f.sl')} THEN f.sl END AS city
FROM f JOIN fx_users u ON u.user_id = f.user_id""")
def l09_root_network_followers(spark, sf_dir):
    """Followers of the roots to build, once per root, in the P5 shape."""
    return _built(spark, sf_dir)["followers"].select("root_id", "user_id", "username", "target_location", "profile_location",
                                                     "followers_count", "follower_status", "city")


@register("l12_edges_and_stats", f"WITH {_STATS_SQL} SELECT * FROM stats2")
def l12_edges_and_stats(spark, sf_dir):
    """Both edge sets and the per-root coverage figures of the statistics job."""
    return jobs.edges_and_stats(*net_tables(spark, sf_dir))["stats"]


@register("l17_pending_texts", f"""
WITH {NET_CTES}
SELECT user_id, 'description' AS name, coalesce(description, '') AS value FROM fx_users WHERE followers_count IS NOT NULL
UNION ALL SELECT root_id, 'tweet_' || tweet_id, tweet_text FROM net_tweets WHERE coalesce(tweet_text NOT LIKE 'RT @%', true)""")
def l17_pending_texts(spark, sf_dir):
    """Text objects of users with attributes, written in the object layout (K7) and read back."""
    from skein.sources.readers import read_text_objects
    from skein.sources.sinks import write_text_objects
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    posts = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text")
    path = scratch_dir(spark, f"objects-{uuid.uuid4().hex[:12]}")
    write_text_objects(jobs.pending_texts(users, posts).withColumn("location", F.lit("kolkata")), path)
    return read_text_objects(spark, path).select("user_id", "name", "value")


@register("l10_attribute_backfill", """
SELECT i.source AS user_id, i.target AS root_id,
  CASE WHEN c.user_id IS NOT NULL THEN c.followers_count ELSE CAST(-1 AS BIGINT) END AS followers_count,
  'pending' AS retweeter_status, 'pending' AS follower_status
FROM fx_interactions i LEFT JOIN (SELECT user_id, followers_count FROM fx_users WHERE tweets_count > 0) c
  ON c.user_id = i.source""")
def l10_attribute_backfill(spark, sf_dir):
    """Followers replaced by cached attributes, statuses reset to pending."""
    users, inter = tables(spark, sf_dir, "fx_users", "fx_interactions")
    nested = inter.select(F.col("source").alias("user_id"), F.col("target").alias("root_id"),
                          F.lit(-1).cast("bigint").alias("followers_count"))
    cache = users.filter("tweets_count > 0").select("user_id", "followers_count")
    return jobs.attribute_backfill(nested, cache).select("user_id", "root_id", "followers_count",
                                                         "retweeter_status", "follower_status")


@register("l13_graph_report_counts", """
WITH e AS (SELECT DISTINCT source AS src, target AS dst FROM fx_interactions),
v AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
c AS (SELECT (SELECT count(*) FROM v) AS nodes, (SELECT count(*) FROM e) AS edges)
SELECT nodes, edges, CASE WHEN nodes < 2 THEN 0.0 ELSE CAST(edges AS DOUBLE) / (nodes * (nodes - 1)) END AS density,
  CAST(2 * edges AS DOUBLE) / nullif(nodes, 0) AS average_degree FROM c""")
def l13_graph_report_counts(spark, sf_dir):
    """Graph report of the follower network: counts, density, average degree."""
    return jobs.graph_report(interaction_edges(spark, sf_dir), "follow", fixed_iterations=1)["counts"]


@register("l13_graph_report", pagerank_sql().rsplit("\nSELECT", 1)[0] + f""",
de AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) x GROUP BY id),
top AS (SELECT id FROM r{PAGERANK_ITERATIONS} ORDER BY rank DESC, id ASC LIMIT 3)
SELECT r.id, de.degree, round(r.rank, 8) AS rank, top.id IS NOT NULL AS in_top, u.username
FROM r{PAGERANK_ITERATIONS} r JOIN de ON de.id = r.id LEFT JOIN top ON top.id = r.id LEFT JOIN fx_users u ON u.user_id = r.id""")
def l13_graph_report(spark, sf_dir):
    """Graph report of the repost network: every account's degree, rank and place among the top."""
    out = jobs.graph_report(interaction_edges(spark, sf_dir), "retweet", fixed_iterations=PAGERANK_ITERATIONS)
    top = out["top"].select("id", F.lit(True).alias("__top"))
    return (out["pagerank"].join(out["degree"], "id").join(out["vertices"].select("id", "username"), "id", "left")
            .join(top, "id", "left")
            .select("id", "degree", F.round("rank", 8).alias("rank"), F.col("__top").isNotNull().alias("in_top"), "username"))


_TYPE_SQL = f"{list(dims.ACCOUNT_TYPES)}[CAST(ord % 7 AS INT) + 1]"
DEFAULT_DATE = "2025-03-01"


def _search_pages(spark, sf_dir):
    """Accounts and posts as landed search pages: raw records per city and type, ten pages of accounts."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    kind = F.element_at(F.array(*[F.lit(t) for t in dims.ACCOUNT_TYPES]), (F.col("ord") % 7 + 1).cast("int"))
    slice_ = [F.col("search_location").alias("city"), kind.alias("account_type")]
    raw = users.select(
        *slice_, (F.col("ord") % 10).alias("page"), F.col("ord").alias("pos"), F.col("user_id").alias("id"), "username", "description",
        "location", "name", F.lit(None).cast("string").alias("url"), F.struct(
            "followers_count", "following_count", F.col("tweets_count").alias("tweet_count"), F.col("ord").alias("listed_count"))
        .alias("public_metrics"))
    author = users.select(F.col("user_id").alias("author_id"), *slice_)
    posts = tweets.join(author, "author_id").select(
        "city", "account_type", F.lit(0).alias("page"), F.col("ord").alias("pos"), F.col("tweet_id").alias("id"), F.col("tweet_text").alias("text"),
        "author_id", F.col("created_on").cast("string").alias("created_at"), "lang")
    return posts, raw


def _slices_sql(where: str) -> str:
    return f"""
WITH landed AS (SELECT *, {_TYPE_SQL} AS account_type,
  dense_rank() OVER (PARTITION BY search_location, ord % 7 ORDER BY ord % 10) AS page_no FROM fx_users),
todo AS (SELECT * FROM landed WHERE {where}),
{_score_sql('todo')},
last AS (SELECT author_id, CAST(max(created_on) AS VARCHAR) AS day FROM fx_tweets GROUP BY 1)
SELECT t.user_id, t.search_location, t.account_type AS search_account_type, t.name, coalesce(last.day, '{DEFAULT_DATE}') AS tweet_date,
  lab.content_labels, lab.content_labels <> 'other' AS content_is_relevant
FROM todo t JOIN lab ON lab.user_id = t.user_id LEFT JOIN last ON last.author_id = t.user_id"""


def _slices_table(spark, sf_dir, **how):
    posts, users = _search_pages(spark, sf_dir)
    out = jobs.collect_slices(spark, posts, users, scratch_dir(spark, f"slices-{uuid.uuid4().hex[:12]}"), KEYWORDS, DEFAULT_DATE, **how)
    return out["table"].select("user_id", "search_location", "search_account_type", "name", "tweet_date", "content_labels",
                               "content_is_relevant")


@register("l01_collect_slices", _slices_sql("true"))
def l01_collect_slices(spark, sf_dir):
    """Search pages of all cities and types: merged, normalised, dated, stored, classified and tabulated."""
    return _slices_table(spark, sf_dir)


@register("l02_pilot_run", _slices_sql("search_location IN ('kolkata', 'guatemala') AND ord % 7 <> 0 AND page_no <= 5"))
def l02_pilot_run(spark, sf_dir):
    """The pilot cities with the first type skipped and a budget of 30 pages: the first five landed pages of each slice."""
    return _slices_table(spark, sf_dir, cities=dims.PILOT_CITIES, skip=[dims.ACCOUNT_TYPES[0]], budget=30)


@register("l02_one_city", _slices_sql("search_location = 'new york'"))
def l02_one_city(spark, sf_dir):
    """All types of one city."""
    return _slices_table(spark, sf_dir, cities=["new york"])


@register("l03_expanded_users", f"""
WITH rel AS (SELECT DISTINCT l.list_id FROM fx_users u JOIN fx_lists l ON l.user_id = u.user_id
  WHERE coalesce(len(list_filter({words_expr('l.name')}, lambda w: w IN {in_list(dims.LIST_KEYWORDS)})) > 0, false)
     OR coalesce(len(list_filter({words_expr('l.description')}, lambda w: w IN {in_list(dims.LIST_KEYWORDS)})) > 0, false)),
found AS (SELECT * FROM fx_users WHERE user_id IN (SELECT i.source FROM fx_interactions i JOIN rel ON rel.list_id = i.tweet_id)),
prev AS (SELECT CAST(doc_id AS VARCHAR) AS user_id FROM labels),
todo AS (SELECT user_id, description FROM found WHERE user_id NOT IN (SELECT user_id FROM prev)),
{_score_sql('todo')}
SELECT f.user_id, f.search_location, f.username, coalesce(lab.content_labels, 'other') AS content_labels,
  coalesce(lab.content_labels, 'other') <> 'other' AS content_is_relevant, true AS list_expansion
FROM found f LEFT JOIN lab ON lab.user_id = f.user_id""")
def l03_expanded_users(spark, sf_dir):
    """Members of the users' relevant lists, normalised, classified unless they were before, tabulated as expanded users."""
    users, tweets, lists, inter, labels = tables(spark, sf_dir, "fx_users", "fx_tweets", "fx_lists", "fx_interactions", "labels")
    members = inter.select(F.col("tweet_id").alias("list_id"), F.col("source").alias("user_id"))
    _, raw = _search_pages(spark, sf_dir)
    accounts = raw.withColumnsRenamed({"city": "search_location", "account_type": "search_account_type"})
    prev = labels.select(F.col("doc_id").cast("string").alias("user_id"), F.lit("other").alias("content_labels"),
                         F.lit(False).alias("content_is_relevant"))
    out = jobs.expand_lists(users, lists, members, accounts, tweets, prev, KEYWORDS)
    return out["table"].select("user_id", "search_location", "username", "content_labels", "content_is_relevant", "list_expansion")


@register("l14_simple_edges", f"""
WITH {NET_CTES}, {_RT_EDGES_SQL},
c AS (SELECT * FROM rt_edges WHERE target IN (SELECT user_id FROM net_roots WHERE target_location = 'kolkata')),
g AS (SELECT source, target, count(*) AS w, min((ord, pos)) AS o, string_agg(tweet_id, ',' ORDER BY ord, pos, tweet_id) AS ids
  FROM c GROUP BY source, target)
SELECT 'e' || CAST(row_number() OVER (ORDER BY o, source, target) AS VARCHAR) AS "~id", source AS "~from",
  target AS "~to", 'retweeted' AS "~label", w AS weight, ids AS "tweet_ids:String", 'kolkata' AS location FROM g""")
def l14_simple_edges(spark, sf_dir):
    """The export job's simple form: one city's retweet edges in the simple loader's columns."""
    return jobs.export_simple(*net_tables(spark, sf_dir), "kolkata")["retweet_edges"]
