"""Queries for the queue steps in batch form and list expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.predicates import list_relevant
from skein.operators.network import normalize_net_user
from skein.plans.q_network import net_tables
from skein.plans.registry import register, tables
from skein.plans.sqlbits import NET_CTES, in_list, match_expr, words_expr
from skein.sources import readers
from skein.sources.readers import list_members, list_memberships
from skein.streaming import queues as qu

NOW = "2025-02-01T00:00:00+00:00"


def _vertex_store(spark, sf_dir):
    """Accounts already in the graph: those with balances above 9000."""
    (users,) = tables(spark, sf_dir, "fx_users")
    return users.filter(F.col("followers_count") > 9000).select("user_id")


_ROOTS_SQL = f"""
u AS (SELECT user_id, search_location AS target_location, followers_count, tweets_count,
  CASE WHEN {match_expr('location', 'search_location')} THEN search_location END AS city FROM fx_users),
roots AS (SELECT * FROM u WHERE user_id NOT IN (SELECT user_id FROM fx_users WHERE followers_count > 9000)
  AND coalesce(city = target_location AND followers_count > 100 AND tweets_count > 0, false))"""


@register("q01_dispatch_roots", f"""
WITH {_ROOTS_SQL}
SELECT user_id, target_location AS location, 'UserTweets' AS topic FROM roots
UNION ALL SELECT user_id, target_location, 'UserFollowers' FROM roots""")
def q01_dispatch_roots(spark, sf_dir):
    """New qualifying accounts (not yet vertices), each landed twice -> one message per queue."""
    (users,) = tables(spark, sf_dir, "fx_users")
    out = qu.dispatch_roots(normalize_net_user(users.unionAll(users)), _vertex_store(spark, sf_dir))
    return out["messages"]


@register("q01_root_objects", f"""
WITH {_ROOTS_SQL}
SELECT r.target_location AS location, r.user_id, 'description' AS name, '' AS value FROM roots r""")
def q01_root_objects(spark, sf_dir):
    """Description objects of dispatched accounts (the accounts here have no description)."""
    (users,) = tables(spark, sf_dir, "fx_users")
    return qu.dispatch_roots(normalize_net_user(users).drop("description"), _vertex_store(spark, sf_dir))["objects"]


@register("q02_dispatch_tweets", f"""
WITH {_ROOTS_SQL}
SELECT t.tweet_id, t.author_id AS target_user_id, r.target_location AS location
FROM fx_tweets t JOIN roots r ON r.user_id = t.author_id
WHERE coalesce(t.tweet_text NOT LIKE 'RT @%', true) AND t.retweet_count > 0""")
def q02_dispatch_tweets(spark, sf_dir):
    """Posts of dispatched roots: originals with reposts are queued for their retweeters."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    roots = qu.dispatch_roots(normalize_net_user(users), _vertex_store(spark, sf_dir))["roots"]
    t = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text", "retweet_count", "created_on")
    return qu.dispatch_tweets(t, roots, NOW)["messages"]


@register("q02_retweeter_status", f"""
WITH {_ROOTS_SQL},
per AS (SELECT author_id, max(created_on) AS last_tweeted_at,
  sum(CASE WHEN coalesce(tweet_text NOT LIKE 'RT @%', true) AND retweet_count > 0 THEN 1 ELSE 0 END) AS nq
  FROM fx_tweets GROUP BY author_id)
SELECT r.user_id, CASE WHEN coalesce(p.nq, 0) > 0 THEN 'queued' ELSE 'completed' END AS retweeter_status,
  CASE WHEN coalesce(p.nq, 0) > 0 THEN NULL ELSE '{NOW}' END AS retweeter_last_processed, p.last_tweeted_at
FROM roots r LEFT JOIN per p ON p.author_id = r.user_id""")
def q02_retweeter_status(spark, sf_dir):
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    roots = qu.dispatch_roots(normalize_net_user(users), _vertex_store(spark, sf_dir))["roots"]
    t = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text", "retweet_count", "created_on")
    return qu.dispatch_tweets(t, roots, NOW)["status"]


@register("q05_retweeter_completion", f"""
WITH {NET_CTES},
expected AS (SELECT DISTINCT tweet_id, root_id AS target_user_id FROM net_tweets
  WHERE coalesce(tweet_text NOT LIKE 'RT @%', true) AND retweet_count > 0),
done AS (SELECT DISTINCT r.root_id AS target_user_id, r.tweet_id FROM net_rt r),
e AS (SELECT target_user_id, count(DISTINCT tweet_id) AS n_expected FROM expected GROUP BY 1),
d AS (SELECT d.target_user_id, count(*) AS n_done FROM done d JOIN expected x
  ON x.tweet_id = d.tweet_id AND x.target_user_id = d.target_user_id GROUP BY 1)
SELECT e.target_user_id, e.n_expected, coalesce(d.n_done, 0) AS n_done,
  CASE WHEN coalesce(d.n_done, 0) >= e.n_expected THEN 'completed' ELSE 'pending' END AS retweeter_status
FROM e LEFT JOIN d ON d.target_user_id = e.target_user_id""")
def q05_retweeter_completion(spark, sf_dir):
    """Per root: queued posts vs posts whose retweeters were collected."""
    _, root_tweets, retweeters, _ = net_tables(spark, sf_dir, need=('retweeters',))
    expected = root_tweets.filter(F.col("retweet_count") > 0).filter(
        ~F.coalesce(F.startswith("tweet_text", F.lit("RT @")), F.lit(False))) \
        .select("tweet_id", F.col("root_id").alias("target_user_id"))
    processed = retweeters.select(F.col("root_id").alias("target_user_id"), "tweet_id") \
        .join(expected, ["target_user_id", "tweet_id"], "left_semi")
    return qu.retweeter_completion(expected, processed)


@register("q03_follower_status", f"""
WITH {NET_CTES},
n AS (SELECT root_id, count(*) AS n FROM net_fol GROUP BY root_id)
SELECT r.user_id, CASE WHEN coalesce(n.n, 0) > 0 THEN 'completed' ELSE 'failed' END AS follower_status
FROM net_roots r LEFT JOIN n ON n.root_id = r.user_id""")
def q03_follower_status(spark, sf_dir):
    """Processing follower pages: roots with followers complete, the rest fail."""
    return _processed_followers(spark, sf_dir)["status"]


def _processed_followers(spark, sf_dir):
    roots, _, _, followers = net_tables(spark, sf_dir, need=('followers',))
    fol = followers.withColumn("tweets_count", F.lit(None).cast("bigint")).withColumn("city", F.lit(None).cast("string"))
    return qu.process_followers(roots, fol, roots.select("user_id", "username", "profile_location", "target_location",
                                                         "followers_count", "tweets_count", "city"))


@register("q03_vertices", f"""
WITH {NET_CTES}
SELECT user_id FROM net_roots UNION SELECT user_id FROM net_fol""")
def q03_vertices(spark, sf_dir):
    """The vertex store after processing follower pages: every id once."""
    return _processed_followers(spark, sf_dir)["vertices"].select("user_id")


@register("q03_follows", f"""
WITH {NET_CTES}
SELECT DISTINCT f.user_id AS src, f.root_id AS dst, CAST(1 AS BIGINT) AS weight FROM net_fol f
WHERE f.root_id IN (SELECT user_id FROM net_roots)""")
def q03_follows(spark, sf_dir):
    """FOLLOWS edges from follower pages."""
    return _processed_followers(spark, sf_dir)["follows"]


def _people(spark, sf_dir, df):
    """Landed follower / retweeter records with their own post count, target city and matched city."""
    from skein.functions.predicates import location_match, with_city_targets
    (users,) = tables(spark, sf_dir, "fx_users")
    roots = users.select(F.col("user_id").alias("root_id"), F.col("search_location").alias("target_location"))
    counts = users.select("user_id", "tweets_count")
    t = with_city_targets(df.drop("target_location").join(roots, "root_id").join(counts, "user_id"), "target_location", out="__t")
    return t.withColumn("city", F.when(location_match("profile_location", "__t"), F.col("target_location"))).drop("__t", "following_count")


def _people_store(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return users.filter("followers_count > 9000").select(
        "user_id", "username", F.col("location").alias("profile_location"), F.col("search_location").alias("target_location"),
        "followers_count", "tweets_count", F.lit(None).cast("string").alias("city"))


def _dispatched_sql(people: str, order: str) -> str:
    """Messages to the users of CTE ``people`` whose first record qualifies and who are no vertex yet."""
    return f"""
p1 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS rn FROM {people}),
ok AS (SELECT user_id, target_location AS location FROM p1 WHERE rn = 1 AND {match_expr('profile_location', 'target_location')}
  AND followers_count > 100 AND tweets_count > 0 AND user_id NOT IN (SELECT user_id FROM fx_users WHERE followers_count > 9000))
SELECT user_id, location, 'UserTweets' AS topic FROM ok UNION ALL SELECT user_id, location, 'UserFollowers' FROM ok"""


@register("q03_dispatch", f"""
WITH {NET_CTES},
fol AS (SELECT f.*, u.tweets_count FROM net_fol f JOIN net_roots r ON r.user_id = f.root_id JOIN fx_users u ON u.user_id = f.user_id),
{_dispatched_sql("fol", "root_id, ord, pos")}""")
def q03_dispatch(spark, sf_dir):
    """Followers (of several roots each) that qualify as new roots: one message per user and queue."""
    roots, _, _, followers = net_tables(spark, sf_dir, need=('followers',))
    return qu.process_followers(roots, _people(spark, sf_dir, followers), _people_store(spark, sf_dir), True)["dispatch"]


def _processed_retweeters(spark, sf_dir):
    """Two deliveries: some retweeters first, then all of them (the first ones again)."""
    _, posts, retweeters, _ = net_tables(spark, sf_dir, need=('retweeters',))
    msgs = posts.filter(~F.coalesce(F.startswith("tweet_text", F.lit("RT @")), F.lit(False)) & (F.col("retweet_count") > 0)) \
        .select("tweet_id", F.col("root_id").alias("target_user_id"))
    rts = _people(spark, sf_dir, retweeters)
    edges, ids = (readers.empty(spark, d) for d in ("src STRING, dst STRING, weight BIGINT",
                                                    "src STRING, dst STRING, tweet_id STRING, ord BIGINT"))
    one = qu.process_retweeters(msgs, rts.filter("pos = 1"), _people_store(spark, sf_dir), edges, ids)
    return qu.process_retweeters(msgs, rts, _people_store(spark, sf_dir), one["edges"], one["edge_tweets"])


_RTS_SQL = f"""{NET_CTES},
rts AS (SELECT r.*, n.target_location, u.tweets_count FROM net_rt r JOIN net_tweets t ON t.tweet_id = r.tweet_id AND t.root_id = r.root_id
    AND coalesce(t.tweet_text NOT LIKE 'RT @%', true) AND t.retweet_count > 0
  JOIN net_roots n ON n.user_id = r.root_id JOIN fx_users u ON u.user_id = r.user_id)"""


@register("q04_edges", f"""
WITH {_RTS_SQL}
SELECT user_id AS src, root_id AS dst, count(DISTINCT tweet_id) AS weight FROM rts
WHERE root_id IN (SELECT user_id FROM fx_users WHERE followers_count > 9000) OR root_id IN (SELECT user_id FROM rts)
GROUP BY 1, 2""")
def q04_edges(spark, sf_dir):
    """RETWEETED edges between known vertices; a delivery that comes again adds nothing."""
    return _processed_retweeters(spark, sf_dir)["edges"]


@register("q04_dispatch", f"""
WITH {_RTS_SQL},
{_dispatched_sql("rts", "ord, pos, root_id, tweet_id")}""")
def q04_dispatch(spark, sf_dir):
    """Retweeters that qualify as new roots: one message per user and queue."""
    return _processed_retweeters(spark, sf_dir)["dispatch"]


LATER = "2025-02-02T00:00:00+00:00"


@register("q02_status_folded", f"""
WITH {_ROOTS_SQL},
t AS (SELECT author_id, tweet_id, created_on, ord % 2 AS half,
  coalesce(tweet_text NOT LIKE 'RT @%', true) AND retweet_count > 0 AS wanted FROM fx_tweets),
halves AS (SELECT author_id, half, bool_or(wanted) AS queued, max(created_on) AS last FROM t GROUP BY 1, 2),
runs AS (SELECT author_id, max(CASE WHEN NOT queued THEN '{NOW}' END) AS at, max(last) AS last FROM halves GROUP BY 1),
done AS (SELECT DISTINCT root_id, tweet_id FROM fx_net_retweeters),
n AS (SELECT t.author_id, count(*) AS n_expected, count(d.tweet_id) AS n_done FROM t
  LEFT JOIN done d ON d.root_id = t.author_id AND d.tweet_id = t.tweet_id WHERE t.wanted GROUP BY 1)
SELECT r.user_id, CASE WHEN coalesce(n.n_done < n.n_expected, false) THEN 'queued' ELSE 'completed' END AS retweeter_status,
  CASE WHEN coalesce(n.n_done < n.n_expected, false) THEN NULL ELSE greatest(u.at, CASE WHEN n.n_done > 0 THEN '{LATER}' END) END
    AS retweeter_last_processed, CAST(u.last AS VARCHAR) AS last_tweeted_at,
  coalesce(n.n_expected, 0) AS n_expected, coalesce(n.n_done, 0) AS n_done
FROM roots r JOIN runs u ON u.author_id = r.user_id LEFT JOIN n ON n.author_id = r.user_id""")
def q02_status_folded(spark, sf_dir):
    """Posts dispatched in two published runs, their retweeters in a third: one status per root over all runs."""
    from skein.streaming.runs import RunStore
    users, tweets, rts = tables(spark, sf_dir, "fx_users", "fx_tweets", "fx_net_retweeters")
    roots = qu.dispatch_roots(normalize_net_user(users), _vertex_store(spark, sf_dir))["roots"].select("user_id", "target_location")
    t = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text", "retweet_count",
                      F.col("created_on").cast("string").alias("created_on"), "ord")
    store = RunStore(spark, _scratch(spark, "status-store"))
    for half in (0, 1):
        landed, run = t.filter(F.col("ord") % 2 == half), store.begin()
        mine = roots.join(landed.select(F.col("root_id").alias("user_id")), "user_id", "left_semi")
        out = qu.dispatch_tweets(landed, mine, NOW)
        run.stage("status", out["status"])
        run.stage("messages", out["messages"])
        run.publish()
    messages = store.table("messages")
    run = store.begin()
    run.stage("done", rts.select("root_id", "tweet_id").distinct().join(
        messages.select("tweet_id", F.col("target_user_id").alias("root_id")), ["root_id", "tweet_id"], "left_semi")
        .withColumn("at", F.lit(LATER)))
    run.publish()
    return qu.current_retweeter_status(store.table("status"), messages, store.table("done"))


@register("q03_failed_root", f"""
WITH {NET_CTES},
n AS (SELECT root_id, count(*) AS n FROM net_fol GROUP BY root_id)
SELECT r.user_id, 'follower' AS kind, CASE WHEN coalesce(n.n, 0) > 0 THEN 'completed' ELSE 'failed' END AS status,
  '{LATER}' AS at, CAST(2 AS BIGINT) AS run
FROM net_roots r LEFT JOIN n ON n.root_id = r.user_id""")
def q03_failed_root(spark, sf_dir):
    """Roots queued in one run and processed in the next: the log folded by Q6's order; a root without followers fails."""
    from skein.streaming import runs
    roots, _, _, _ = net_tables(spark, sf_dir, need=())
    store = runs.RunStore(spark, _scratch(spark, "status-log"), {"status_log": runs.fold_status})
    for at, log in ((NOW, roots.select("user_id", F.lit("queued").alias("status"))),
                    (LATER, _processed_followers(spark, sf_dir)["status"].select("user_id", F.col("follower_status").alias("status")))):
        run = store.begin()
        run.stage("status_log", log.select("user_id", F.lit("follower").alias("kind"), "status", F.lit(at).alias("at"),
                                           F.lit(run.number).cast("long").alias("run")))
        run.publish()
    return runs.fold_status(store.table("status_log"))


@register("q07_replay", """
SELECT user_id, topic, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs FROM fx_queue GROUP BY 1, 2""")
def q07_replay(spark, sf_dir):
    """Messages landed twice over (every third without an id, landed once): a run dies before it publishes, is repeated,
    and a second run gets what landed later; each message is counted once."""
    from skein.streaming.runs import RunStore
    (queue,) = tables(spark, sf_dir, "fx_queue")
    ddl = "user_id STRING, topic STRING, seq BIGINT, msg_id STRING"
    messages = queue.select("user_id", "topic", "seq", F.when(F.col("seq") % 3 != 0, F.col("seq").cast("string")).alias("msg_id"))
    base = _scratch(spark, "replay")
    step = lambda df, run: {"counts": df.groupBy("user_id", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs"))}
    first = messages.filter(F.col("seq") % 2 == 0)
    first.write.mode("append").json(f"{base}/landing")
    dead = RunStore(spark, f"{base}/store").begin()
    for name, out in step(dead.land(f"{base}/landing", ddl), dead.number).items():
        dead.stage(name, out)  # and dies here
    qu.run_worker(spark, f"{base}/landing", ddl, f"{base}/store", step)
    again = messages.filter((F.col("seq") % 2 == 1) | F.col("msg_id").isNotNull())
    again.write.mode("append").json(f"{base}/landing")
    qu.run_worker(spark, f"{base}/landing", ddl, f"{base}/store", step)
    return RunStore(spark, f"{base}/store").table("counts").groupBy("user_id", "topic").agg(
        F.sum("n").alias("n"), F.sum("seqs").alias("seqs"))


@register("l15_closed_loop", f"""
WITH RECURSIVE {NET_CTES},
ok AS (SELECT user_id FROM net_roots WHERE coalesce(city = target_location AND followers_count > 100 AND tweets_count > 0, false)),
wanted AS (SELECT DISTINCT r.user_id AS source, r.root_id AS target, r.tweet_id FROM net_rt r JOIN net_tweets t
  ON t.tweet_id = r.tweet_id AND t.root_id = r.root_id AND t.retweet_count > 0 AND coalesce(t.tweet_text NOT LIKE 'RT @%', true)),
e AS (SELECT source, target FROM fx_interactions UNION SELECT source, target FROM wanted),
reached AS (SELECT n.user_id FROM net_roots n JOIN supplier s ON n.user_id = CAST(s.s_suppkey AS VARCHAR)
  UNION SELECT e.source FROM reached r JOIN e ON e.target = r.user_id JOIN ok ON ok.user_id = e.source)
SELECT 'FOLLOWS' AS label, source AS src, target AS dst, CAST(1 AS BIGINT) AS weight
FROM (SELECT DISTINCT source, target FROM fx_interactions) f WHERE target IN (SELECT user_id FROM reached)
UNION ALL SELECT 'RETWEETED', source, target, count(*) FROM wanted WHERE target IN (SELECT user_id FROM reached) GROUP BY 2, 3""")
def l15_closed_loop(spark, sf_dir):
    """Queue workers as a closed loop over topics with offsets: seeds (supplier accounts) are dispatched, landed followers
    and retweeters that qualify are dispatched in turn, until nothing is unread: all edges collected."""
    from skein.plans import jobs
    users, tweets, rts, inter, supplier = tables(spark, sf_dir, "fx_users", "fx_tweets", "fx_net_retweeters", "fx_interactions", "supplier")
    shape = ["user_id", "username", "description", "profile_location", "target_location", "followers_count", "tweets_count", "city"]
    people = normalize_net_user(users).select(*shape)
    seeds = people.join(supplier.select(F.col("s_suppkey").cast("string").alias("user_id")), "user_id", "left_semi")
    posts = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text", "retweet_count",
                          F.col("created_on").cast("string").alias("created_on"))
    followers = inter.select(F.col("target").alias("root_id"), F.col("source").alias("user_id"), "ord", "pos").join(people, "user_id")
    reposters = rts.join(people, "user_id")
    out = jobs.collection_loop(spark, _scratch(spark, "loop"), seeds, posts, followers, reposters, NOW)
    follows = out["follows"].select(F.lit("FOLLOWS").alias("label"), "src", "dst", "weight")
    return follows.unionByName(jobs.edge_weights(out["edge_tweets"]).select(F.lit("RETWEETED").alias("label"), "src", "dst", "weight"))


@register("q08_prompts", """
WITH t AS (SELECT author_id AS user_id, string_agg(tweet_text, chr(10) ORDER BY 'tweet_' || tweet_id) AS posts FROM fx_tweets
  WHERE coalesce(tweet_text NOT LIKE 'RT @%', true) GROUP BY 1)
SELECT coalesce(u.user_id, t.user_id) AS user_id, 'About: ' || coalesce(u.description, '') || chr(10) || 'Posts: ' || coalesce(t.posts, '') AS prompt
FROM fx_users u FULL OUTER JOIN t ON t.user_id = u.user_id""")
def q08_prompts(spark, sf_dir):
    """Stored text objects of every user -> its prompt (users with one post or none included)."""
    from skein.plans import jobs
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    posts = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text")
    objects = jobs.pending_texts(users.withColumn("followers_count", F.coalesce("followers_count", F.lit(0))), posts)
    return qu.render_queue_prompts(objects, "About: user_description\nPosts: user_tweets")


@register("q08_prompt_parts", """
WITH t AS (SELECT author_id AS user_id, string_agg(tweet_text, chr(10) ORDER BY 'tweet_' || tweet_id) AS posts FROM fx_tweets
  WHERE coalesce(tweet_text NOT LIKE 'RT @%', true) GROUP BY 1)
SELECT coalesce(u.user_id, t.user_id) AS user_id,
  sha256('About: ' || coalesce(u.description, '') || chr(10) || 'Posts: ' || coalesce(t.posts, '')) AS prompt_sha256
FROM fx_users u FULL OUTER JOIN t ON t.user_id = u.user_id""")
def q08_prompt_parts(spark, sf_dir):
    """Prompts in parts of three posts at most, put together again for the comparison."""
    from skein.plans import jobs
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    posts = tweets.select(F.col("author_id").alias("root_id"), "tweet_id", "tweet_text")
    objects = jobs.pending_texts(users.withColumn("followers_count", F.coalesce("followers_count", F.lit(0))), posts)
    parts = qu.prompt_parts(objects, "About: user_description\nPosts: user_tweets", 3)
    whole = parts.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "")
    return whole.select("user_id", F.sha2(text.cast("binary"), 256).alias("prompt_sha256"))


@register("s14_list_memberships", """
SELECT u.user_id, l.list_id FROM fx_users u JOIN fx_lists l ON l.user_id = u.user_id""")
def s14_list_memberships(spark, sf_dir):
    users, lists = tables(spark, sf_dir, "fx_users", "fx_lists")
    return list_memberships(users, lists.select("user_id", "list_id"))


@register("s13_list_members", """
SELECT i.tweet_id AS list_id, i.source AS user_id FROM fx_interactions i
WHERE i.tweet_id IN (SELECT list_id FROM fx_lists WHERE list_id IS NOT NULL)""")
def s13_list_members(spark, sf_dir):
    """Members of each list (list membership records = interactions on the list's key)."""
    lists, inter = tables(spark, sf_dir, "fx_lists", "fx_interactions")
    members = inter.select(F.col("tweet_id").alias("list_id"), F.col("source").alias("user_id"))
    return list_members(lists, members)


@register("l03_list_expansion", f"""
WITH rel AS (SELECT DISTINCT l.list_id FROM fx_users u JOIN fx_lists l ON l.user_id = u.user_id
  WHERE coalesce(len(list_filter({words_expr('l.name')}, lambda w: w IN {in_list(dims.LIST_KEYWORDS)})) > 0, false)
     OR coalesce(len(list_filter({words_expr('l.description')}, lambda w: w IN {in_list(dims.LIST_KEYWORDS)})) > 0, false))
SELECT DISTINCT i.source AS user_id FROM fx_interactions i JOIN rel ON rel.list_id = i.tweet_id""")
def l03_list_expansion(spark, sf_dir):
    """Job: users' lists (S14) -> relevant lists (F7) -> their members (S13) = expanded users."""
    users, lists, inter = tables(spark, sf_dir, "fx_users", "fx_lists", "fx_interactions")
    mine = list_memberships(users, lists.select("user_id", "list_id", "name", "description"))
    rel = mine.filter(list_relevant("name", "description")).select("list_id")
    members = inter.select(F.col("tweet_id").alias("list_id"), F.col("source").alias("user_id"))
    return list_members(rel, members).select("user_id").distinct()


def _scratch(spark, name: str) -> str:
    import uuid
    from skein.session import scratch_dir
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("s01_json_pages", """
SELECT user_id, username, description, location, followers_count FROM fx_users""")
def s01_json_pages(spark, sf_dir):
    """Users landed as JSON-array files of 1000 records each (one page a file), read back by byte ranges."""
    (users,) = tables(spark, sf_dir, "fx_users")
    path = _scratch(spark, "pages")
    record = F.to_json(F.struct("user_id", "username", "description", "location", "followers_count"))
    users.groupBy(F.floor(F.col("ord") / 1000).alias("page")).agg(F.array_sort(F.collect_list(record)).alias("r")) \
        .select("page", F.concat(F.lit("["), F.array_join("r", ", "), F.lit("]")).alias("value")) \
        .write.partitionBy("page").text(path)
    return readers.read_json_array(spark, path, "user_id STRING, username STRING, description STRING, location STRING, followers_count BIGINT")


@register("k04_s04_csv_roundtrip", """
SELECT user_id, username, nullif(description, '') AS description, nullif(location, '') AS location,
  search_location, followers_count FROM fx_users""")
def k04_s04_csv_roundtrip(spark, sf_dir):
    """Users written as header CSV (K4) to the shared scratch folder and read back with a
    declared schema (S4). As with the reference's CSV files, an empty text comes back missing."""
    from skein.sources.readers import read_csv
    from skein.sources.sinks import write_csv
    (users,) = tables(spark, sf_dir, "fx_users")
    path = _scratch(spark, "users-csv")
    write_csv(users.select("user_id", "username", "description", "location", "search_location", "followers_count"), path)
    return read_csv(spark, path, "user_id STRING, username STRING, description STRING, location STRING, "
                                 "search_location STRING, followers_count BIGINT")


@register("k01_append_distinct", """
SELECT DISTINCT source, target, tweet_id FROM fx_interactions""")
def k01_append_distinct(spark, sf_dir):
    """Two overlapping landings (orders before 1997, orders from mid-1996) appended with
    whole-record dedupe (K1): the second append writes only what is new; the whole store is read."""
    from skein.sources.sinks import append_distinct, read_distinct
    (inter,) = tables(spark, sf_dir, "fx_interactions")
    rows = inter.select("source", "target", "tweet_id", "ts")
    path = _scratch(spark, "edges-store")
    append_distinct(rows.filter(F.col("ts") < F.lit("1997-01-01").cast("timestamp")).drop("ts"), path)
    append_distinct(rows.filter(F.col("ts") >= F.lit("1996-07-01").cast("timestamp")).drop("ts"), path)
    return read_distinct(spark, path)


@register("s10_processed_ids", """
SELECT DISTINCT author_id AS user_id FROM fx_tweets""")
def s10_processed_ids(spark, sf_dir):
    """Ids present in a written output (posts appended per author, K2), read back distinct."""
    from skein.sources.readers import read_processed_ids
    from skein.sources.sinks import append
    (tweets,) = tables(spark, sf_dir, "fx_tweets")
    path = _scratch(spark, "posts-out")
    append(tweets.select(F.col("author_id").alias("user_id"), "tweet_id"), path)
    return read_processed_ids(spark, path)
