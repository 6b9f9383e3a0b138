"""Jobs: compositions users run end to end (L1-L17), each a DataFrame -> DataFrame plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.predicates import list_relevant
from skein.operators import analysis as an
from skein.operators import classify as cl
from skein.operators import dedupe as dd
from skein.operators import export as ex
from skein.operators import graph as gr
from skein.operators import network as nw
from skein.operators import normalize as nm
from skein.session import stored


def filter_lists(lists: DataFrame) -> DataFrame:
    """List file -> 4 columns (P22) -> unique list ids (D4) -> relevant lists."""
    order = F.col("ord") if "ord" in lists.columns else F.monotonically_increasing_id()
    kept = lists.select(*nm.list_columns(lists).columns, order.alias("ord"))
    first = dd.unique_by(kept, "list_id", ["ord"])
    return first.filter(list_relevant("name", "description")).select("list_id", "user_id", "name", "description")


def tabulate_city(users: DataFrame, list_expansion: bool = False) -> DataFrame:
    """Conform user records (P9, F9, P8, P26) and keep one row per user (D3)."""
    c = nm.conform_users(users, list_expansion, keep=[c for c in ("ord",) if c in users.columns])
    order = ["ord"] if "ord" in users.columns else [c for c in c.columns if c != "user_id"]
    return dd.unique_by(c, "user_id", order)


def analysis(users: DataFrame, master: DataFrame, labels: list[str]) -> dict[str, DataFrame]:
    """Label tables (A6) and location match tables (F1, A1, A2)."""
    out = an.analysis_suite(users, master, labels)
    m = an.location_matches(users)
    out["location_matches"] = m
    out["location_matches_counts"] = an.location_pivot(m)
    return out


def edges_and_stats(roots, root_tweets, retweeters, followers) -> dict[str, DataFrame]:
    """Both edge files (G1) and the coverage statistics."""
    fe = nw.follower_edges(roots, followers)
    re_ = nw.retweet_edges(roots, root_tweets, retweeters)
    stats = nw.root_stats(roots, root_tweets, retweeters, followers, fe, re_)
    return {"follower_edges": fe, "retweet_edges": re_, "stats": stats,
            "medians": nw.network_medians(stats), "query_shares": nw.query_shares(root_tweets)}


def graph_report(edges: DataFrame, kind: str = "retweet", k: int = 3,
                 fixed_iterations: int | None = None) -> dict[str, DataFrame]:
    """Graph (G2), counts/density/average degree (G3, G4, G6), PageRank (G7), top k."""
    v, e = gr.build_graph(edges, kind)
    e = stored(e, "graph-edges")  # read by the ranks, the counts and the degrees
    ranks = gr.pagerank(None, e, fixed_iterations=fixed_iterations)
    top = gr.top_ranks(ranks, k)
    named = gr.vertex_attributes(gr.edges_touching(edges, top), "first")  # of the edges at the top k alone
    return {"vertices": v, "edges": e, "counts": gr.graph_counts(gr.endpoints(e), e), "degree": gr.degree(e),
            "pagerank": ranks, "top": gr.top_influencers(top, named, k)}


def classify_slice(users: DataFrame, tweets: DataFrame, previous: DataFrame,
                   keywords: dict[str, list[str]]) -> DataFrame:
    """L1 (classification half): dedupe, skip done, score, label, union (M3)."""
    return cl.classify_incremental(users, tweets, previous, keywords)


def collect_slices(spark, posts: DataFrame, users: DataFrame, base: str, keywords: dict[str, list[str]], default_date: str,
                   cities: list[str] | None = None, skip: list[str] | None = None,
                   budget: int | None = None) -> dict[str, DataFrame]:
    """L1 for every city x type slice at once (L2): queries (P19, F16) choose the slices; their landed search pages are merged
    (S11), normalised (P1, P2), dated (J2), reduced to one record per key (D1) and appended to the stores below
    ``base`` (K1); users with their posts (J1) are classified unless they were before (M3), and tabulated (L5).

    ``posts`` and ``users`` are landed pages: raw records with ``city``, ``account_type``, ``page`` and ``pos``. ``cities``: all
    by default, ``dims.PILOT_CITIES`` for a pilot run, one name for one city. ``budget`` is shared by the types (W9) and
    limits the pages of each slice's users (W5).
    """
    from skein.functions import dims
    from skein.functions.predicates import skip_types
    from skein.operators import enrich as en
    from skein.sources.readers import land_pages
    from skein.sources.sinks import append_distinct, read_distinct, versions
    names = spark.createDataFrame([(c,) for c in (dims.CITIES if cities is None else cities)], "city STRING")
    queries = nm.render_queries(names, "city").filter(F.col("query").isNotNull() & skip_types("account_type", skip or []))
    posts, users = (p.join(queries.select("city", "account_type"), ["city", "account_type"], "left_semi") for p in (posts, users))
    if budget is not None:
        shares = an.even_split(queries.select("account_type").distinct(), budget, "account_type")
        pages = users.select("city", "account_type", "page").distinct().join(shares, "account_type")
        allowed = an.per_group_first_n(pages, ["city", "account_type"], [F.col("page")], F.col("budget"))
        users = users.join(allowed.select("city", "account_type", "page"), ["city", "account_type", "page"], "left_semi")
    landed = land_pages([posts], "id")
    tweets = dd.dedupe_by_key(nm.normalize_tweets_full(landed), ["created_at", "text"], key_cols=("tweet_id",))
    first = not versions(spark, f"{base}/tweets")
    written = append_distinct(tweets, f"{base}/tweets")
    if first:  # the version holds just these posts: dates are read from its columns, not from whole posts moved once more
        tweets = spark.read.parquet(written)
    people = land_pages([users], "id")
    place = people.select(F.col("id").alias("user_id"), F.col("city").alias("search_location"),
                          F.col("account_type").alias("search_account_type"))
    found = nm.normalize_users_search(people).join(place, "user_id")
    dated = en.attach_date(found, tweets.withColumn("ord", F.struct("created_at", "tweet_id")), default_date, created="created_at")
    append_distinct(dated, f"{base}/users")
    stored_tweets, stored_users = read_distinct(spark, f"{base}/tweets"), read_distinct(spark, f"{base}/users")
    texts = stored_tweets.select("tweet_id", "author_id", F.col("text").alias("tweet_text"), F.col("tweet_id").alias("ord"))
    before = read_distinct(spark, f"{base}/classified")
    if before is None:
        from skein.sources.readers import empty
        before = empty(spark, "user_id STRING, content_labels STRING, content_is_relevant BOOLEAN")
    append_distinct(cl.classify_incremental(stored_users, texts, before, keywords), f"{base}/classified")
    classified = read_distinct(spark, f"{base}/classified")
    table = tabulate_city(stored_users.withColumnRenamed("tweets", "own_tweets").join(classified, "user_id"))
    return {"queries": queries, "tweets": stored_tweets, "users": stored_users, "classified": classified, "table": table}


def expand_lists(users: DataFrame, lists: DataFrame, members: DataFrame, accounts: DataFrame, tweets: DataFrame,
                 previous: DataFrame, keywords: dict[str, list[str]]) -> dict[str, DataFrame]:
    """L3: users' lists (S14) -> relevant lists (F7) -> their members (S13) -> the members' landed records (P2) -> those not
    classified before are classified (M3) and tabulated as expanded users (P26, L5)."""
    from skein.sources.readers import list_members, list_memberships
    mine = list_memberships(users, lists.select("user_id", "list_id", "name", "description"))
    relevant = mine.filter(list_relevant("name", "description")).select("list_id")
    ids = list_members(relevant, members).select("user_id").distinct()
    records = nm.normalize_users_search(accounts.join(ids.withColumnRenamed("user_id", "id"), "id", "left_semi"))
    place = accounts.select(F.col("id").alias("user_id"), "search_location", "search_account_type")
    found = records.join(place, "user_id")
    labelled = cl.classify_incremental(found, tweets, previous, keywords)
    table = tabulate_city(found.withColumnRenamed("tweets", "own_tweets").join(labelled, "user_id"), list_expansion=True)
    return {"members": ids, "classified": labelled, "table": table}


def export_simple(roots, root_tweets, retweeters, followers, location: str) -> dict[str, DataFrame]:
    """L14 (simple form, K8): the city's edges (G1) as the simple loader's vertices and edges, both kinds."""
    mine = roots.filter(F.col("target_location") == location)
    out = {}
    for kind, edges in (("retweet", nw.retweet_edges(mine, root_tweets, retweeters.join(mine.select(F.col("user_id").alias("root_id")), "root_id", "left_semi"))),
                        ("follower", nw.follower_edges(mine, followers.join(mine.select(F.col("user_id").alias("root_id")), "root_id", "left_semi")))):
        out[f"{kind}_vertices"], out[f"{kind}_edges"] = ex.export_graph_simple(edges, kind, location)
    return out


def export_typed(roots, root_tweets, retweeters, followers) -> dict[str, DataFrame]:
    """L14 (typed form, K9)."""
    return ex.typed_tables(roots, root_tweets, retweeters, followers)


def pending_texts(roots: DataFrame, root_tweets: DataFrame) -> DataFrame:
    """Description objects for users with attributes (F15) and one object per original post."""
    from skein.functions.predicates import is_original
    d = roots.filter(F.col("followers_count").isNotNull()).select(
        F.col("user_id"), F.lit("description").alias("name"), F.coalesce("description", F.lit("")).alias("value"))
    t = root_tweets.filter(is_original("tweet_text")).select(
        F.col("root_id").alias("user_id"), F.concat(F.lit("tweet_"), "tweet_id").alias("name"),
        F.col("tweet_text").alias("value"))
    return d.unionByName(t)


def run_matrix(users: DataFrame, tweets: DataFrame, previous: DataFrame, total_budget: int,
               keywords: dict[str, list[str]], skip: list[str] | None = None) -> dict[str, DataFrame]:
    """L2: the city x account-type run as one job: city and type are columns, the
    request budget is shared per type (W9), a type can be skipped (F16), and each
    slice is classified (L1) and tabulated (L5)."""
    from skein.functions.predicates import skip_types
    u = users.filter(skip_types("search_account_type", skip or []))
    budgets = an.even_split(u.select("search_account_type").distinct(), total_budget, "search_account_type")
    labelled = cl.classify_incremental(u, tweets, previous, keywords)
    table = tabulate_city(u.drop("content_labels", "content_is_relevant")
                          .join(labelled, "user_id", "left"))
    return {"budgets": budgets, "classified": labelled, "table": table}


def reclassify(users: DataFrame, tweets: DataFrame, keywords: dict[str, list[str]]) -> DataFrame:
    """L4: reclassify normal / expanded / manually added users (M4) and tabulate."""
    labelled = cl.reclassify_all(users, tweets, keywords)
    return tabulate_city(users.drop("content_labels", "content_is_relevant").join(labelled, "user_id", "left"))


def master_dataset(distinct_users: list[DataFrame], expanded_users: list[DataFrame]) -> DataFrame:
    """Union each file family (S7/U1), then distinct ++ expanded distinct."""
    return dd.master_dataset(dd.union_files(distinct_users), dd.union_files(expanded_users))


def extra_tweets(tweets: DataFrame, users: DataFrame) -> DataFrame:
    """The most recent min(tweet_count, 5) posts per user (W4), deduped as records (K1 semantics)."""
    from skein.operators.enrich import recent_per_user
    return dd.dedupe_whole(recent_per_user(tweets, users))


def root_network(users: DataFrame, processed: DataFrame, pages: dict[str, list[DataFrame]]) -> dict[str, DataFrame]:
    """Matched city users (F11) not processed yet (J5) -> landed pages of their
    posts / followers / retweeters merged (S11) -> vertex and post shapes (P5/P6).

    Pages carry ``root_id``, ``page`` and ``pos``; the outputs are appended by the caller (K2).
    """
    from skein.operators.enrich import unprocessed
    from skein.sources.readers import land_pages
    todo = unprocessed(an.matched_city_users(users), processed)
    out = {"todo": todo}
    roots = todo.select(F.col("user_id").alias("root_id"), "search_location")
    if pages.get("tweets"):
        posts = land_pages(pages["tweets"], ["root_id", "tweet_id"]).join(roots, "root_id", "left_semi")
        out["tweets"] = nw.normalize_net_tweet(posts, keep=["root_id"])
    for kind, keys in (("followers", ["root_id", "user_id"]), ("retweeters", ["root_id", "tweet_id", "user_id"])):
        if pages.get(kind):
            people = land_pages(pages[kind], keys).join(roots, "root_id")
            out[kind] = nw.normalize_net_user(people, keep=[k for k in keys if k != "user_id"])
    return out


def attribute_backfill(followers: DataFrame, cache: DataFrame) -> DataFrame:
    """Nested followers/retweeters replaced by cached attributes (J9), statuses reset."""
    from skein.operators.enrich import with_cached_attributes
    return nm.reset_status(with_cached_attributes(followers, cache))


def user_catalogue(roots, retweeters, followers, stored) -> DataFrame:
    """Every user seen in the network once, minus those stored already."""
    from skein.operators.enrich import user_catalog
    return user_catalog(roots, retweeters, followers, stored)


_PERSON = ("user_id STRING, username STRING, description STRING, profile_location STRING, target_location STRING, "
           "followers_count BIGINT, tweets_count BIGINT, city STRING")
_MESSAGE = "msg_id STRING, sent_at STRING"


def _stored(spark, base: str, name: str, ddl: str) -> DataFrame:
    """A worker's published output so far (empty before its first run)."""
    from skein.streaming.runs import RunStore
    return RunStore(spark, base).read(name, ddl)


def queue_workers(spark, landing: str, store: DataFrame, base: str) -> None:
    """One run of the dispatch worker (Q1 over S9, Q7). Messages, roots and text objects are
    published below ``base``; roots dispatched by earlier runs count as known."""
    from skein.streaming import queues as qu
    known = store.select("user_id").unionByName(_stored(spark, base, "roots", "user_id STRING")).distinct()

    def step(messages: DataFrame, run: int) -> dict[str, DataFrame]:
        out = qu.dispatch_roots(messages.drop("msg_id", "sent_at"), known)
        return {"messages": out["messages"], "objects": out["objects"], "roots": out["roots"]}

    qu.run_worker(spark, landing, f"{_PERSON}, {_MESSAGE}", base, step)


_POSTS_STATUS = "user_id STRING, retweeter_status STRING, retweeter_last_processed STRING, last_tweeted_at STRING, run BIGINT"
_DONE = "root_id STRING, tweet_id STRING, at STRING, run BIGINT"


def posts_worker(spark, landing: str, roots: DataFrame, base: str, now: str) -> None:
    """One run of the posts worker (Q2): landed posts of roots become text objects, messages for
    their retweeters and a status row of each root that the run has posts of (``retweeter_statuses`` folds them)."""
    from skein.streaming import queues as qu

    def step(posts: DataFrame, run: int) -> dict[str, DataFrame]:
        mine = roots.join(posts.select(F.col("root_id").alias("user_id")), "user_id", "left_semi")
        out = qu.dispatch_tweets(posts.drop("msg_id", "sent_at"), mine, now)
        return out | {"status": out["status"].withColumn("run", F.lit(run).cast("long"))}

    qu.run_worker(spark, landing, "root_id STRING, tweet_id STRING, tweet_text STRING, retweet_count BIGINT, "
                                  f"created_on STRING, {_MESSAGE}", base, step)


def retweeter_statuses(spark, posts_base: str, retweeters_base: str) -> DataFrame:
    """Q2, Q5, Q6 over all published runs of the posts and the retweeters worker: one status per root."""
    from skein.streaming import queues as qu
    return qu.current_retweeter_status(_stored(spark, posts_base, "status", _POSTS_STATUS),
                                       _stored(spark, posts_base, "messages", "tweet_id STRING, target_user_id STRING"),
                                       _stored(spark, retweeters_base, "done", _DONE))


def followers_worker(spark, landing: str, roots: DataFrame, store: DataFrame, base: str, further: bool = True,
                     now: str = "") -> None:
    """One run of the followers worker (Q3): new vertices, new FOLLOWS edges, statuses and, with
    ``further``, messages to followers that qualify as roots. ``store`` holds the vertices known
    from elsewhere; what earlier runs published below ``base`` counts as known too. A root whose landing has no
    follower (a record with ``root_id`` alone) becomes ``failed``. ``status_log`` holds the statuses of all runs."""
    from skein.streaming import queues as qu
    from skein.streaming.runs import fold_status
    ddl = f"{_PERSON}, root_id STRING, ord BIGINT, pos BIGINT"
    vertices = store.unionByName(_stored(spark, base, "vertices", _PERSON)).select(*store.columns)
    edges = _stored(spark, base, "follows", "src STRING, dst STRING, weight BIGINT")

    def step(messages: DataFrame, run: int) -> dict[str, DataFrame]:
        mine = roots.join(messages.select(F.col("root_id").alias("user_id")), "user_id", "left_semi")
        out = qu.process_followers(mine, messages.drop("msg_id", "sent_at"), vertices, further, edges)
        log = out["status"].select("user_id", F.lit("follower").alias("kind"), F.col("follower_status").alias("status"),
                                   F.lit(now).alias("at"), F.lit(run).cast("long").alias("run"))
        new = {"vertices": out["vertices"].join(vertices.select("user_id"), "user_id", "left_anti").select(*store.columns),
               "follows": out["follows"].join(edges, ["src", "dst"], "left_anti"), "status": out["status"], "status_log": log}
        return new | ({"messages": out["dispatch"]} if further else {})

    qu.run_worker(spark, landing, f"{ddl}, {_MESSAGE}", base, step, {"status_log": fold_status})


def follower_statuses(spark, base: str) -> DataFrame:
    """Q6 over all published runs of the followers worker: one status per root. A root that has had followers once is
    ``completed``, also if a later landing has none."""
    from skein.streaming.runs import STATUS_LOG
    log = _stored(spark, base, "status_log", STATUS_LOG)
    any_ = F.max(F.when(F.col("status") == "completed", F.struct("at", "run")))
    last = F.max(F.struct("at", "run"))
    return log.groupBy("user_id").agg(any_.alias("c"), last.alias("l")).select(
        "user_id", F.when(F.col("c").isNotNull(), "completed").otherwise("failed").alias("follower_status"),
        F.coalesce("c.at", "l.at").alias("follower_last_processed"))


def retweeters_worker(spark, landing: str, posts: DataFrame, store: DataFrame, base: str, now: str = "") -> None:
    """One run of the retweeters worker (Q4, G11): new vertices, new (pair, post) records and messages
    to retweeters that qualify as roots. An edge's weight is its number of records (``edge_weights``),
    so runs only append. ``posts`` holds the queued posts (tweet_id, target_user_id). Every queued post that has
    landed, with retweeters or (a record without ``user_id``) without, is ``done``, which completes its root (Q5)."""
    from skein.sources.readers import empty
    from skein.streaming import queues as qu
    vertices = store.unionByName(_stored(spark, base, "vertices", _PERSON)).select(*store.columns)
    ids = _stored(spark, base, "edge_tweets", "src STRING, dst STRING, tweet_id STRING, ord BIGINT")

    def step(messages: DataFrame, run: int) -> dict[str, DataFrame]:
        out = qu.process_retweeters(posts, messages.drop("msg_id", "sent_at"), vertices,
                                    empty(spark, "src STRING, dst STRING, weight BIGINT"), ids)
        done = messages.select("root_id", "tweet_id").distinct().join(
            posts.select("tweet_id", F.col("target_user_id").alias("root_id")), ["root_id", "tweet_id"], "left_semi")
        return {"vertices": out["vertices"].join(vertices.select("user_id"), "user_id", "left_anti").select(*store.columns),
                "edge_tweets": out["edge_tweets"].join(ids, ["src", "dst", "tweet_id"], "left_anti")
                .select("src", "dst", "tweet_id", "ord"), "messages": out["dispatch"],
                "done": done.select("root_id", "tweet_id", F.lit(now).alias("at"), F.lit(run).cast("long").alias("run"))}

    qu.run_worker(spark, landing, f"{_PERSON}, root_id STRING, tweet_id STRING, ord BIGINT, pos BIGINT, {_MESSAGE}", base, step)


_TOPIC_USER, _TOPIC_TWEET = "user_id STRING, location STRING", "tweet_id STRING, target_user_id STRING, location STRING"


def collection_loop(spark, base: str, seeds: DataFrame, posts: DataFrame, followers: DataFrame, retweeters: DataFrame,
                    now: str = "") -> dict[str, DataFrame]:
    """Q1-Q5 as one closed loop: seeds are dispatched to the topics, and the consumers of the topics run until no topic
    has unread rows. A follower or retweeter that qualifies as a root is dispatched in turn.

    ``seeds`` and the people of the landed pages have the vertex shape; pages also have ``root_id``, ``ord`` and
    ``pos`` (and ``tweet_id``). Returns the published vertices, follows, edge_tweets and the status of each root.
    A consumer reads whole topic increments, so the number of runs is that of the hops, not of the users.
    """
    from skein.sources.readers import empty
    from skein.streaming import queues as qu
    from skein.streaming.runs import RunStore, consume, fold_status
    store = RunStore(spark, base, {"status_log": fold_status})
    people = lambda: store.read("vertices", _PERSON)

    def topics(messages: DataFrame) -> dict[str, DataFrame]:
        return {t: messages.filter(F.col("topic") == t).select("user_id", "location")
                for t in (qu.TOPIC_TWEETS, qu.TOPIC_FOLLOWERS)}

    def new_people(all_: DataFrame) -> DataFrame:
        return all_.join(people().select("user_id"), "user_id", "left_anti")

    def log(df: DataFrame, kind: str) -> DataFrame:
        return df.select("user_id", F.lit(kind).alias("kind"), F.col(f"{kind}_status").alias("status"),
                         F.lit(now).alias("at"), F.lit(store.manifest()["run"] + 1).cast("long").alias("run"))

    def on_posts(rows: DataFrame) -> dict[str, DataFrame]:
        roots = rows.select("user_id", F.col("location").alias("target_location")).distinct()
        out = qu.dispatch_tweets(posts, roots, now)
        return {qu.TOPIC_RETWEETERS: out["messages"], "objects": out["objects"],
                "posts_status": out["status"].withColumn("run", F.lit(store.manifest()["run"] + 1).cast("long"))}

    def on_followers(rows: DataFrame) -> dict[str, DataFrame]:
        roots = rows.select("user_id").distinct()
        mine = stored(followers.join(roots.withColumnRenamed("user_id", "root_id"), "root_id", "left_semi"), "pages")
        edges = store.read("follows", "src STRING, dst STRING, weight BIGINT")
        out = qu.process_followers(roots, mine, people(), True, edges)
        return {"vertices": new_people(out["vertices"]), "follows": out["follows"].join(edges, ["src", "dst"], "left_anti"),
                "status_log": log(out["status"], "follower"), **topics(out["dispatch"])}

    def on_retweeters(rows: DataFrame) -> dict[str, DataFrame]:
        ids = store.read("edge_tweets", "src STRING, dst STRING, tweet_id STRING, ord BIGINT")
        mine = stored(retweeters.join(rows.select("tweet_id", F.col("target_user_id").alias("root_id")),
                                      ["tweet_id", "root_id"], "left_semi"), "pages")
        out = qu.process_retweeters(rows, mine, people(), empty(spark, "src STRING, dst STRING, weight BIGINT"), ids)
        done = rows.select(F.col("target_user_id").alias("root_id"), "tweet_id", F.lit(now).alias("at"),
                           F.lit(store.manifest()["run"] + 1).cast("long").alias("run"))
        return {"vertices": new_people(out["vertices"]), "done": done,
                "edge_tweets": out["edge_tweets"].join(ids, ["src", "dst", "tweet_id"], "left_anti")
                .select("src", "dst", "tweet_id", "ord"), **topics(out["dispatch"])}

    if store.manifest()["run"] == 0:
        start = store.begin()
        start.stage("vertices", seeds.select(*people().columns).dropDuplicates(["user_id"]))
        for topic in (qu.TOPIC_TWEETS, qu.TOPIC_FOLLOWERS):
            start.stage(topic, seeds.select("user_id", F.col("target_location").alias("location")).distinct())
        start.publish()
    consumers = [("posts", qu.TOPIC_TWEETS, _TOPIC_USER, on_posts), ("followers", qu.TOPIC_FOLLOWERS, _TOPIC_USER, on_followers),
                 ("retweeters", qu.TOPIC_RETWEETERS, _TOPIC_TWEET, on_retweeters)]
    moved = True
    while moved:
        moved = False
        for consumer, topic, ddl, step in consumers:
            got = store.unread(consumer, topic, ddl)
            if got is None:
                continue
            if got[0].isEmpty():  # nothing was said: only the offset moves
                store.begin().publish({consumer: {topic: got[1]}})
            else:
                moved |= consume(store, consumer, topic, ddl, step)
    return {"vertices": people(), "follows": store.read("follows", "src STRING, dst STRING, weight BIGINT"),
            "edge_tweets": store.read("edge_tweets", "src STRING, dst STRING, tweet_id STRING, ord BIGINT"),
            "roots": store.read(qu.TOPIC_FOLLOWERS, _TOPIC_USER).distinct(),
            "status": qu.current_retweeter_status(store.read("posts_status", _POSTS_STATUS),
                                                  store.read(qu.TOPIC_RETWEETERS, _TOPIC_TWEET), store.read("done", _DONE))}


def edge_weights(edge_tweets: DataFrame) -> DataFrame:
    """RETWEETED edges of the (pair, post) records."""
    return edge_tweets.groupBy("src", "dst").agg(F.countDistinct("tweet_id").alias("weight"))


def classify_worker(spark, landing: str, base: str, template: str, client) -> None:
    """One run of the classification worker (Q8): landed text objects -> prompts -> replies of
    ``client`` (M8) -> category (X17); one row per user."""
    from skein.functions.text import parse_category
    from skein.streaming import queues as qu

    def step(objects: DataFrame, run: int) -> dict[str, DataFrame]:
        replies = cl.score_with_prompts(qu.render_queue_prompts(objects, template), "user_id", "prompt", client)
        return {"classified": replies.select("user_id", "reply", parse_category("reply").alias("category"))}

    qu.run_worker(spark, landing, f"user_id STRING, name STRING, value STRING, {_MESSAGE}", base, step)
