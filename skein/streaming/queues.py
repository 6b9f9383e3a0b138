"""Work queues as Structured Streaming jobs.

The reference polls four message queues one message at a time. Here a queue is
a landing folder of JSON message files read with ``readStream`` and processed
in micro-batches; every step is the same DataFrame transform as its batch form
(``dispatch_roots``, ``dispatch_tweets``, ...), so stream and batch give the
same rows. Delivery is at least once: the streaming checkpoint records which
files were consumed, and a run's outputs are published in one step
(``skein.streaming.runs``), so a replayed batch changes nothing. No message is dropped for its time: repeats are
found by an anti join with the stored ids of handled messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.predicates import is_original, qualifies_as_root
from skein.operators.dedupe import keep_first, row_order
from skein.operators.long_lists import CHUNK, in_chunks, text_parts
from skein.operators.upsert import upsert_vertices
from skein.session import stored
from skein.sources import schemas

TOPIC_TWEETS, TOPIC_FOLLOWERS, TOPIC_RETWEETERS, TOPIC_CLASSIFY = (
    "UserTweets", "UserFollowers", "UserRetweeters", "UserClassification")


# --------------------------------------------------------------------------- sources / sinks
def read_queue(spark: SparkSession, path: str, ddl: str, max_files_per_trigger: int = 100) -> DataFrame:
    """A streaming DataFrame over a landing folder of JSON message files; every message of
    every file comes through, however late it lands."""
    return spark.readStream.schema(schemas.struct_type(ddl)).option("maxFilesPerTrigger", max_files_per_trigger) \
        .json(path)


def unhandled(messages: DataFrame, handled: DataFrame) -> DataFrame:
    """Messages whose ``msg_id`` is not among the handled ones, one per id (the first landed).
    Messages without an id are all kept: nothing says that they are repeats."""
    named = messages.filter(F.col("msg_id").isNotNull())
    order = [c for c in ("landed_id",) if c in named.columns]  # where messages landed, else their values
    first = keep_first(named, ["msg_id"], order or [c for c in named.columns if c != "msg_id"])
    return first.join(handled.select("msg_id"), "msg_id", "left_anti").select(*messages.columns) \
        .unionByName(messages.filter(F.col("msg_id").isNull()))


def run_worker(spark: SparkSession, landing: str, ddl: str, base: str, step, folds=None) -> dict[str, int]:
    """Q7: one run of a queue worker. A stream lands what has arrived in the run's own folder (its checkpoint
    records the files); ``step(messages, run number)`` maps the messages to named outputs, which are staged and
    published together with the ids of the messages (``runs.RunStore``). A run that dies leaves nothing that
    anybody reads; its retry sees the same messages and the same published tables.

    A message id handled before is a repeat. A message without an id is handled once as well: it is the landed row
    that counts, so equal ones are all handled. ``RunStore(spark, base).table(name)`` reads an output.

    The step runs as a batch: no callback from the stream into Python is needed.
    """
    from skein.streaming.runs import RunStore
    store = RunStore(spark, base, folds)
    run = store.begin()
    landed = run.land(landing, ddl)
    if landed.isEmpty():
        return {}
    fresh = unhandled(landed, store.read("handled", "msg_id STRING"))
    for name, out in step(fresh.drop("landed_id"), run.number).items():
        run.stage(name, out)
    run.stage("handled", fresh.filter("msg_id IS NOT NULL").select("msg_id"))
    run.publish()
    written = dict.fromkeys(run.staged, 1)
    store.compact()
    return written


def write_messages(messages: DataFrame, path: str, checkpoint: str, partition_by: str | None = "topic",
                   key: str | None = None):
    """Q9: a message sink: JSON files per topic. With ``key`` (e.g. the target user of
    post messages) each micro-batch is hash-partitioned by it, so all messages of one
    key land in one file of the batch in arrival order (FIFO per key)."""
    out = messages.repartition(key) if key else messages
    w = out.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if partition_by and partition_by in messages.columns:
        w = w.partitionBy(partition_by)
    return w


def run_available(stream_writer) -> None:
    """Process everything that has landed, then stop (``availableNow``)."""
    q = stream_writer.trigger(availableNow=True).start()
    q.awaitTermination()


# --------------------------------------------------------------------------- batch-form steps
def dispatch_roots(users: DataFrame, vertices: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Q1: users passing the root rule (F6, not yet a vertex) become vertices, get a
    description object and one message each to the posts and followers queues;
    their ``follower_status`` becomes ``queued``.

    ``users`` holds the P5 vertex shape; ``vertices`` the current store (key column).
    """
    known = vertices.select(F.col(key).alias("__k"), F.lit(True).alias("__known"))
    once = users if users.isStreaming else keep_first(users, [key], row_order(users, key))
    fresh = once.join(known, once[key] == known["__k"], "left").filter(F.col("__known").isNull()) \
        .drop("__k", "__known")
    roots = fresh.filter(qualifies_as_root("city", "target_location", "followers_count", "tweets_count"))
    msgs = roots.select(key, F.col("target_location").alias("location"),
                        F.explode(F.array(F.lit(TOPIC_TWEETS), F.lit(TOPIC_FOLLOWERS))).alias("topic"))
    desc = F.col("description") if "description" in users.columns else F.lit(None).cast("string")
    objects = roots.select(F.col("target_location").alias("location"), key, F.lit("description").alias("name"),
                           F.coalesce(desc, F.lit("")).alias("value"))
    queued = roots.withColumn("follower_status", F.lit("queued"))
    return {"roots": queued, "messages": msgs, "objects": objects}


def dispatch_tweets(tweets: DataFrame, roots: DataFrame, now: str) -> dict[str, DataFrame]:
    """Q2: per root, originals are stored as text objects; originals with reposts are
    queued (one message per post, keyed by the root); ``retweeter_status`` is
    ``queued`` if any post was queued, else ``completed`` (with time);
    ``last_tweeted_at`` is the latest post, reposts included (A12)."""
    t = tweets.join(roots.select(F.col("user_id").alias("root_id"), F.col("target_location").alias("location")),
                    "root_id")
    orig = t.filter(is_original("tweet_text"))
    objects = orig.select("location", F.col("root_id").alias("user_id"),
                          F.concat(F.lit("tweet_"), "tweet_id").alias("name"), F.col("tweet_text").alias("value"))
    queued = orig.filter(F.col("retweet_count") > 0)
    msgs = queued.select("tweet_id", F.col("root_id").alias("target_user_id"), "location")
    per_root = t.groupBy("root_id").agg(
        F.max("created_on").alias("last_tweeted_at"),
        F.sum(F.when(is_original("tweet_text") & (F.col("retweet_count") > 0), 1).otherwise(0)).alias("n_queued"))
    status = roots.select("user_id").join(per_root, roots["user_id"] == per_root["root_id"], "left").select(
        "user_id", F.when(F.coalesce("n_queued", F.lit(0)) > 0, F.lit("queued")).otherwise(F.lit("completed"))
        .alias("retweeter_status"),
        F.when(F.coalesce("n_queued", F.lit(0)) > 0, F.lit(None).cast("string")).otherwise(F.lit(now))
        .alias("retweeter_last_processed"),
        "last_tweeted_at")
    return {"objects": objects, "messages": msgs, "status": status}


def retweeter_completion(expected: DataFrame, processed: DataFrame) -> DataFrame:
    """Q5: a root's retweeter work is complete when every queued post of it has been
    processed (counts instead of the reference's "next target arrived" rule)."""
    e = expected.groupBy("target_user_id").agg(F.countDistinct("tweet_id").alias("n_expected"))
    p = processed.select("target_user_id", "tweet_id").distinct().groupBy("target_user_id").agg(
        F.count(F.lit(1)).alias("n_done"))
    j = e.join(p, "target_user_id", "left").withColumn("n_done", F.coalesce("n_done", F.lit(0)))
    return j.withColumn("retweeter_status", F.when(F.col("n_done") >= F.col("n_expected"), "completed")
                        .otherwise("pending"))


def current_retweeter_status(posts_status: DataFrame, expected: DataFrame, done: DataFrame) -> DataFrame:
    """Q2 + Q5 over all runs: one row per root. ``queued`` while a queued post of it is not processed (Q5), however many
    posts without reposts come later; else ``completed`` at the latest time known for it. ``last_tweeted_at``
    is the latest of all runs."""
    both = done.select(F.col("root_id").alias("target_user_id"), "tweet_id", "at")
    want = expected.select(F.col("target_user_id"), "tweet_id").distinct()
    ends = both.groupBy("target_user_id", "tweet_id").agg(F.min("at").alias("at"))
    per_root = want.join(ends, ["target_user_id", "tweet_id"], "left").groupBy(F.col("target_user_id").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n_expected"), F.count("at").alias("n_done"), F.max("at").alias("done_at"))
    seen = posts_status.groupBy("user_id").agg(F.max("last_tweeted_at").alias("last_tweeted_at"),
                                               F.max("retweeter_last_processed").alias("at"))
    j = seen.join(per_root, "user_id", "full_outer")
    open_ = F.coalesce(F.col("n_done") < F.col("n_expected"), F.lit(False))
    return j.select("user_id", F.when(open_, "queued").otherwise("completed").alias("retweeter_status"),
                    F.when(~open_, F.greatest("at", "done_at")).alias("retweeter_last_processed"), "last_tweeted_at",
                    F.coalesce("n_expected", F.lit(0)).alias("n_expected"), F.coalesce("n_done", F.lit(0)).alias("n_done"))


def process_followers(roots: DataFrame, followers: DataFrame, vertices: DataFrame,
                      further: bool = False, edges: DataFrame | None = None) -> dict[str, DataFrame]:
    """Q3: followers become vertices (G9) and FOLLOWS edges (G10); with ``further``
    qualifying followers are dispatched as new roots (snowball, Q1 rule); a root
    with followers is ``completed``, one without any is ``failed``."""
    from skein.operators.upsert import upsert_follows
    followers = followers.filter(F.col("user_id").isNotNull())  # a landing of no followers is a record of the root alone
    shape = [c for c in followers.columns if c not in ("root_id", "ord", "pos")]
    fv = keep_first(followers, ["user_id"], ["root_id", *row_order(followers, "user_id")]).select(*shape)
    if not followers.isStreaming:
        fv = stored(fv, "followers")  # read by the vertices, the edges and the dispatch
    new_vertices = upsert_vertices(vertices, fv)
    e = followers.select(F.col("user_id").alias("src"), F.col("root_id").alias("dst"))
    known = e.limit(0).withColumn("weight", F.lit(1).cast("bigint")) if edges is None else edges
    follows = upsert_follows(known, e, new_vertices)
    n = followers.groupBy("root_id").agg(F.count(F.lit(1)).alias("n"))
    status = roots.select("user_id").join(n, roots["user_id"] == n["root_id"], "left").select(
        "user_id", F.when(F.coalesce("n", F.lit(0)) > 0, "completed").otherwise("failed").alias("follower_status"))
    out = {"vertices": new_vertices, "follows": follows, "status": status}
    if further:
        out["dispatch"] = dispatch_roots(fv, vertices)["messages"]
    return out


def process_retweeters(tweet_msgs: DataFrame, retweeters: DataFrame, vertices: DataFrame,
                       edges: DataFrame, edge_tweets: DataFrame) -> dict[str, DataFrame]:
    """Q4: retweeters of queued posts become vertices (G9), qualifying ones are
    dispatched as roots (Q1 rule), and RETWEETED edges are upserted (G11, idempotent:
    Q7 at-least-once delivery replays a message without changing the store)."""
    from skein.operators.upsert import upsert_retweets
    r = retweeters.filter(F.col("user_id").isNotNull()).join(tweet_msgs.select("tweet_id", F.col("target_user_id").alias("root_id")),
                        ["tweet_id", "root_id"], "left_semi")
    once = keep_first(r, ["user_id"], ["ord", "pos", "root_id", "tweet_id"])  # the same row in every attempt
    if not retweeters.isStreaming:
        once = stored(once, "retweeters")  # read by the vertices, the edges and the dispatch
    new_vertices = upsert_vertices(vertices, once.drop("tweet_id", "root_id", "ord", "pos"))
    batch = r.select(F.col("user_id").alias("src"), F.col("root_id").alias("dst"), "tweet_id",
                     F.col("ord").cast("bigint").alias("ord"))
    e, ids = upsert_retweets(edges, edge_tweets, batch, new_vertices)
    dispatch = dispatch_roots(once.drop("tweet_id", "root_id", "ord", "pos"), vertices)
    return {"vertices": new_vertices, "edges": e, "edge_tweets": ids, "dispatch": dispatch["messages"]}


def classify_queue(objects: DataFrame) -> DataFrame:
    """Q8: a user's stored objects -> (description, posts) for prompting; a user with
    one post keeps it (the reference's "> 1" test dropped it). The posts of a user are put together from
    chunks into the one list that a prompt takes; ``prompt_parts`` is the form without that list."""
    d = objects.filter(F.col("name") == "description").select("user_id", F.col("value").alias("description"))
    chunks = in_chunks(objects.filter(F.col("name") != "description"), ["user_id"], ["name"], "value")
    t = chunks.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "values"))).alias("__t"))
    return d.join(t, "user_id", "full_outer").select(
        "user_id", "description", F.coalesce(F.flatten(F.transform("__t", lambda p: p["values"])),
                                             F.array().cast("array<string>")).alias("tweets"))


def render_queue_prompts(objects: DataFrame, template: str) -> DataFrame:
    """Q8 up to the model: one prompt per user from its stored text objects."""
    from skein.functions.text import render_prompt
    users = classify_queue(objects)
    return users.select("user_id", render_prompt(template, F.coalesce("description", F.lit("")), F.col("tweets")).alias("prompt"))


def prompt_parts(objects: DataFrame, template: str, size: int = CHUNK) -> DataFrame:
    """Q8 for clients that take a prompt piece by piece: (user_id, part, text) rows, to be sent by ``part``; together
    they are the prompt of ``render_queue_prompts``. No row holds more than ``size`` posts."""
    head, _, tail = template.partition("user_tweets")
    if "user_tweets" in tail:
        raise ValueError("a template in parts names user_tweets once")
    d = objects.filter(F.col("name") == "description").select("user_id", F.col("value").alias("description"))
    posts = objects.filter(F.col("name") != "description")
    fill = lambda t: F.replace(F.lit(t), F.lit("user_description"), F.coalesce("description", F.lit("")))
    chunks = in_chunks(posts, ["user_id"], ["name"], "value", size).join(d, "user_id", "left")
    some = text_parts(chunks, ["user_id"], "\n", fill(head), fill(tail))
    none = d.join(posts.select("user_id").distinct(), "user_id", "left_anti").select(
        "user_id", F.lit(0).cast("bigint").alias("part"), F.concat(fill(head), fill(tail)).alias("text"))
    return some.unionByName(none)


def msg_schema(kind: str) -> str:
    return {"user": schemas.MSG_USER + ", topic STRING, msg_id STRING, sent_at STRING",
            "tweet": schemas.MSG_TWEET + ", msg_id STRING, sent_at STRING"}[kind]

