"""Lookups and attachments between record families.

Joins are declared and left to Catalyst/AQE: a side is broadcast only when its
runtime size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; all
other joins are shuffle joins on the key, with AQE splitting skewed partitions.
Per-key reductions (last date, counts) are hash aggregates with partial
aggregation, so hot authors/targets are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import date10


def attach_tweets(users: DataFrame, tweets: DataFrame, user_key: str = "user_id",
                  author: str = "author_id", text: str = "tweet_text", order: str = "ord",
                  extra: tuple[str, ...] = ("tweet_id",)) -> DataFrame:
    """J1 in long form: every user with each of its posts appended after its own.

    One row per (user, post); a user without posts keeps one row with null text.
    ``seq`` orders a user's posts: the user's own ``tweets`` array first (if any),
    then authored posts by arrival. The nested record shape is a sink concern
    (``to_nested``), so no task ever holds all posts of a prolific author.
    """
    own = None
    if "tweets" in users.columns:
        own = users.select(F.col(user_key), F.posexplode("tweets").alias("pos", text)) \
            .select(user_key, F.lit(0).alias("src"), F.col("pos").cast("bigint").alias("seq"), text,
                    *[F.lit(None).cast("string").alias(c) for c in extra if c in tweets.columns])
    authored = tweets.select(F.col(author).alias(user_key), F.lit(1).alias("src"),
                             F.col(order).cast("bigint").alias("seq"), F.col(text),
                             *[F.col(c) for c in extra if c in tweets.columns])
    posts = authored if own is None else own.unionByName(authored)
    base = users.drop("tweets") if "tweets" in users.columns else users
    # Posts inner-join users (the hot side is the splittable, streamed side of an
    # inner join), then users without any post are added back with null text.
    with_posts = posts.join(base, user_key, "inner")
    without = base.join(posts.select(user_key), user_key, "left_anti")
    return with_posts.unionByName(without, allowMissingColumns=True)


def attach_date(users: DataFrame, tweets: DataFrame, default: Column | str | None = None,
                user_key: str = "user_id", author: str = "author_id", created: str = "created_on",
                order: str = "ord") -> DataFrame:
    """The date of the author's last post wins (10-char date); default when none."""
    last = tweets.groupBy(F.col(author).alias(user_key)).agg(
        F.max_by(date10(created), F.col(order)).alias("__last_date"))
    out = users.join(last, user_key, "left")
    fallback = F.lit(None).cast("string") if default is None else (
        F.lit(default) if isinstance(default, str) else default)
    return out.withColumn("tweet_date", F.coalesce(F.col("__last_date"), fallback)).drop("__last_date")


def attach_date_backfill(users: DataFrame, tweets: DataFrame, user_key: str = "user_id",
                         author: str = "author_id", created: str = "created_on",
                         order: str = "ord") -> DataFrame:
    """Backfill ``tweet_date`` from deduped posts; a user without a post keeps its own.

    The reference lost the date of a user that had none yet; the evident intent
    (set it) is implemented.
    """
    last = tweets.groupBy(F.col(author).alias(user_key)).agg(
        F.max_by(date10(created), F.col(order)).alias("__last_date"))
    out = users.join(last, user_key, "left")
    keep = F.col("tweet_date") if "tweet_date" in users.columns else F.lit(None).cast("string")
    return out.withColumn("tweet_date", F.coalesce(F.col("__last_date"), keep)).drop("__last_date")


def zip_batches(tweets: DataFrame, users: DataFrame, pos: str = "batch", author: str | None = None,
                user_key: str = "user_id") -> DataFrame:
    """I-th post batch with i-th user batch; unmatched batches drop (truncate).

    ``tweets`` and ``users`` hold one row per batch, or, with ``author``, the batches' records: then
    posts meet the users of their own batch by id (batches are never multiplied out)."""
    if author is None:
        return tweets.join(users, pos, "inner")
    return tweets.join(users.withColumnRenamed(user_key, author), [pos, author], "inner")


def unprocessed(users: DataFrame, done: DataFrame, key: str = "user_id") -> DataFrame:
    """Users whose id is not in the output yet."""
    return users.join(done.select(key), key, "left_anti")


def exists_in(users: DataFrame, vertices: DataFrame, key: str = "user_id",
              vkey: str = "id") -> DataFrame:
    """Users that already exist as a vertex."""
    return users.join(vertices.select(F.col(vkey).alias(key)), key, "left_semi")


def count_city_edges(roots: DataFrame, edges: DataFrame, root_key: str = "user_id",
                     target: str = "target", out: str = "n_edges") -> DataFrame:
    """Per root, the number of edges pointing at it (0 kept)."""
    counts = edges.groupBy(F.col(target).alias(root_key)).agg(F.count(F.lit(1)).alias(out))
    return roots.join(counts, root_key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def with_cached_attributes(nested: DataFrame, cache: DataFrame, key: str = "user_id") -> DataFrame:
    """Replace each record by its cached version when one exists (left join).

    ``cache`` holds one row per key (the attribute store is keyed).
    """
    cols = [c for c in nested.columns if c != key]
    shared = [c for c in cols if c in cache.columns]
    cached = cache.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__c_{c}") for c in shared])
    j = nested.join(cached, key, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    sel = [F.col(key)] + [
        (F.when(hit, F.col(f"__c_{c}")).otherwise(F.col(c)) if c in shared else F.col(c)).alias(c)
        for c in cols]
    return j.select(*sel)


def edge_endpoints(edges: DataFrame, vertices: DataFrame, src: str = "source", dst: str = "target",
                   vkey: str = "user_id") -> DataFrame:
    """Keep an edge only if both endpoints exist (two semi joins)."""
    v = vertices.select(F.col(vkey).alias("__v")).distinct()
    e = edges.join(v, edges[src] == v["__v"], "left_semi")
    return e.join(v, e[dst] == v["__v"], "left_semi")


def attribute(vertices: DataFrame, key: str, value, col: str) -> DataFrame:
    """0 rows -> null, 1 row -> its value, more -> error (checked in the plan)."""
    rows = vertices.filter(F.col(key) == F.lit(value)).select(col)
    agg = rows.agg(F.count(F.lit(1)).alias("__n"), F.first(col).alias(col))
    return agg.select(F.when(F.col("__n") <= 1, F.col(col))
                      .otherwise(F.raise_error(F.lit(f"more than one vertex with {key}={value}")))
                      .alias(col))


def user_catalog(roots: DataFrame, retweeters: DataFrame, followers: DataFrame,
                 stored: DataFrame | None, order_cols=("ord", "pos")) -> DataFrame:
    """Distinct users across roots, retweeters (of originals) and followers, not yet stored.

    The reference kept only the last retweeter of each tweet; all are kept here.
    First occurrence in traversal order wins (roots, then retweeters, then followers).
    """
    from skein.operators.dedupe import first_occurrence
    cols = ["user_id", "username", "profile_location", "followers_count"]
    r = roots.select(*cols, F.lit(0).alias("__src"), F.col("ord").cast("bigint").alias("__o"),
                     F.lit(0).cast("bigint").alias("__p"))
    t = retweeters.select(*cols, F.lit(1).alias("__src"), F.col(order_cols[0]).cast("bigint").alias("__o"),
                          F.col(order_cols[1]).cast("bigint").alias("__p"))
    f = followers.select(*cols, F.lit(2).alias("__src"), F.col(order_cols[0]).cast("bigint").alias("__o"),
                         F.col(order_cols[1]).cast("bigint").alias("__p"))
    allu = r.unionByName(t).unionByName(f)
    first = first_occurrence(allu, "user_id", ["__src", "__o", "__p"]).drop("__src", "__o", "__p")
    if stored is not None:
        first = first.join(stored.select("user_id"), "user_id", "left_anti")
    return first


def recent_per_user(tweets: DataFrame, users: DataFrame, per_user_cap: int = 5,
                    author: str = "author_id", order: str = "ord") -> DataFrame:
    """At most min(tweet_count, 5) most recent posts per user (the API's extra-posts size)."""
    from skein.operators.analysis import per_group_first_n
    t = tweets.join(users.select(F.col("user_id").alias(author), F.col("tweets_count")), author)
    n = F.least(F.col("tweets_count"), F.lit(per_user_cap))
    return per_group_first_n(t, [author], [F.col(order).desc()], n, bound=per_user_cap).drop("rn")
