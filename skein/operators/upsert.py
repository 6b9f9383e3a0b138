"""Idempotent vertex / edge upserts and property patches.

The graph store is three tables: ``vertices`` (id + properties), ``edges``
(src, dst, label, weight) and ``edge_tweets`` (src, dst, tweet_id, ord) for
RETWEETED edges. A batch is merged with anti joins and hash aggregates; the
result is written as a new version (see ``skein.sources.sinks.write_version``),
so a retried batch recomputes the same output (at-least-once delivery is safe).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.enrich import edge_endpoints

STATUS_ORDER = {"pending": 0, "in progress": 1, "queued": 1, "completed": 2, "failed": 2}


def upsert_vertices(vertices: DataFrame, new: DataFrame, key: str = "user_id") -> DataFrame:
    """Insert a vertex when its id is absent; existing vertices stay untouched.

    ``new`` may repeat an id; the first row per id (in landing order where there is one, then by
    its values, so that a retry inserts the same) is inserted.
    """
    from skein.operators.dedupe import keep_first, row_order
    fresh = new.join(vertices.select(key), key, "left_anti")
    fresh = keep_first(fresh, [key], row_order(fresh, key) or [key])
    return vertices.unionByName(fresh.select(*vertices.columns))


def upsert_follows(edges: DataFrame, new: DataFrame, vertices: DataFrame, key: str = "user_id") -> DataFrame:
    """Add (source, target) when absent and both endpoints exist."""
    cand = edge_endpoints(new.select("src", "dst").distinct(), vertices, "src", "dst", key)
    fresh = cand.join(edges.select("src", "dst"), ["src", "dst"], "left_anti")
    return edges.unionByName(fresh.withColumn("weight", F.lit(1).cast("bigint")).select(*edges.columns))


def upsert_retweets(edges: DataFrame, edge_tweets: DataFrame, new: DataFrame, vertices: DataFrame,
                    key: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """Absent pair -> weight 1 per new post; known (pair, post) -> no change;
    otherwise weight + 1 and the post id appended. Idempotent: replaying a batch
    changes nothing. The old weight may differ from its id count and is kept.

    ``new`` holds src, dst, tweet_id, ord. Returns (edges, edge_tweets).
    """
    cand = edge_endpoints(new.select("src", "dst", "tweet_id", "ord"), vertices, "src", "dst", key)
    first = cand.groupBy("src", "dst", "tweet_id").agg(F.min("ord").alias("ord"))
    fresh = first.join(edge_tweets.select("src", "dst", "tweet_id"), ["src", "dst", "tweet_id"], "left_anti")
    add = fresh.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("__add"))
    merged = edges.select("src", "dst", "weight").join(add, ["src", "dst"], "full_outer").select(
        "src", "dst", (F.coalesce("weight", F.lit(0)) + F.coalesce("__add", F.lit(0))).cast("bigint").alias("weight"))
    return merged, edge_tweets.unionByName(fresh.select(*edge_tweets.columns))


def upsert_retweets_blind(edges: DataFrame, new: DataFrame) -> DataFrame:
    """The older, non-idempotent form: every event adds 1."""
    add = new.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("__add"))
    return edges.select("src", "dst", "weight").join(add, ["src", "dst"], "full_outer").select(
        "src", "dst", (F.coalesce("weight", F.lit(0)) + F.coalesce("__add", F.lit(0))).cast("bigint").alias("weight"))


def patch_vertices(vertices: DataFrame, updates: DataFrame, key: str = "user_id", order: str | None = None) -> DataFrame:
    """Set the listed properties (single cardinality); null in ``updates`` keeps the old value.

    Several updates of one key are reduced first: the last non-null value by ``order`` wins (without
    an order column the greatest value does), so a vertex is never doubled.
    """
    cols = [c for c in updates.columns if c not in (key, order) and c in vertices.columns]
    last = (lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))) if order else F.max
    u = updates.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"),
                                                       *[last(c).alias(f"__u_{c}") for c in cols])
    j = vertices.join(u, vertices[key] == u["__key"], "left")
    return j.select(*[(F.coalesce(F.col(f"__u_{c}"), F.col(c)) if c in cols else F.col(c)).alias(c)
                      for c in vertices.columns])


def advance_status(vertices: DataFrame, updates: DataFrame, status_col: str, time_col: str,
                   key: str = "user_id") -> DataFrame:
    """Q6: apply a status change only along pending -> queued/in progress -> completed/failed.

    ``updates`` holds key, status, at. A backwards or unknown move is ignored.
    """
    order = F.create_map(*[x for k, v in STATUS_ORDER.items() for x in (F.lit(k), F.lit(v))])
    # One move per key: the most advanced status of the batch (ties: latest time).
    u = updates.groupBy(key).agg(F.max_by(F.struct(F.col("status").alias("__s"), F.col("at").alias("__t")),
                                          F.struct(order[F.col("status")], F.col("at"))).alias("__m")) \
        .select(key, "__m.__s", "__m.__t")
    j = vertices.join(u, key, "left")
    ok = F.coalesce(order[F.col("__s")] > order[F.coalesce(F.col(status_col), F.lit("pending"))], F.lit(False))
    return j.select(*[
        (F.when(ok, F.col("__s")).otherwise(F.col(c)) if c == status_col else
         F.when(ok, F.col("__t")).otherwise(F.col(c)) if c == time_col else F.col(c)).alias(c)
        for c in vertices.columns])


def city_must_exist(vertices: DataFrame, city: str, key: str = "id", label: str = "label") -> None:
    """stop before dispatching when the City vertex is missing (one ``isEmpty`` probe)."""
    if vertices.filter((F.col(key) == city) & (F.col(label) == "City")).isEmpty():
        raise ValueError(f"City vertex {city!r} does not exist")
