"""Queries for vertex/edge upserts, patches and status moves.

The store before the batch is built from interactions of orders placed before
1997; the batch holds interactions from mid-1996 on, so half a year of events is
replayed and must not change anything (idempotence).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import upsert as up
from skein.plans.registry import register, tables

OLD_BEFORE, NEW_FROM = "1997-01-01", "1996-07-01"

_STORE_SQL = f"""
v AS (SELECT user_id FROM fx_users WHERE followers_count > 0),
old_rows AS (SELECT source AS src, target AS dst, tweet_id, ord FROM fx_interactions WHERE ts < TIMESTAMP '{OLD_BEFORE}'),
old_edges AS (SELECT src, dst, count(*) AS weight FROM old_rows GROUP BY src, dst),
old_ids AS (SELECT src, dst, tweet_id, min(ord) AS ord FROM old_rows GROUP BY src, dst, tweet_id),
batch AS (SELECT source AS src, target AS dst, tweet_id, ord FROM fx_interactions WHERE ts >= TIMESTAMP '{NEW_FROM}'
  AND source IN (SELECT user_id FROM v) AND target IN (SELECT user_id FROM v)),
fresh AS (SELECT b.src, b.dst, b.tweet_id, min(b.ord) AS ord FROM batch b
  WHERE NOT EXISTS (SELECT 1 FROM old_ids o WHERE o.src = b.src AND o.dst = b.dst AND o.tweet_id = b.tweet_id)
  GROUP BY b.src, b.dst, b.tweet_id)"""


def _store(spark, sf_dir):
    users, inter = tables(spark, sf_dir, "fx_users", "fx_interactions")
    v = users.filter("followers_count > 0").select("user_id")
    rows = inter.select(F.col("source").alias("src"), F.col("target").alias("dst"), "tweet_id", "ord", "ts")
    old = rows.filter(F.col("ts") < F.lit(OLD_BEFORE).cast("timestamp"))
    # The store before the batch is a written table in practice: materialise it once.
    from skein.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    old_edges = old.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")).checkpoint(eager=True)
    old_ids = old.groupBy("src", "dst", "tweet_id").agg(F.min("ord").alias("ord")).checkpoint(eager=True)
    batch = rows.filter(F.col("ts") >= F.lit(NEW_FROM).cast("timestamp")).drop("ts")
    return v, old_edges, old_ids, batch


@register("g11_upsert_retweets", f"""
WITH {_STORE_SQL},
add AS (SELECT src, dst, count(*) AS n FROM fresh GROUP BY src, dst)
SELECT coalesce(o.src, a.src) AS src, coalesce(o.dst, a.dst) AS dst,
  CAST(coalesce(o.weight, 0) + coalesce(a.n, 0) AS BIGINT) AS weight
FROM old_edges o FULL OUTER JOIN add a ON o.src = a.src AND o.dst = a.dst""")
def g11_upsert_retweets(spark, sf_dir):
    v, old_edges, old_ids, batch = _store(spark, sf_dir)
    edges, _ = up.upsert_retweets(old_edges, old_ids, batch, v)
    return edges


@register("g11_upsert_retweet_ids", f"""
WITH {_STORE_SQL}
SELECT src, dst, tweet_id, ord FROM old_ids UNION ALL SELECT src, dst, tweet_id, ord FROM fresh""")
def g11_upsert_retweet_ids(spark, sf_dir):
    v, old_edges, old_ids, batch = _store(spark, sf_dir)
    _, ids = up.upsert_retweets(old_edges, old_ids, batch, v)
    return ids


@register("g11_upsert_idempotent", f"""
WITH {_STORE_SQL},
add AS (SELECT src, dst, count(*) AS n FROM fresh GROUP BY src, dst)
SELECT coalesce(o.src, a.src) AS src, coalesce(o.dst, a.dst) AS dst,
  CAST(coalesce(o.weight, 0) + coalesce(a.n, 0) AS BIGINT) AS weight
FROM old_edges o FULL OUTER JOIN add a ON o.src = a.src AND o.dst = a.dst""")
def g11_upsert_idempotent(spark, sf_dir):
    """The same batch applied twice gives the store of one application."""
    v, old_edges, old_ids, batch = _store(spark, sf_dir)
    e1, i1 = up.upsert_retweets(old_edges, old_ids, batch, v)
    e2, _ = up.upsert_retweets(e1, i1, batch, v)
    return e2


@register("g11b_upsert_retweets_blind", f"""
WITH {_STORE_SQL},
add AS (SELECT src, dst, count(*) AS n FROM (SELECT source AS src, target AS dst FROM fx_interactions
  WHERE ts >= TIMESTAMP '{NEW_FROM}') b GROUP BY src, dst)
SELECT coalesce(o.src, a.src) AS src, coalesce(o.dst, a.dst) AS dst,
  CAST(coalesce(o.weight, 0) + coalesce(a.n, 0) AS BIGINT) AS weight
FROM old_edges o FULL OUTER JOIN add a ON o.src = a.src AND o.dst = a.dst""")
def g11b_upsert_retweets_blind(spark, sf_dir):
    _, old_edges, _, batch = _store(spark, sf_dir)
    return up.upsert_retweets_blind(old_edges, batch)


@register("g09_upsert_vertices", """
SELECT user_id, username FROM fx_users WHERE followers_count > 0
UNION ALL SELECT user_id, upper(username) FROM fx_users WHERE NOT (followers_count > 0)""")
def g09_upsert_vertices(spark, sf_dir):
    """Store = accounts with a positive balance; batch = all accounts (upper-cased names):
    only absent ids are inserted, existing vertices keep their properties."""
    (users,) = tables(spark, sf_dir, "fx_users")
    store = users.filter("followers_count > 0").select("user_id", "username")
    batch = users.select("user_id", F.upper("username").alias("username"), "ord")
    return up.upsert_vertices(store, batch)


@register("g10_upsert_follows", f"""
WITH {_STORE_SQL},
old_f AS (SELECT DISTINCT src, dst FROM old_rows),
new_f AS (SELECT DISTINCT src, dst FROM batch)
SELECT src, dst, CAST(1 AS BIGINT) AS weight FROM old_f
UNION ALL SELECT src, dst, CAST(1 AS BIGINT) FROM new_f n
WHERE NOT EXISTS (SELECT 1 FROM old_f o WHERE o.src = n.src AND o.dst = n.dst)""")
def g10_upsert_follows(spark, sf_dir):
    v, _, old_ids, batch = _store(spark, sf_dir)
    old_f = old_ids.select("src", "dst").distinct().withColumn("weight", F.lit(1).cast("bigint"))
    return up.upsert_follows(old_f, batch, v)


@register("g16_patch_vertex", """
SELECT u.user_id, CASE WHEN p.k IS NULL THEN u.username WHEN p.k % 2 = 0 THEN upper(p.n) ELSE lower(p.n) END AS username,
  CASE WHEN p.k IS NULL THEN u.search_location ELSE 'moved' END AS search_location
FROM fx_users u LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS user_id, s_suppkey AS k, s_name AS n FROM supplier) p
ON p.user_id = u.user_id""")
def g16_patch_vertex(spark, sf_dir):
    users, supplier = tables(spark, sf_dir, "fx_users", "supplier")
    key = F.col("s_suppkey").cast("string").alias("user_id")
    none = F.lit(None).cast("string")
    updates = (supplier.select(key, F.lower("s_name").alias("username"), none.alias("search_location"), F.lit(1).alias("at"))
               .unionAll(supplier.select(key, none, F.lit("moved"), F.lit(2)))
               .unionAll(supplier.filter("s_suppkey % 2 = 0").select(key, F.upper("s_name"), none, F.lit(3))))
    return up.patch_vertices(users.select("user_id", "username", "search_location"), updates, order="at")


@register("q06_status_lifecycle", """
WITH m AS (SELECT user_id, topic, ts,
  CASE topic WHEN 'view' THEN 'queued' WHEN 'click' THEN 'in progress' WHEN 'purchase' THEN 'completed'
    WHEN 'error' THEN 'failed' ELSE 'pending' END AS status FROM fx_queue),
r AS (SELECT *, CASE status WHEN 'pending' THEN 0 WHEN 'in progress' THEN 1 WHEN 'queued' THEN 1 ELSE 2 END AS rk FROM m),
best AS (SELECT user_id, arg_max(status, (rk, ts)) AS status, arg_max(ts, (rk, ts)) AS at FROM r GROUP BY user_id)
SELECT u.user_id, CASE WHEN b.status IS NOT NULL AND b.status <> 'pending' THEN b.status ELSE 'pending' END AS follower_status,
  CASE WHEN b.status IS NOT NULL AND b.status <> 'pending' THEN b.at END AS follower_last_processed
FROM fx_users u LEFT JOIN best b ON b.user_id = u.user_id""")
def q06_status_lifecycle(spark, sf_dir):
    """Every account starts pending; queue events move it forward only."""
    users, q = tables(spark, sf_dir, "fx_users", "fx_queue")
    v = users.select("user_id", F.lit("pending").alias("follower_status"),
                     F.lit(None).cast("timestamp_ntz").alias("follower_last_processed"))
    status = (F.when(F.col("topic") == "view", "queued").when(F.col("topic") == "click", "in progress")
              .when(F.col("topic") == "purchase", "completed").when(F.col("topic") == "error", "failed")
              .otherwise("pending"))
    upd = q.select("user_id", status.alias("status"), F.col("ts").alias("at"))
    return up.advance_status(v, upd, "follower_status", "follower_last_processed")
