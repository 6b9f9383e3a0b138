"""Portable fixture views over the driver tables.

The reference consumes landed social-media records (users, posts, lists,
follower / retweeter records, queue messages). The driver provides TPC-H-like
tables instead, so each record family is a *view* over those tables. The same
SQL text runs in Spark (``register_views``) and in DuckDB (``with_prefix``), so
the oracle and the Spark query start from identical rows. All views grow with
the base tables; none filters rows away.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Words of the invented texts that stand for topic words in the classification queries.
KEYWORDS = {
    "environment or pollution": ["environment", "pollution", "air", "smog", "the"],
    "environmental research": ["research", "science", "university", "of"],
    "politician or policymaker": ["politics", "government", "minister", "de"],
    "nonprofit organization": ["ngo", "nonprofit", "charity", "and"],
    "news outlet or journalist": ["news", "journalist", "media", "la"],
    "healthcare professional": ["doctor", "health", "nurse", "der"],
}

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Ordered: a view may use the views above it.
VIEWS: dict[str, str] = {
    # accounts with locations, labels and counts
    "fx_users": """
SELECT CAST(c_custkey AS STRING) AS user_id, lower(c_name) AS username, c_name AS name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('bio ', c_mktsegment) END AS description,
  CASE c_custkey % 8 WHEN 0 THEN 'Kolkata, India' WHEN 1 THEN 'CALCUTTA' WHEN 2 THEN 'New York City'
    WHEN 3 THEN 'nyc ' WHEN 4 THEN 'Guatemala' WHEN 5 THEN 'Ciudad de Guatemala' WHEN 6 THEN '' ELSE NULL END AS location,
  CASE c_custkey % 3 WHEN 0 THEN 'kolkata' WHEN 1 THEN 'new york' ELSE 'guatemala' END AS search_location,
  c_mktsegment AS search_account_type,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS content_labels,
  CAST(floor(c_acctbal) AS BIGINT) AS followers_count, c_custkey % 5 AS tweets_count,
  CAST(c_nationkey AS BIGINT) AS following_count, c_custkey AS ord
FROM customer""",
    # posts; every 5th is a repost
    "fx_tweets": """
SELECT CAST(doc_id AS STRING) AS tweet_id, CAST(doc_id % 97 AS STRING) AS author_id,
  CASE WHEN doc_id % 5 = 0 THEN concat('RT @', source, ': ', text) ELSE text END AS tweet_text, lang,
  DATE '2025-01-01' + CAST(doc_id % 28 AS INT) AS created_on, n_chars % 7 AS retweet_count,
  doc_id AS ord
FROM documents""",
    # actor -> target interactions; ord/pos give arrival order
    "fx_interactions": """
SELECT CAST(o.o_custkey AS STRING) AS source, CAST(l.l_suppkey AS STRING) AS target,
  CAST(l.l_partkey AS STRING) AS tweet_id, l.l_orderkey AS ord, l.l_linenumber AS pos, o.o_orderdate AS ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    # curated lists
    "fx_lists": """
SELECT CAST(p_partkey AS STRING) AS list_id, CAST(p_partkey % 150 AS STRING) AS user_id,
  CASE p_partkey % 6 WHEN 0 THEN 'Air Quality' WHEN 1 THEN 'Repair shops' WHEN 2 THEN 'NGO directory'
    WHEN 3 THEN 'non profit' ELSE p_name END AS name,
  CASE p_partkey % 4 WHEN 0 THEN 'climate and smog' WHEN 1 THEN '' ELSE p_type END AS description,
  p_partkey AS ord
FROM part""",
    # queue messages: event_id is the landing sequence, event_type the topic
    "fx_queue": """
SELECT CAST(user_id AS STRING) AS user_id, event_type AS topic, event_id AS seq, ts,
  CAST(event_id % 10 AS BIGINT) AS page
FROM events""",
    # retweeters of each root's posts: a line item whose part key names a post
    "fx_net_retweeters": """
SELECT CAST(d.doc_id % 97 AS STRING) AS root_id, CAST(d.doc_id AS STRING) AS tweet_id,
  CAST(o.o_custkey AS STRING) AS user_id, l.l_orderkey AS ord, l.l_linenumber AS pos
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN documents d ON d.doc_id = l.l_partkey""",
}


def needed_views(sql: str) -> list[str]:
    """Fixture views referenced by ``sql``, with their dependencies, in order."""
    wanted: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for name in VIEWS:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                frontier.append(VIEWS[name])
    return [name for name in VIEWS if name in wanted]


def with_prefix(sql: str) -> str:
    """Prefix ``sql`` with the fixture views it needs as a WITH clause (DuckDB)."""
    names = needed_views(sql)
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def register_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Register the driver parquet tables as temp views (lazy, pruned scans)."""
    for name in names or BASE_TABLES:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


_REGISTERED: dict[int, str] = {}


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register base tables and fixture views once per (session, folder)."""
    key = id(spark)
    if _REGISTERED.get(key) == sf_dir and spark.catalog.tableExists("fx_users"):
        return
    register_tables(spark, sf_dir)
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)
    _REGISTERED[key] = sf_dir


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view (or base table) as a DataFrame over ``sf_dir``."""
    register_views(spark, sf_dir)
    return spark.table(name)
