"""SQL fragments shared by oracle statements (DuckDB dialect, ANSI where possible)."""

from __future__ import annotations

from skein.functions import dims


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def city_target_values(exclude_bare=dims.EXCLUDE_BARE) -> str:
    """(city, target) pairs of the city dimension as a VALUES list."""
    rows = [f"({_q(c)}, {_q(t)})" for c in dims.CITIES for t in dims.city_targets(c, exclude_bare)]
    return "(VALUES " + ", ".join(rows) + ") AS ct(city, target)"


def match_expr(loc: str, city: str, exclude_bare=dims.EXCLUDE_BARE) -> str:
    """Location-match predicate for ``loc`` against ``city`` as plain SQL."""
    known = "(" + ", ".join(_q(c) for c in dims.CITIES) + ")"
    return (f"coalesce(CASE WHEN {city} IN {known} THEN EXISTS (SELECT 1 FROM {city_target_values(exclude_bare)} "
            f"WHERE ct.city = {city} AND strpos(lower({loc}), ct.target) > 0) "
            f"ELSE strpos(lower({loc}), {city}) > 0 END, false)")


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def words_expr(col: str) -> str:
    """Whitespace tokens of lower(col) as a list (DuckDB)."""
    return (f"CASE WHEN trim(regexp_replace(lower({col}), '\\s+', ' ', 'g')) = '' THEN []::VARCHAR[] "
            f"ELSE string_split(trim(regexp_replace(lower({col}), '\\s+', ' ', 'g')), ' ') END")


# Flat network tables over the fixture views (same shapes as skein.plans.q_network.net_tables).
NET_CTES = """
net_roots AS (SELECT user_id, username, location AS profile_location, search_location AS target_location,
  followers_count, following_count, tweets_count, ord,
  CASE WHEN {match} THEN search_location END AS city FROM fx_users),
net_tweets AS (SELECT author_id AS root_id, tweet_id, tweet_text, created_on, retweet_count, ord FROM fx_tweets),
net_rt AS (SELECT r.root_id, r.tweet_id, r.user_id, u.username, u.location AS profile_location,
  u.followers_count, u.following_count, r.ord, r.pos
  FROM fx_net_retweeters r LEFT JOIN fx_users u ON u.user_id = r.user_id),
net_fol AS (SELECT i.target AS root_id, i.source AS user_id, u.username, u.location AS profile_location,
  rt.search_location AS target_location, u.followers_count, u.following_count, i.ord, i.pos
  FROM fx_interactions i LEFT JOIN fx_users u ON u.user_id = i.source LEFT JOIN fx_users rt ON rt.user_id = i.target)
""".replace("{match}", match_expr("location", "search_location"))

# Interaction edges with both endpoints' attributes.
EDGE_CTE = """
ie AS (SELECT i.source, us.username AS source_username, us.followers_count AS source_followers,
  i.target, ut.username AS target_username, ut.followers_count AS target_followers, i.tweet_id, i.ord, i.pos
  FROM fx_interactions i LEFT JOIN fx_users us ON us.user_id = i.source LEFT JOIN fx_users ut ON ut.user_id = i.target)
"""
