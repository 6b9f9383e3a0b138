"""Record-shape projections.

Each function is one ``select``; dimension lookups (alias -> city -> language ->
template) are literal maps of fixed size inside the expression, so no join and
no broadcast is needed.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.predicates import is_original
from skein.functions.text import iso, parse_any_date, squeeze_query, user_url, user_date_id, date10
from skein.sources.schemas import CLEAN_USER_COLUMNS


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def normalize_tweets_full(raw: DataFrame) -> DataFrame:
    """The 19-field post projection with ``created_at`` as ISO text."""
    def opt(c: str) -> Column:
        return F.col(c) if c in raw.columns else F.lit(None).cast("string")
    fields = ["conversation_id", "geo", "lang", "possibly_sensitive", "reply_settings", "source", "attachments",
              "context_annotations", "entities", "public_metrics", "non_public_metrics", "organic_metrics",
              "promoted_metrics", "withheld", "in_reply_to_user_id"]
    return raw.select(F.col("id").alias("tweet_id"), "text", "author_id",
                      iso(parse_any_date("created_at", lenient=True)).alias("created_at"),
                      *[opt(c).alias(c) for c in fields])


def normalize_users_search(raw: DataFrame) -> DataFrame:
    """Rename id, empty ``tweets``/``geo_code``, flatten ``public_metrics``."""
    pm = F.col("public_metrics")
    return raw.select(F.col("id").alias("user_id"), "username", "description", "location", "name", "url",
                      F.array().cast("array<string>").alias("tweets"), F.array().cast("array<double>").alias("geo_code"),
                      pm["followers_count"].alias("followers_count"), pm["following_count"].alias("following_count"),
                      pm["tweet_count"].alias("tweet_count"), pm["listed_count"].alias("listed_count"))


def explode_lists(user_lists: DataFrame) -> DataFrame:
    """User -> [lists] to one row per (user, list) with the 9 list fields."""
    e = user_lists.select("user_id", F.explode("lists").alias("l"))
    return e.select("user_id", F.col("l.id").alias("list_id"), "l.name", "l.created_at", "l.description",
                    "l.follower_count", "l.member_count", "l.private", "l.owner_id")


def split_scraped(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One scraped post -> one post row and one user row (tweets=[text])."""
    tweets = posts.select("tweet_id", "text", "created_at", F.col("user.id").alias("author_id"))
    day = date10(iso(parse_any_date("created_at", lenient=True)))
    users = posts.select(F.col("user.id").alias("user_id"), F.col("user.name").alias("username"),
                         "user.description", "user.location", F.col("user.screen_name").alias("name"), "user.url",
                         F.col("user.followers_count").cast("bigint").alias("followers_count"),
                         F.col("user.following_count").cast("bigint").alias("following_count"),
                         F.array("text").alias("tweets"), day.alias("tweet_date"),
                         user_date_id(F.col("user.id"), day).alias("user_date_id"))
    return tweets, users


def legacy_follower_to_v2(df: DataFrame) -> DataFrame:
    """screen_name/friends_count/statuses_count -> v2 names with nested metrics."""
    return df.select(F.col("id_str").alias("id"), F.col("screen_name").alias("username"), "name", "description",
                     "location", F.struct(F.col("followers_count").alias("followers_count"),
                                          F.col("friends_count").alias("following_count"),
                                          F.col("statuses_count").alias("tweet_count")).alias("public_metrics"))


def conform_users(df: DataFrame, list_expansion: bool, keep: list[str] = ()) -> DataFrame:
    """P9 + F9 + P8 + P26: add missing columns as null, keep the 14 user columns,
    drop rows without user_id or relevance, attach URL and expansion flag; ``keep`` names further columns
    to carry along."""
    cols = []
    for c in CLEAN_USER_COLUMNS:
        cols.append(F.col(c) if c in df.columns else F.lit(None).cast(
            "bigint" if c.endswith("_count") else "array<string>" if c == "tweets" else
            "boolean" if c == "content_is_relevant" else "string").alias(c))
    out = df.select(*cols, F.col("search_location"), *keep)
    out = out.dropna(subset=["user_id", "content_is_relevant"])
    return out.withColumn("user_url", user_url("username")).withColumn("list_expansion", F.lit(list_expansion))


def conform_lists(df: DataFrame, city: Column | str, manually_added: bool = False) -> DataFrame:
    """P10: keep lists judged relevant (all when manually added) and attach the city."""
    out = df if manually_added else df.dropna(subset=["relevant"])
    return out.withColumn("search_location", F.col(city) if isinstance(city, str) else city)


def list_columns(df: DataFrame) -> DataFrame:
    """P22"""
    return df.select("user_id", "list_id", "name", "description")


def geo_placeholder(df: DataFrame) -> DataFrame:
    """geo_location = (null, null)."""
    return df.withColumn("geo_location", F.struct(F.lit(None).cast("double").alias("lat"),
                                                  F.lit(None).cast("double").alias("lng")))


def reset_status(df: DataFrame) -> DataFrame:
    """Cached records re-issued with both statuses pending and times null."""
    return df.withColumns({"retweeter_status": F.lit("pending"), "follower_status": F.lit("pending"),
                           "retweeter_last_processed": F.lit(None).cast("timestamp"),
                           "follower_last_processed": F.lit(None).cast("timestamp")})


def account_type_from_name(fname: Column) -> Column:
    """The token after the city in ``<city>_<type>_users...`` (file name, not path position)."""
    return F.regexp_extract(fname, r"^(.+?)_([a-z]+)_users", 2)


def city_file_key(city: Column) -> Column:
    """Alias -> main city, else the name itself."""
    return F.coalesce(F.element_at(_map(dims.ALIASES), city), city)


def render_queries(cities: DataFrame, city: str) -> DataFrame:
    """J10 + P19: every city x account type -> its search query (null if no template).

    The city x type matrix is an ``explode`` of the 7 types, not a join.
    """
    lang = F.element_at(_map(dims.CITY_LANGS), city_file_key(F.col(city)))
    tmpl = {f"{lg}|{t}": q for lg, ts in dims.QUERY_TEMPLATES.items() for t, q in ts.items()}
    m = cities.select(city, lang.alias("__lang"), F.explode(dims.lit_array(dims.ACCOUNT_TYPES)).alias("account_type"))
    t = F.element_at(_map(tmpl), F.concat_ws("|", "__lang", "account_type"))
    return m.select(city, "account_type", squeeze_query(F.replace(t, F.lit("location"), F.col(city))).alias("query"))


def render_alias_queries(cities: DataFrame, city: str, date_range: str) -> DataFrame:
    """P20: the city and its aliases OR-ed into every template of the city's language,
    the date range appended."""
    ors = _map({c: " OR ".join(dims.city_targets(c, None)) for c in dims.CITIES})
    aliases = F.coalesce(F.element_at(ors, F.col(city)), F.col(city))
    lang = F.element_at(_map(dims.CITY_LANGS), F.col(city))
    tmpl = {f"{lg}|{t}": q for lg, ts in dims.QUERY_TEMPLATES.items() for t, q in ts.items()}
    m = cities.select(city, aliases.alias("__aliases"), lang.alias("__lang"),
                      F.explode(dims.lit_array(dims.ACCOUNT_TYPES)).alias("account_type"))
    t = F.element_at(_map(tmpl), F.concat_ws("|", "__lang", "account_type"))
    q = squeeze_query(F.replace(t, F.lit("location"), F.col("__aliases")))
    return m.filter(t.isNotNull()).select(city, "account_type", F.concat(q, F.lit(" " + date_range)).alias("query"))


def _plain(text: Column) -> Column:
    """Lower-cased words parted by single blanks, with a blank at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", " ")), F.lit(" "))


def template_terms(template: str) -> list[list[str]]:
    """Alternatives of one search template (parted by OR); each lists the words and quoted phrases
    that must all occur. The city slot is left to the caller."""
    out = []
    for part in re.split(r"\bOR\b", template.replace("-is:retweet", " ")):
        terms = re.findall(r'"([^"]+)"', part) + re.sub(r'"[^"]*"', " ", part).replace("location", " ").split()
        plain = [" ".join(re.findall(r"[^\W_]+", t.lower())) for t in terms]
        if any(plain):
            out.append([t for t in plain if t])
    return out


def topic_match(posts: DataFrame, text: str, lang: str, city: Column | None = None) -> DataFrame:
    """F13 (search query re-aimed as a predicate): tag an original post with every account type of
    which, in the post's language, one alternative has all its words and phrases in the text as whole
    words; with ``city`` the city's name must occur too. Returns one row per (post, type).

    The list of types is built beside the text, so the text is never copied per type.
    """
    def has(term: str) -> Column:
        return F.contains(F.col("__plain"), F.lit(f" {term} "))

    def hit(template: str) -> Column:
        return reduce(Column.__or__, [reduce(Column.__and__, map(has, alt)) for alt in template_terms(template)])

    here = F.lit(True) if city is None else F.coalesce(F.contains(F.col("__plain"), F.col("__city")), F.lit(False))
    types = F.array_compact(F.array(*[
        F.when(here & (F.col("__lang") == lg) & hit(q), F.lit(t))
        for lg, ts in dims.QUERY_TEMPLATES.items() for t, q in ts.items()]))
    plain = posts.filter(is_original(text)).select(
        "tweet_id", F.col(lang).alias("__lang"), _plain(F.col(text)).alias("__plain"),
        (F.lit("") if city is None else _plain(city)).alias("__city"))
    return plain.select("tweet_id", F.explode(types).alias("account_type"))
