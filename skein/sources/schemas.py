"""Entity schemas (Spark DDL). Every id is a STRING; times are TIMESTAMP inside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWEET_FULL = (
    "tweet_id STRING, text STRING, author_id STRING, created_at STRING, conversation_id STRING, "
    "geo STRING, lang STRING, possibly_sensitive BOOLEAN, reply_settings STRING, source STRING, "
    "attachments STRING, context_annotations STRING, entities STRING, public_metrics MAP<STRING,BIGINT>, "
    "non_public_metrics STRING, organic_metrics STRING, promoted_metrics STRING, withheld STRING, "
    "in_reply_to_user_id STRING")

USER_SEARCH = (
    "user_id STRING, username STRING, description STRING, location STRING, name STRING, url STRING, "
    "tweets ARRAY<STRING>, geo_code ARRAY<DOUBLE>, followers_count BIGINT, following_count BIGINT, "
    "tweet_count BIGINT, listed_count BIGINT, tweet_date STRING, user_date_id STRING")

TWEET_SCRAPED = "tweet_id STRING, text STRING, created_at STRING, author_id STRING"

LIST = ("user_id STRING, list_id STRING, name STRING, created_at STRING, description STRING, "
        "follower_count BIGINT, member_count BIGINT, private BOOLEAN, owner_id STRING")

NET_USER = (
    "user_id STRING, username STRING, description STRING, profile_location STRING, "
    "target_location STRING, followers_count BIGINT, following_count BIGINT, tweets_count BIGINT, "
    "verified BOOLEAN, created_at STRING, category STRING, treatment_arm STRING, "
    "retweeter_status STRING, retweeter_last_processed STRING, follower_status STRING, "
    "follower_last_processed STRING, last_tweeted_at STRING, extracted_at STRING, "
    "last_updated STRING, city STRING")

NET_TWEET = ("tweet_id STRING, tweet_text STRING, created_at STRING, retweet_count BIGINT, "
             "favorite_count BIGINT")

NET_ROOT = (f"{NET_USER}, tweets ARRAY<STRUCT<{NET_TWEET}, retweeters ARRAY<STRUCT<{NET_USER}>>>>, "
            f"followers ARRAY<STRUCT<{NET_USER}>>")

INTERACTION = ("source STRING, source_username STRING, source_followers BIGINT, "
               "source_following BIGINT, tweet_id STRING, target STRING, target_username STRING, "
               "target_followers BIGINT, target_following BIGINT")

CLEAN_USER_COLUMNS = [
    "user_id", "username", "name", "description", "location", "tweet_count", "followers_count",
    "following_count", "listed_count", "tweets", "content_is_relevant", "content_labels",
    "search_account_type", "tweet_date",
]

MSG_USER = "user_id STRING, location STRING"
MSG_TWEET = "tweet_id STRING, target_user_id STRING, location STRING"
LABELLED = "description STRING, tweets STRING, `manual classification` STRING"


def struct_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def jsonify_complex(df: DataFrame) -> DataFrame:
    """Maps and variants cannot be grouping keys: compare them as JSON text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.MapType, T.VariantType)):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
