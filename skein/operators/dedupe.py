"""Keyed and whole-record dedupe, page merges and unions.

"Keep first / keep last" is expressed as ``min_by(struct(row), order)`` inside a
hash aggregate rather than a ``row_number`` window: the aggregate combines on
the map side, so a key that holds a third of all rows is reduced to one row per
input partition before it is shuffled, and no task ever sorts a whole hot group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.sources.schemas import jsonify_complex

_ROW = "__row"
#: Types whose equal values are the same.
_EXACT = {"string", "bigint", "int", "smallint", "tinyint", "boolean", "date", "timestamp"}


def keep_first(df: DataFrame, keys: list[str] | Column, order: list[Column | str],
               key_name: str = "__key") -> DataFrame:
    """One row per key: the row with the smallest ``order`` (a total order)."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    cols = df.columns
    if isinstance(keys, Column):
        df = df.withColumn(key_name, keys)
        group = [key_name]
    else:
        group = list(keys)
    agg = df.groupBy(*group).agg(F.min_by(F.struct(*[F.col(c) for c in cols]),
                                          F.struct(*order_cols)).alias(_ROW))
    return _rows(agg, df, group, cols)


def _rows(agg: DataFrame, df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """The kept rows. Keys are taken from the grouping itself, so that Spark knows the rows lie by them and a later step by
    the same keys needs no shuffle (types of which equal values may differ come from the row)."""
    exact = {f.name for f in df.schema.fields if f.dataType.simpleString() in _EXACT}
    return agg.select(*[F.col(f"`{c}`") if c in group and c in exact else F.col(_ROW)[c].alias(c) for c in cols])


def row_order(df: DataFrame, key: str) -> list[str]:
    """A fixed order of rows that repeat a key: landing order where there is one, then the values."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return [c for c in ("ord", "pos") if c in plain] + [c for c in plain if c not in ("ord", "pos", key)]


def keep_last(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    cols = df.columns
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]),
                                         F.struct(*order_cols)).alias(_ROW))
    return _rows(agg, df, list(keys), cols)


def dedupe_by_key(df: DataFrame, order: list[Column | str],
                  key_cols: tuple[str, ...] = ("user_date_id", "tweet_id", "user_id")) -> DataFrame:
    """key = first present of the key columns; keyless rows dropped; keep first.

    All record kinds share one key space (a tweet id equal to a user id collides,
    as in the reference).
    """
    present = [c for c in key_cols if c in df.columns]
    if len(present) == 1 and df.schema[present[0]].dataType.simpleString() == "string":  # the key is a column: rows stay where they lie by it
        return keep_first(df.filter(F.col(present[0]).isNotNull()), present, order)
    key = F.coalesce(*[F.col(c).cast("string") for c in present])
    keyed = df.withColumn("__key", key).filter(F.col("__key").isNotNull())
    out = keep_first(keyed, ["__key"], order)
    return out.drop("__key")


def dedupe_whole(df: DataFrame) -> DataFrame:
    """Identical records collapse (maps/variants compared as JSON text)."""
    return jsonify_complex(df).dropDuplicates()


def unique_by(df: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """Keep the first row per user_id / list_id."""
    return keep_first(df.filter(F.col(key).isNotNull()), [key], order)


def merge_pages(df: DataFrame, key: str | list[str], page: str = "page", pos: str = "pos") -> DataFrame:
    """D5 + D6: the last page wins per id; inside a page the first record wins."""
    return keep_first(df, [key] if isinstance(key, str) else key, [-F.col(page), F.col(pos)])


def first_occurrence(df: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """Each id once across the whole traversal, at its first position."""
    return keep_first(df, [key], order)


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames with different columns (missing -> null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def master_dataset(distinct_users: DataFrame, expanded_users: DataFrame) -> DataFrame:
    """Distinct users ++ expanded distinct users (no dedupe between them)."""
    return distinct_users.unionByName(expanded_users, allowMissingColumns=True)


def classified_union(previous: DataFrame, new: DataFrame) -> DataFrame:
    """U3"""
    return previous.unionByName(new, allowMissingColumns=True)


def missing(requested: DataFrame, processed: DataFrame, key: str = "user_id") -> DataFrame:
    """Requested ids not yet processed (anti join; no rows travel twice)."""
    return requested.join(processed.select(key).distinct(), key, "left_anti")
