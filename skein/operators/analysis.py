"""Counts, pivots, samples and row budgets.

Every grouping is a hash aggregate with map-side partial aggregation, so a hot
key (one city holding a third of all rows) is pre-aggregated before the shuffle.
Pivots use explicit value lists: no extra job to find distinct values and stable
columns when a value is absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.predicates import location_match, with_city_targets


def location_matches(users: DataFrame, exclude_bare: list[str] | None = dims.EXCLUDE_BARE) -> DataFrame:
    """F1 per row: (user_id, location, search_location, location_match)."""
    t = with_city_targets(users.select("user_id", "location", "search_location"),
                          "search_location", exclude_bare)
    return t.select("user_id", "location", "search_location",
                    location_match("location", "targets").alias("location_match"))


def location_counts(matches: DataFrame) -> DataFrame:
    """A1: non-null user ids per (location_match, search_location)."""
    return (matches.groupBy("location_match", "search_location")
            .agg(F.count("user_id").alias("n_users")))


def location_pivot(matches: DataFrame) -> DataFrame:
    """A2: one row per city with false/true counts, total and match share.

    A side with no rows is null, and so are its total and share.
    """
    piv = (matches.groupBy("search_location")
           .pivot("location_match", [False, True])
           .agg(F.count("user_id")))
    n_false = F.nullif(F.col("false"), F.lit(0))
    n_true = F.nullif(F.col("true"), F.lit(0))
    total = n_true + n_false
    return piv.select(
        F.col("search_location").alias("location"),
        n_false.alias("n_false"), n_true.alias("n_true"), total.alias("total"),
        F.round(n_true / total, 2).alias("match_percentage"))


def users_by(users: DataFrame, keys: list[str]) -> DataFrame:
    """A3/A4: user count per key combination; rows with a null key are dropped."""
    return users.dropna(subset=keys).groupBy(*keys).agg(F.count("user_id").alias("n_users"))


def label_pivot(users: DataFrame, labels: list[str], city: str = "search_location",
                label: str = "content_labels") -> DataFrame:
    """A5: city rows x label columns; total_per_city sums ignoring nulls."""
    counts = users_by(users, [city, label])
    piv = counts.groupBy(city).pivot(label, labels).agg(F.sum("n_users"))
    total = sum((F.coalesce(F.col(f"`{lab}`"), F.lit(0)) for lab in labels), F.lit(0))
    return piv.withColumn("total_per_city", total.cast("bigint"))


def analysis_suite(distinct_users: DataFrame, master: DataFrame, labels: list[str]) -> dict[str, DataFrame]:
    """A4 + A5 on the distinct users and on the master dataset."""
    return {
        "user_analysis": users_by(distinct_users, ["search_location", "content_labels"]),
        "user_analysis_pivot": label_pivot(distinct_users, labels),
        "user_analysis_with_expansions": users_by(master, ["search_location", "content_labels"]),
        "user_analysis_with_expansions_pivot": label_pivot(master, labels),
    }


def distinct_count(df: DataFrame, col: str, alias: str = "n_distinct") -> DataFrame:
    """Exact distinct count (two-phase aggregate: partial, then merge)."""
    return df.agg(F.countDistinct(col).alias(alias))


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Several counters in one pass: sum(when(cond,1,0))."""
    return df.agg(*[F.sum(F.when(c, 1).otherwise(0)).cast("bigint").alias(n) for n, c in conditions.items()])


def matched_city_users(users: DataFrame, city: str | None = None, first_n: int | None = None,
                       order: str = "user_id") -> DataFrame:
    """distinct user ids whose location matches their search city."""
    m = location_matches(users).filter("location_match")
    if city is not None:
        m = m.filter(F.col("search_location") == city)
    ids = m.select("user_id", "search_location").distinct()
    if first_n is not None:
        ids = ids.orderBy(order).limit(first_n)
    return ids


def top_k(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """K highest scores, ties broken by ``tie`` ascending (a top-k report)."""
    return df.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(k)


def per_group_first_n(df: DataFrame, keys: list[str], order: list[Column], n: Column | int,
                      rank_col: str = "rn", bound: int | None = None) -> DataFrame:
    """Keep rows ranked <= n within each group (n may be a column, then
    ``bound`` is its literal upper bound).

    A literal limit lets Spark insert a partial group limit before the shuffle
    (``WindowGroupLimit``), so a hot group reaches the final sort as at most
    n rows per input partition instead of all its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    if isinstance(n, Column):
        if bound is not None:
            ranked = ranked.filter(F.col(rank_col) <= F.lit(bound))
        return ranked.filter(F.col(rank_col) <= n)
    return ranked.filter(F.col(rank_col) <= F.lit(n))


def random_sample(df: DataFrame, n: int = dims.SAMPLE_SIZE, seed: int = dims.SAMPLE_SEED,
                  key: str = "user_id") -> DataFrame:
    """Reproducible fixed-size sample without replacement (a sampling operator).

    Rows are ordered by a seeded digest of the key (md5, so any SQL engine can
    reproduce the sample); ``limit`` after ``orderBy`` is a distributed top-k
    (each partition keeps n rows, then one merge).
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(digest, F.col(key)).limit(n)


def train_test_split(df: DataFrame, test_share: float = 0.2, seed: int = 42,
                     key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Deterministic split by a seeded digest of the key (stable under task retries, unlike rand();
    any SQL engine can reproduce it). Rows without a key are for training."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    bucket = F.when(F.col(key).isNull(), 10000).otherwise(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10000)
    cut = int(round(test_share * 10000))
    return df.filter(bucket >= cut), df.filter(bucket < cut)


def even_split(groups: DataFrame, total: int, key: str, minimum: int = 1) -> DataFrame:
    """Share ``total`` over the groups: floor(total/n) each, remainder to the last.

    The reference rounds up and may exceed the total; the intent is kept
    (shares add up to the total). A share below ``minimum`` is null. ``groups``
    is the small list of account types (one row each), so the un-partitioned
    window runs over a handful of rows.
    """
    w_all = Window.partitionBy(F.lit(1))
    w_ord = Window.orderBy(key)
    n = F.count(F.lit(1)).over(w_all)
    base = F.floor(F.lit(total) / n)
    share = F.when(F.row_number().over(w_ord) == n, base + F.lit(total) % n).otherwise(base)
    return groups.select(key).withColumn("budget", F.when(share >= minimum, share.cast("bigint")))


def floor_share(groups: DataFrame, total: int, key: str) -> DataFrame:
    """Total // n for every group."""
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return groups.select(key).withColumn("budget", F.floor(F.lit(total) / n).cast("bigint"))
