"""Row predicates (F1-F19) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.text import words

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# true iff any target (city or alias) is a substring of the lower-cased
# location; null / non-matching -> false. Targets are pre-computed per city.
def location_match(raw: ColumnOrName, targets: ColumnOrName) -> Column:
    low = F.lower(_c(raw))
    return F.coalesce(F.exists(_c(targets), lambda t: F.contains(low, t)), F.lit(False))


def city_targets_map(exclude_bare: list[str] | None = dims.EXCLUDE_BARE) -> Column:
    """city -> targets as one literal map (32 entries, constant in the plan)."""
    return F.create_map(*[x for c in dims.CITIES
                          for x in (F.lit(c), dims.lit_array(dims.city_targets(c, exclude_bare)))])


def with_city_targets(df: DataFrame, city_col: str, exclude_bare: list[str] | None = dims.EXCLUDE_BARE,
                      out: str = "targets") -> DataFrame:
    """Attach the target array of ``city_col`` (F2 via ``exclude_bare``).

    The 32-city dimension is a literal map inside the expression: no join and no
    broadcast are needed. A city outside the dimension matches on its own name only.
    """
    targets = F.element_at(city_targets_map(exclude_bare), F.col(city_col))
    return df.withColumn(out, F.coalesce(targets, F.array(F.col(city_col))))


# original post (not a repost); missing text counts as original.
def is_original(text: ColumnOrName) -> Column:
    return F.coalesce(~F.startswith(_c(text), F.lit("RT @")), F.lit(True))


# API shape: no referenced tweet of type "retweeted".
def is_original_api(refs: ColumnOrName) -> Column:
    return ~F.coalesce(F.exists(_c(refs), lambda r: r["type"] == "retweeted"), F.lit(False))


# F5
def has_retweets(retweet_count: ColumnOrName, text: ColumnOrName) -> Column:
    return (_c(retweet_count) > 0) & is_original(text)


# not yet known, lives in the target city, > 100 followers, has posts.
def qualifies_as_root(city: ColumnOrName, target_location: ColumnOrName,
                      followers: ColumnOrName, tweets: ColumnOrName) -> Column:
    return F.coalesce((_c(city) == _c(target_location)) & (_c(followers) > dims.ROOT_MIN_FOLLOWERS)
                      & (_c(tweets) > 0), F.lit(False))


# any keyword equals a whitespace token of the name, else of the description.
def list_relevant(name: ColumnOrName, description: ColumnOrName) -> Column:
    kw = dims.lit_array(dims.LIST_KEYWORDS)
    in_name = F.coalesce(F.arrays_overlap(words(name), kw), F.lit(False))
    in_desc = F.coalesce(F.arrays_overlap(words(description), kw), F.lit(False))
    return in_name | in_desc


# F8: any substring keyword (or "<kw> <city>") inside name or description.
def list_relevant_substring(name: ColumnOrName, description: ColumnOrName) -> Column:
    text = F.concat_ws("\u0000", F.lower(F.coalesce(_c(name), F.lit(""))),
                       F.lower(F.coalesce(_c(description), F.lit(""))))
    # "<kw> <city>" contains "<kw>", so the plain keywords decide alone.
    return F.exists(dims.lit_array(dims.LIST_KEYWORDS_SUBSTRING), lambda k: F.contains(text, k))


# F10
def is_relevant_label(label: ColumnOrName) -> Column:
    return F.coalesce(_c(label) != "other", F.lit(False))


# [since, until) window on a timestamp column; with ``now`` and no bounds the default window
# [now - 6 days, now - 60 seconds).
def date_window(ts: ColumnOrName, since: str | None = None, until: str | None = None,
                now: ColumnOrName | None = None) -> Column:
    if since is None and until is None and now is not None:
        at = _c(now).cast("timestamp")
        return (_c(ts) >= at - F.expr("INTERVAL 6 DAYS")) & (_c(ts) < at - F.expr("INTERVAL 60 SECONDS"))
    if until is not None and since is None:
        raise ValueError("until needs since")
    cond = F.lit(True)
    if since is not None:
        cond = cond & (_c(ts) >= F.to_timestamp(F.lit(since)))
    if until is not None:
        cond = cond & (_c(ts) < F.to_timestamp(F.lit(until)))
    return cond


# F15
def has_attributes(c: ColumnOrName) -> Column:
    return _c(c).isNotNull()


# F16
def skip_types(c: ColumnOrName, skipped: list[str]) -> Column:
    return ~_c(c).isin(skipped)
