"""Scalar Column functions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions import dims

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# X1: "Fri Dec 06 18:09:05 +0000 2024" -> timestamp; bad input -> null.
def parse_post_date(c: ColumnOrName) -> Column:
    return F.try_to_timestamp(F.substring(_c(c), 5, 1 << 20), F.lit("MMM dd HH:mm:ss Z yyyy"))


# ISO first, then the post format; neither -> error (or null when lenient).
def parse_any_date(c: ColumnOrName, lenient: bool = False) -> Column:
    parsed = F.coalesce(F.try_to_timestamp(_c(c)), parse_post_date(c))
    if lenient:
        return parsed
    return F.when(_c(c).isNull(), F.lit(None).cast("timestamp")).when(
        parsed.isNull(), F.raise_error(F.concat(F.lit("unparseable date: "), _c(c)))
    ).otherwise(parsed)


# A naive wall-clock time taken as America/Chicago, returned in UTC.
def chicago_to_utc(c: ColumnOrName) -> Column:
    return F.to_utc_timestamp(_c(c).cast("timestamp_ntz").cast("timestamp"), "America/Chicago")


# First ten characters (the date part of an ISO string).
def date10(c: ColumnOrName) -> Column:
    return F.substring(_c(c).cast("string"), 1, 10)


# ISO-8601 text with a numeric offset (session time zone is UTC).
def iso(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ssxxx")


_TRUE = ["y", "yes", "t", "true", "on", "1"]
_FALSE = ["n", "no", "f", "false", "off", "0"]


# Truth strings, case-insensitive; anything else raises.
def str_to_bool(c: ColumnOrName) -> Column:
    v = F.lower(_c(c).cast("string"))
    return (F.when(v.isin(_TRUE), F.lit(True))
            .when(v.isin(_FALSE), F.lit(False))
            .otherwise(F.raise_error(F.concat(F.lit("invalid truth value "), F.coalesce(v, F.lit("null"))))
                       .cast("boolean")))


# Drop '[', ']', newlines, then double spaces (removed, not collapsed).
def clean_post(c: ColumnOrName) -> Column:
    out = _c(c)
    for ch in ["[", "]", "\n", "  "]:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


# Newline -> space, strip, one pass of double space -> space, tab -> space.
def squeeze_query(c: ColumnOrName) -> Column:
    out = F.replace(_c(c), F.lit("\n"), F.lit(" "))
    out = F.regexp_replace(out, r"^\s+|\s+$", "")
    out = F.replace(out, F.lit("  "), F.lit(" "))
    return F.replace(out, F.lit("\t"), F.lit(" "))


# The list filter's cleaning is lower-casing only.
def lower_clean(c: ColumnOrName) -> Column:
    return F.lower(_c(c))


# Lower, strip, split on whitespace runs (Python str.split()).
def words(c: ColumnOrName) -> Column:
    stripped = F.regexp_replace(F.lower(_c(c)), r"^\s+|\s+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, r"\s+"))


# X11: Unicode word runs: letters, numbers and the underscore.
def word_chars(c: ColumnOrName) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(r"[\p{L}\p{N}_]+"), 0)


# X12: ';'-joined id lists.
def id_list(c: ColumnOrName, sep: str = ";") -> Column:
    return F.when(_c(c).isNull() | (_c(c) == ""), F.array().cast("array<string>")).otherwise(
        F.split(_c(c), F.lit(sep)))


def id_list_append(c: ColumnOrName, new_id: ColumnOrName, sep: str = ";") -> Column:
    """Append ``new_id`` unless it is already listed (the list is kept as is otherwise)."""
    ids = id_list(c, sep)
    return F.when(F.array_contains(ids, _c(new_id)), F.array_join(ids, sep)).otherwise(
        F.array_join(F.concat(ids, F.array(_c(new_id))), sep))


def id_list_contains(c: ColumnOrName, an_id: ColumnOrName, sep: str = ";") -> Column:
    return F.array_contains(id_list(c, sep), _c(an_id))


# Deterministic (retry-safe) edge id.
def edge_id(src: ColumnOrName, dst: ColumnOrName, label: ColumnOrName) -> Column:
    return F.sha2(F.concat_ws("|", _c(src), _c(dst), _c(label)), 256)


# X14
def round2(c: ColumnOrName) -> Column:
    return F.round(_c(c), 2)


# P8
def user_url(username: ColumnOrName) -> Column:
    return F.concat(F.lit(dims.USER_URL_PREFIX), _c(username))


# P14: "<user_id>-YYYY-MM-DD"
def user_date_id(user_id: ColumnOrName, day: ColumnOrName) -> Column:
    return F.concat_ws("-", _c(user_id), date10(day))


# Description + " " + tweets joined by " " (nulls as "").
def classification_text(description: ColumnOrName, tweets: ColumnOrName) -> Column:
    return F.concat(F.coalesce(_c(description), F.lit("")), F.lit(" "),
                    F.coalesce(F.array_join(_c(tweets), " "), F.lit("")))


# P12: "{description} {tweets}" when tweets is non-empty, else the description.
# A missing cell reads as "nan" (spreadsheet semantics of the labelled sheet).
def label_text(description: ColumnOrName, tweets: ColumnOrName) -> Column:
    d = F.coalesce(_c(description).cast("string"), F.lit("nan"))
    t = _c(tweets).cast("string")
    return F.when(t == "", d).otherwise(F.concat(d, F.lit(" "), F.coalesce(t, F.lit("nan"))))


# Literal placeholder replacement in a prompt template.
def render_prompt(template: str, description: ColumnOrName, tweets: ColumnOrName,
                  sep: str = "\n") -> Column:
    joined = F.coalesce(F.array_join(_c(tweets), sep), F.lit(""))
    out = F.replace(F.lit(template), F.lit("user_description"), F.coalesce(_c(description), F.lit("")))
    return F.replace(out, F.lit("user_tweets"), joined)


# Literal "location" -> city.
def replace_location(template: ColumnOrName, city: ColumnOrName) -> Column:
    return F.replace(_c(template), F.lit("location"), _c(city))


# Reply text -> category; JSON first, then a regex fallback; unknown -> null.
def parse_category(reply: ColumnOrName) -> Column:
    from_json = F.get_json_object(_c(reply), "$.category")
    from_regex = F.regexp_extract(_c(reply), r"""['"]category['"]\s*:\s*['"]([^'"]+)['"]""", 1)
    cat = F.lower(F.trim(F.coalesce(from_json, F.nullif(from_regex, F.lit("")))))
    return F.when(F.array_contains(dims.lit_array(dims.PROMPT_CATEGORIES), cat), cat)
