"""Bulk-load exports of the graph.

Export values follow the loader's text conventions: missing text -> "null",
missing or zero counts -> -99 (sentinels exist only here, never inside).
Edge ids are a hash of (from, to, label), so a re-run writes the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.predicates import location_match, with_city_targets
from skein.functions.text import chicago_to_utc, edge_id, iso, parse_any_date, parse_post_date
from skein.operators.dedupe import keep_first
from skein.operators.graph import vertex_attributes
from skein.operators.long_lists import chunks_of, in_chunks, in_order, joined, numbered
from skein.session import stored

VERTEX_COLUMNS = ["~id", "~label", "username", "city", "profile_location", "target_location",
                  "followers_count:Int", "following_count:Int", "tweets_count:Int", "category", "treatment_arm",
                  "verified", "created_at", "last_tweeted_at", "retweeter_status", "retweeter_last_processed",
                  "follower_status", "follower_last_processed", "extracted_at", "last_updated"]
_INT = ["followers_count", "following_count", "tweets_count"]
_DATES = ["extracted_at", "retweeter_last_processed", "follower_last_processed", "last_updated"]


def _text(c: Column, is_bool: bool = False) -> Column:
    """Falsy (null, empty text, false) -> "null"; otherwise the value as text."""
    if is_bool:
        return F.when(c, F.lit("True")).otherwise(F.lit("null"))
    s = c.cast("string")
    return F.when(c.isNull() | (s == ""), F.lit("null")).otherwise(s)


def export_props(df: DataFrame) -> DataFrame:
    """Blank text -> "null", JSON-escaped strings, numbers kept; drop user_id/description."""
    out = []
    for f in df.schema.fields:
        if f.name in ("user_id", "description"):
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            escaped = F.regexp_replace(F.substring(F.to_json(F.array(c)), 3, 1 << 30), r'"\]$', "")
            out.append(F.when(c.isNull() | (F.trim(c) == ""), F.lit("null")).otherwise(escaped).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def migrate_status(df: DataFrame) -> DataFrame:
    """A legacy ``processing_status`` fills both statuses; ``last_processed`` both
    times unless the status is pending (then null)."""
    if "processing_status" not in df.columns:
        return df
    st = F.col("processing_status")
    lp = F.when(st == "pending", F.lit(None)).otherwise(F.col("last_processed")) \
        if "last_processed" in df.columns else F.lit(None)
    return df.withColumns({"retweeter_status": st, "follower_status": st,
                           "retweeter_last_processed": lp.cast("string"),
                           "follower_last_processed": lp.cast("string")}) \
        .drop("processing_status", "last_processed")


def _time(df: DataFrame, name: str, chicago: bool) -> Column:
    """A time column in any landed form: timestamp, ISO text with or without offset, post date,
    blank or the literal "null". Text that is no time gives null, as blank does."""
    if name not in df.columns:
        return F.lit(None).cast("timestamp")
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).cast("timestamp")
    s = F.when(F.lower(F.trim(name)).isin("", "null", "none"), F.lit(None)).otherwise(F.trim(name))
    parsed = parse_any_date(s, lenient=True)
    if not chicago:
        return parsed
    zoned = s.rlike(r"(Z|[+-]\d\d:?\d\d)$") | parse_post_date(s).isNotNull()
    return F.when(zoned, parsed).otherwise(chicago_to_utc(parsed))


def _is_time(name: str) -> bool:
    return name in _DATES or name == "last_tweeted_at"


def unread_times(df: DataFrame) -> DataFrame:
    """(column, value, n): texts in the time columns that are no time, which ``export_typed`` writes as "null"."""
    names = [n for n in dict.fromkeys(c.split(":")[0] for c in VERTEX_COLUMNS) if _is_time(n) and n in df.columns]
    if not names:
        return df.sparkSession.createDataFrame([], "column STRING, value STRING, n BIGINT")
    cells = [F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value"),
                      _time(df, n, n in _DATES).isNull().alias("unread")) for n in names]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*") \
        .filter(F.col("unread") & ~F.lower(F.trim("value")).isin("", "null", "none")) \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def export_typed(df: DataFrame, strict: bool = False) -> DataFrame:
    """P17 (+X3/X5 for times): ``:Int`` columns with falsy -> -99 (0 becomes -99), run times as ISO
    text (naive ones read as Chicago time), ``created_at`` as the text it is, other falsy values -> "null".

    Text in a time column that is no time gives "null" and is listed by ``unread_times``; with ``strict`` it
    fails the job.
    """
    cols = {}
    for name in VERTEX_COLUMNS:
        base = name.split(":")[0]
        if name == "~id":
            cols[name] = F.col("user_id").cast("string")
        elif name == "~label":
            cols[name] = F.lit("User")
        elif base in _INT:
            v = (F.col(base) if base in df.columns else F.lit(None)).cast("bigint")
            cols[name] = F.when(v.isNull() | (v == 0), F.lit(-99)).otherwise(v)
        elif _is_time(base):
            naive_zone = base in _DATES  # run times are wall-clock times of the collector
            value = iso(_time(df, base, naive_zone))
            if strict and base in df.columns:
                known = F.lower(F.trim(F.coalesce(F.col(base).cast("string"), F.lit("")))).isin("", "null", "none")
                value = F.when(value.isNull() & ~known, F.raise_error(F.concat(F.lit(f"no time in {base}: "), F.col(base).cast("string")))) \
                    .otherwise(value)
            cols[name] = F.coalesce(value, F.lit("null"))
        else:
            is_bool = base in df.columns and isinstance(df.schema[base].dataType, T.BooleanType)
            cols[name] = _text(F.col(base) if base in df.columns else F.lit(None), is_bool)
    return df.select(*[c.alias(n) for n, c in cols.items()])


def sequential_ids(df: DataFrame, order: list[str], prefix: str = "e", col: str = "~id", drop: tuple[str, ...] = ()) -> DataFrame:
    """Ids e1..eN in first-seen order, computed on the JVM side. Columns in ``drop`` are there for the order only.

    Rows are range-sorted and numbered inside their partition
    (``monotonically_increasing_id`` minus the partition base) in one pass that
    is written to the reliable checkpoint folder; per-partition row counts (one
    row per partition) give each partition's offset. No task sees all rows and
    no row passes through Python.
    """
    return numbered(df, order, drop=drop).withColumn(
        col, F.concat(F.lit(prefix), (F.col("__no") + 1).cast("string"))).drop("__no")


#: Fixed header of the simple loader's edge file (the typed one is VERTEX_COLUMNS above).
SIMPLE_EDGE_COLUMNS = {"retweet": ["~id", "~from", "~to", "~label", "weight", "tweet_ids:String", "location"],
                       "follower": ["~id", "~from", "~to", "~label", "location"]}


def per_record(edges: DataFrame, people: DataFrame) -> DataFrame:
    """Each edge as often as lookups of both its ends by ``user_id`` would give it: an end that has several records in
    ``people`` counts once for each. Only ids with several records are joined, so edges move only if there are many of those."""
    again = stored(people.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated")
    if again.isEmpty():
        return edges
    columns = edges.columns
    for end in ("source", "target"):
        edges = edges.join(again.select(F.col("user_id").alias(end), F.col("n").alias("__n")), end, "left") \
            .select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("__n", F.lit(1))))).select(*columns)
    return edges


def export_graph_simple(edges: DataFrame, kind: str, location: str, people: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """K8: vertices (~id, ~label=user, username, followers, location) with the last seen
    attributes, and edges e1..eN in first-seen order (label retweeted with weight and post ids
    joined by ',', or follows). ``location`` is the run's city; every vertex and edge carries it.

    Edges carry the attributes of their endpoints, or these are looked up in ``people`` (A14): then no edge moves for its
    attributes, and the vertices of retweet edges come from the rows that are stored for the post ids."""
    pair = [F.col("source").alias("~from"), F.col("target").alias("~to")]
    seen = edges
    if kind == "retweet":
        each = edges if people is None else per_record(edges, people)
        rows = in_order(each.select(*pair, "ord", "pos", "tweet_id"), ["~from", "~to"], ["ord", "pos"], "tweet_id")
        # the chunks know each pair's first place: no second pass over the edges, no join of two tables of pairs
        # stored, since the sort of the ids reads its input twice
        ids = joined(stored(chunks_of(rows, ["~from", "~to"], ["ord", "pos"]), "chunks"), ["~from", "~to"], ",")
        grp = ids.select("~from", "~to", F.col("first").alias("__first"), F.col("n").alias("weight"), F.col("text").alias("tweet_ids:String"))
        if people is not None:
            seen = rows.select(F.col("~from").alias("source"), F.col("~to").alias("target"), F.col("__o0").alias("ord"), F.col("__o1").alias("pos"))
    else:
        grp = edges.groupBy(*pair).agg(F.min(F.struct("ord", "pos")).alias("__first"))
    v = vertex_attributes(seen, "last", people).select(
        F.col("id").alias("~id"), F.lit("user").alias("~label"), "username", "followers", F.lit(location).alias("location"))
    e = sequential_ids(grp.select(F.col("__first.ord").alias("__o"), F.col("__first.pos").alias("__p"), *[c for c in grp.columns if c != "__first"]),
                       ["__o", "__p", "~from", "~to"], drop=("__o", "__p"))
    # what all edges have alike does not move with them
    e = e.withColumns({"~label": F.lit("retweeted" if kind == "retweet" else "follows"), "location": F.lit(location)})
    columns = SIMPLE_EDGE_COLUMNS["retweet" if kind == "retweet" else "follower"]
    return v, e.select(*[F.col(f"`{c}`") for c in columns])


def conform_to_header(records: DataFrame, json_col: str, header: list[str]) -> tuple[DataFrame, DataFrame]:
    """export rows whose field set differs from the header are rejected (kept
    in a reject table instead of stopping the run)."""
    keys = F.array_sort(F.json_object_keys(F.col(json_col)))
    want = F.array_sort(F.array(*[F.lit(h) for h in header]))
    ok = F.coalesce(keys == want, F.lit(False))
    return records.filter(ok), records.filter(~ok)


def typed_tables(roots: DataFrame, root_tweets: DataFrame, retweeters: DataFrame,
                 followers: DataFrame) -> dict[str, DataFrame]:
    """K9 (G12 BELONGS_TO, G13 typed vertices, G14 typed retweets, G15 typed follows,
    D7, F14): user vertices, BELONGS_TO, RETWEETED and FOLLOWS edges.

    Only valid roots are traversed (id present, first time, city = target city).
    A user's vertex is written once, from its first occurrence in traversal order
    (root, then its posts' retweeters, then its followers); BELONGS_TO edges go
    with that emission when the user's city equals its target city.
    """
    valid = keep_first(migrate_status(roots).filter(F.col("user_id").isNotNull() & F.col("city").isNotNull()
                                    & (F.col("city") == F.col("target_location"))), ["user_id"], ["ord"])
    vroots = valid.select(F.col("user_id").alias("root_id"), F.col("ord").alias("__root_ord"),
                          F.col("target_location").alias("__root_city"))
    last_at = root_tweets.groupBy(F.col("root_id").alias("user_id")).agg(F.max("created_on").alias("last_tweeted_at"))
    root_rows = valid.drop("last_tweeted_at").join(last_at, "user_id", "left").select(
        "*", F.col("ord").alias("__o1"), F.lit(0).alias("__sec"), F.lit(0).cast("bigint").alias("__o2"),
        F.lit(0).cast("bigint").alias("__o3"))

    def actors(df: DataFrame, sec: int, o2: str, o3: str) -> DataFrame:
        """Retweeter/follower records; their own city/target fields are used when
        landed, otherwise derived from the root's city (collection sets them so)."""
        j = df.join(vroots, "root_id")
        j = with_city_targets(j, "__root_city", None, out="__t")
        own = [c for c in df.columns if c not in ("root_id", "tweet_id", "ord", "pos", "__tw_ord",
                                                   "city", "target_location", "last_tweeted_at")]
        tl = F.coalesce(F.col("target_location"), F.col("__root_city")) if "target_location" in df.columns \
            else F.col("__root_city")
        derived = F.when(location_match("profile_location", "__t"), F.col("__root_city"))
        city = F.coalesce(F.col("city"), derived) if "city" in df.columns else derived
        return j.select(*own, tl.alias("target_location"), city.alias("city"),
                        F.col("__root_ord").alias("__o1"), F.lit(sec).alias("__sec"),
                        F.col(o2).cast("bigint").alias("__o2"), F.col(o3).cast("bigint").alias("__o3"))

    tw_ord = root_tweets.select("root_id", "tweet_id", F.col("ord").alias("__tw_ord"))
    rts = retweeters.join(tw_ord, ["root_id", "tweet_id"], "left")
    all_rows = root_rows.unionByName(actors(rts, 1, "__tw_ord", "pos"), allowMissingColumns=True) \
        .unionByName(actors(followers, 2, "ord", "pos"), allowMissingColumns=True)
    first = keep_first(all_rows, ["user_id"], ["__o1", "__sec", "__o2", "__o3"])
    vertices = export_typed(first)
    # a valid root belongs to its city even where its vertex came from an earlier retweeter record
    placed = first.filter(F.col("city").isNotNull() & (F.col("city") == F.col("target_location"))) \
        .select("user_id", "city").unionAll(valid.select("user_id", "city")).distinct()
    belongs = placed.select(
        edge_id("user_id", "city", F.lit("BELONGS_TO")).alias("~id"), F.col("user_id").alias("~from"),
        F.col("city").alias("~to"), F.lit("BELONGS_TO").alias("~label"))
    rt = rts.join(vroots.select("root_id"), "root_id").select(
        F.col("user_id").alias("~from"), F.col("root_id").alias("~to"), "__tw_ord", "pos", "tweet_id")
    ids = joined(in_chunks(rt, ["~from", "~to"], ["__tw_ord", "pos"], "tweet_id"), ["~from", "~to"], ";")
    retweeted = ids.select(edge_id("~from", "~to", F.lit("RETWEETED")).alias("~id"), "~from", "~to",
                           F.lit("RETWEETED").alias("~label"), F.col("n").alias("weight:Int"), F.col("text").alias("tweet_ids"))
    fol = followers.join(vroots.select("root_id"), "root_id").select(
        F.col("user_id").alias("~from"), F.col("root_id").alias("~to")).distinct()
    follows = fol.select(edge_id("~from", "~to", F.lit("FOLLOWS")).alias("~id"), "~from", "~to",
                         F.lit("FOLLOWS").alias("~label"))
    return {"vertices": vertices, "belongs_to": belongs, "retweeted": retweeted, "follows": follows}
