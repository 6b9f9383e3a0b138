"""Queries for scalar functions, list filters, query rendering and user projections
(X1-X12, F3, F5, F7, F8, F12, F13, F16, P8, P9, P13, P14, P19, P20, P22, P26, P28, J10, L16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions import predicates as pr
from skein.functions import text as tx
from skein.operators import normalize as nm
from skein.operators.long_lists import in_chunks, joined
from skein.plans.registry import register, tables
from skein.plans.sqlbits import in_list, words_expr


@register("x01_parse_post_date", """
SELECT event_id, strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') AS posted,
  CAST(epoch(strptime(substr(strftime(ts, '%a %b %d %H:%M:%S +0000 %Y'), 5), '%b %d %H:%M:%S %z %Y')) AS BIGINT) AS parsed_epoch
FROM events""")
def x01_parse_post_date(spark, sf_dir):
    """Post-style dates ("Fri Dec 06 18:09:05 +0000 2024") rendered from event times and parsed back."""
    (ev,) = tables(spark, sf_dir, "events")
    posted = F.date_format(F.col("ts").cast("timestamp"), "EEE MMM dd HH:mm:ss '+0000' yyyy")
    return ev.select("event_id", posted.alias("posted")).select(
        "event_id", "posted", F.unix_timestamp(tx.parse_post_date("posted")).alias("parsed_epoch"))


@register("x02_parse_any_date", """
SELECT o_orderkey AS order_key, CAST(epoch(o_orderdate) AS BIGINT) AS parsed_epoch FROM orders""")
def x02_parse_any_date(spark, sf_dir):
    """Order dates landed in two text formats (ISO and post style) parse to the same instants."""
    (orders,) = tables(spark, sf_dir, "orders")
    ts = F.col("o_orderdate").cast("timestamp")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "EEE MMM dd HH:mm:ss '+0000' yyyy"))
    return orders.select(F.col("o_orderkey").alias("order_key"),
                         F.unix_timestamp(tx.parse_any_date(text)).alias("parsed_epoch"))


@register("x03_chicago_to_utc", """
SELECT event_id, CAST(floor(epoch(timezone('America/Chicago', ts))) AS BIGINT) AS utc_epoch FROM events""")
def x03_chicago_to_utc(spark, sf_dir):
    (ev,) = tables(spark, sf_dir, "events")
    return ev.select("event_id", F.unix_timestamp(tx.chicago_to_utc("ts")).alias("utc_epoch"))


@register("x05_iso", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS created_at FROM orders""")
def x05_iso(spark, sf_dir):
    (orders,) = tables(spark, sf_dir, "orders")
    return orders.select("o_orderkey", tx.iso(F.col("o_orderdate").cast("timestamp")).alias("created_at"))


@register("p14_user_date_id", """
SELECT event_id, substr(CAST(ts AS VARCHAR), 1, 10) AS tweet_date,
  CAST(user_id AS VARCHAR) || '-' || substr(CAST(ts AS VARCHAR), 1, 10) AS user_date_id FROM events""")
def p14_user_date_id(spark, sf_dir):
    """X4 + P14: 10-character date and the user-day key."""
    (ev,) = tables(spark, sf_dir, "events")
    return ev.select("event_id", tx.date10("ts").alias("tweet_date"),
                     tx.user_date_id(F.col("user_id").cast("string"), "ts").alias("user_date_id"))


@register("x06_str_to_bool", """
SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'click' THEN true WHEN 'signup' THEN true
  ELSE false END AS flag FROM events""")
def x06_str_to_bool(spark, sf_dir):
    """Truth strings in several spellings (yes/ON/1 ... no/off/0) parsed to booleans."""
    (ev,) = tables(spark, sf_dir, "events")
    spelled = (F.when(F.col("event_type") == "view", "Yes").when(F.col("event_type") == "click", "ON")
               .when(F.col("event_type") == "signup", "1").when(F.col("event_type") == "purchase", "off")
               .otherwise("No"))
    return ev.select("event_id", tx.str_to_bool(spelled).alias("flag"))


@register("x07_clean_post", """
SELECT doc_id, replace(replace(replace(replace(text, '[', ''), ']', ''), chr(10), ''), '  ', '') AS cleaned FROM documents""")
def x07_clean_post(spark, sf_dir):
    (docs,) = tables(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.clean_post("text").alias("cleaned"))


@register("x10_words", f"""
SELECT doc_id, len({words_expr('text')}) AS n_words FROM documents""")
def x10_words(spark, sf_dir):
    (docs,) = tables(spark, sf_dir, "documents")
    return docs.select("doc_id", F.size(tx.words("text")).cast("bigint").alias("n_words"))


@register("x11_word_chars", """
SELECT doc_id, CAST(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS INTEGER) AS n_word_runs FROM documents""")
def x11_word_chars(spark, sf_dir):
    """Unicode word runs per document, by an explicit class (engines disagree on \\w)."""
    (docs,) = tables(spark, sf_dir, "documents")
    return docs.select("doc_id", F.size(tx.word_chars("text")).alias("n_word_runs"))


@register("x12_id_lists", """
WITH g AS (SELECT source, target, string_agg(tweet_id, ';' ORDER BY ord, pos, tweet_id) AS ids, min(tweet_id) AS first_id
  FROM fx_interactions GROUP BY source, target)
SELECT source, target, len(string_split(ids, ';')) AS n_ids, list_contains(string_split(ids, ';'), first_id) AS has_first,
  CASE WHEN list_contains(string_split(ids, ';'), 'x') THEN ids ELSE ids || ';x' END AS appended FROM g""")
def x12_id_lists(spark, sf_dir):
    """';'-joined id lists: split, membership, append-if-absent."""
    (inter,) = tables(spark, sf_dir, "fx_interactions")
    lists = joined(in_chunks(inter, ["source", "target"], ["ord", "pos"], "tweet_id"), ["source", "target"], ";")
    g = lists.withColumnRenamed("text", "ids").join(
        inter.groupBy("source", "target").agg(F.min("tweet_id").alias("first_id")), ["source", "target"])
    return g.select("source", "target", F.size(tx.id_list("ids")).cast("bigint").alias("n_ids"),
                    tx.id_list_contains("ids", "first_id").alias("has_first"),
                    tx.id_list_append("ids", F.lit("x")).alias("appended"))


@register("f03_f05_originals", """
SELECT tweet_id, coalesce(tweet_text NOT LIKE 'RT @%', true) AS is_original,
  retweet_count > 0 AND coalesce(tweet_text NOT LIKE 'RT @%', true) AS has_retweets FROM fx_tweets""")
def f03_f05_originals(spark, sf_dir):
    (tweets,) = tables(spark, sf_dir, "fx_tweets")
    return tweets.select("tweet_id", pr.is_original("tweet_text").alias("is_original"),
                         pr.has_retweets("retweet_count", "tweet_text").alias("has_retweets"))


_KW = in_list(dims.LIST_KEYWORDS)


@register("f07_list_relevant", f"""
SELECT list_id, coalesce(len(list_filter({words_expr('name')}, lambda w: w IN {_KW})) > 0, false)
  OR coalesce(len(list_filter({words_expr('description')}, lambda w: w IN {_KW})) > 0, false) AS relevant
FROM fx_lists""")
def f07_list_relevant(spark, sf_dir):
    (lists,) = tables(spark, sf_dir, "fx_lists")
    return lists.select("list_id", pr.list_relevant("name", "description").alias("relevant"))


@register("f08_list_relevant_substring", f"""
SELECT DISTINCT list_id FROM fx_lists WHERE len(list_filter({list(dims.LIST_KEYWORDS_SUBSTRING)},
  lambda k: strpos(lower(coalesce(name, '')), k) > 0 OR strpos(lower(coalesce(description, '')), k) > 0)) > 0""")
def f08_list_relevant_substring(spark, sf_dir):
    """Distinct list ids whose name or description contains a keyword (older filter)."""
    (lists,) = tables(spark, sf_dir, "fx_lists")
    return lists.filter(pr.list_relevant_substring("name", "description")).select("list_id").distinct()


@register("l16_filter_lists", f"""
SELECT list_id, user_id, name, description FROM (
  SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY ord) AS rn FROM fx_lists) x
WHERE rn = 1 AND (coalesce(len(list_filter({words_expr('name')}, lambda w: w IN {_KW})) > 0, false)
  OR coalesce(len(list_filter({words_expr('description')}, lambda w: w IN {_KW})) > 0, false))""")
def l16_filter_lists(spark, sf_dir):
    """Job: list file -> 4 columns (P22) -> unique list ids (D4) -> relevant lists."""
    from skein.plans.jobs import filter_lists
    (lists,) = tables(spark, sf_dir, "fx_lists")
    return filter_lists(lists)


@register("f12_date_window", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'""")
def f12_date_window(spark, sf_dir):
    (ev,) = tables(spark, sf_dir, "events")
    return ev.filter(pr.date_window(F.col("ts").cast("timestamp"), "2024-01-10", "2024-01-17")).select("event_id")


@register("f16_skip_types", """
SELECT user_id, search_account_type FROM fx_users WHERE search_account_type NOT IN ('BUILDING')""")
def f16_skip_types(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    return users.filter(pr.skip_types("search_account_type", ["BUILDING"])).select("user_id", "search_account_type")


@register("p09_conform_users", """
SELECT user_id, username, name, description, location, CAST(NULL AS BIGINT) AS tweet_count, followers_count,
  following_count, CAST(NULL AS BIGINT) AS listed_count, content_labels IS NOT NULL AS content_is_relevant,
  content_labels, search_account_type, CAST(NULL AS VARCHAR) AS tweet_date, search_location,
  'https://twitter.com/' || username AS user_url, false AS list_expansion
FROM fx_users WHERE user_id IS NOT NULL""")
def p09_conform_users(spark, sf_dir):
    """P9 + F9 + P8 + P26: the 14 user columns, search city, profile URL, expansion flag."""
    (users,) = tables(spark, sf_dir, "fx_users")
    src = users.withColumn("content_is_relevant", F.col("content_labels").isNotNull()) \
        .drop("tweets_count")
    return nm.conform_users(src, list_expansion=False).drop("tweets")


@register("p13_account_type_from_name", """
SELECT user_id, regexp_extract(fname, '^(.+?)_([a-z]+)_users', 2) AS account_type FROM (
  SELECT user_id, replace(search_location, ' ', '-') || '_' || lower(search_account_type) || '_users_filtered.json' AS fname
  FROM fx_users) x""")
def p13_account_type_from_name(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    fname = F.concat(F.replace("search_location", F.lit(" "), F.lit("-")), F.lit("_"),
                     F.lower("search_account_type"), F.lit("_users_filtered.json"))
    return users.select("user_id", nm.account_type_from_name(fname).alias("account_type"))


def _cities_sql() -> str:
    alias_rows = ", ".join(f"('{a}', '{c}')" for a, c in dims.ALIASES.items())
    lang_rows = ", ".join(f"('{c}', '{lang}')" for c, lang in dims.CITY_LANGS.items())
    return f"""
locs AS (SELECT DISTINCT lower(trim(location)) AS city FROM fx_users WHERE location IS NOT NULL AND trim(location) <> ''),
al AS (SELECT * FROM (VALUES {alias_rows}) t(alias, main)),
lg AS (SELECT * FROM (VALUES {lang_rows}) t(city, lang)),
cl AS (SELECT l.city, coalesce(al.main, l.city) AS main, lg.lang FROM locs l LEFT JOIN al ON al.alias = l.city
  LEFT JOIN lg ON lg.city = coalesce(al.main, l.city))"""


def _templates_sql() -> str:
    rows = []
    for lang, tmpl in dims.QUERY_TEMPLATES.items():
        for t, q in tmpl.items():
            rows.append("('{}', '{}', '{}')".format(lang, t, q.replace("'", "''")))
    return f"tp AS (SELECT * FROM (VALUES {', '.join(rows)}) t(lang, account_type, template))"


_SQUEEZE = "replace(replace(trim(replace({x}, chr(10), ' '), ' ' || chr(9) || chr(10) || chr(13)), '  ', ' '), chr(9), ' ')"


@register("p19_render_queries", f"""
WITH {_cities_sql()}, {_templates_sql()},
ty AS (SELECT * FROM (VALUES {", ".join(f"('{t}')" for t in dims.ACCOUNT_TYPES)}) t(account_type))
SELECT cl.city, ty.account_type, {_SQUEEZE.format(x="replace(tp.template, 'location', cl.city)")} AS query
FROM cl JOIN ty ON true LEFT JOIN tp ON tp.lang = cl.lang AND tp.account_type = ty.account_type""")
def p19_render_queries(spark, sf_dir):
    """J10 + P28 + P19: every landed location string x account type -> search query (null when unknown)."""
    (users,) = tables(spark, sf_dir, "fx_users")
    cities = users.filter(F.col("location").isNotNull() & (F.trim("location") != "")) \
        .select(F.lower(F.trim("location")).alias("city")).distinct()
    return nm.render_queries(cities, "city")


@register("p20_render_alias_queries", f"""
WITH {_templates_sql()},
al AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{c}', {i})" for i, (a, c) in enumerate(dims.ALIASES.items()))}) t(alias, main, rn)),
lg AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{lang}')" for c, lang in dims.CITY_LANGS.items())}) t(city, lang)),
cs AS (SELECT DISTINCT search_location AS city FROM fx_users),
ors AS (SELECT cs.city, cs.city || coalesce((SELECT string_agg(' OR ' || alias, '' ORDER BY rn) FROM al a
  WHERE a.main = cs.city), '') AS aliases FROM cs)
SELECT o.city, tp.account_type,
  {_SQUEEZE.format(x="replace(tp.template, 'location', o.aliases)")} || ' since:2025-01-01 until:2025-01-07' AS query
FROM ors o JOIN lg ON lg.city = o.city JOIN tp ON tp.lang = lg.lang""")
def p20_render_alias_queries(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    cities = users.select(F.col("search_location").alias("city")).distinct()
    return nm.render_alias_queries(cities, "city", "since:2025-01-01 until:2025-01-07")


@register("p28_city_file_key", f"""
WITH {_cities_sql()} SELECT city, main FROM cl""")
def p28_city_file_key(spark, sf_dir):
    (users,) = tables(spark, sf_dir, "fx_users")
    cities = users.filter(F.col("location").isNotNull() & (F.trim("location") != "")) \
        .select(F.lower(F.trim("location")).alias("city")).distinct()
    return cities.select("city", nm.city_file_key(F.col("city")).alias("main"))


_PLAIN = "' ' || trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g')) || ' '"


#: Ends of the posts that the search is tried on: words, phrases, parts of words, several languages.
_TAILS = ["breaking", "Breaking-NEWS", "prensa local", "air quality!", "bias officers", "la calidad del aire", "(presse)",
          "healthcare professional", "professional in healthcare", "news"]
_TAILED = ("t.tweet_text || ' ' || CASE t.ord % 10 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_TAILS))
           + " END || CASE WHEN t.ord % 3 <> 0 THEN ' ' || u.search_location ELSE '' END")


@register("f13_topic_match", f"""
WITH {_templates_sql()},
alt AS (SELECT lang, account_type, unnest(regexp_split_to_array(replace(template, '-is:retweet', ' '), '\\bOR\\b')) AS a FROM tp),
term AS (SELECT lang, account_type, a, unnest(list_concat(regexp_extract_all(a, '"([^"]+)"', 1),
    string_split_regex(replace(regexp_replace(a, '"[^"]*"', ' ', 'g'), 'location', ' '), '\\s+'))) AS t FROM alt),
need AS (SELECT lang, account_type, a, list({_PLAIN.format(x="t")}) FILTER (trim({_PLAIN.format(x="t")}) <> '') AS ts
  FROM term GROUP BY ALL),
post AS (SELECT t.tweet_id, t.lang, {_PLAIN.format(x=_TAILED)} AS p,
  {_PLAIN.format(x="u.search_location")} AS c
  FROM fx_tweets t JOIN fx_users u ON u.user_id = t.author_id WHERE coalesce(t.tweet_text NOT LIKE 'RT @%', true))
SELECT DISTINCT tweet_id, account_type FROM post JOIN need ON need.lang = post.lang
WHERE ts IS NOT NULL AND strpos(p, c) > 0 AND len(list_filter(ts, lambda x: strpos(p, x) = 0)) = 0""")
def f13_topic_match(spark, sf_dir):
    """Original posts that name their author's search city, tagged with every account type whose
    search they satisfy (posts get a topic's words and, two of three, the city's name appended)."""
    tweets, users = tables(spark, sf_dir, "fx_tweets", "fx_users")
    t = tweets.join(users.select(F.col("user_id").alias("author_id"), "search_location"), "author_id")
    tail = F.element_at(F.array(*map(F.lit, _TAILS)), (F.col("ord") % 10 + 1).cast("int"))
    here = F.when(F.col("ord") % 3 != 0, F.concat(F.lit(" "), "search_location")).otherwise("")
    text = F.concat("tweet_text", F.lit(" "), tail, here)
    return nm.topic_match(t.select("tweet_id", text.alias("text"), "lang", "search_location"), "text", "lang",
                          F.col("search_location"))
