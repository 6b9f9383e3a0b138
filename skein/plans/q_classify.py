"""Queries for classification and learning."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.fixtures import KEYWORDS
from skein.functions import dims
from skein.functions.text import parse_category, render_prompt
from skein.operators import classify as cl
from skein.operators import learn as ln
from skein.plans.registry import register, tables
from skein.plans.sqlbits import in_list, words_expr

LABELS = dims.ZERO_SHOT_LABELS
PROMPT = "Description:\nuser_description\nPosts:\nuser_tweets\nAnswer as {\"category\": ...}"


def _score_sql(todo: str) -> str:
    """SQL of the keyword scorer over the users of CTE ``todo``: CTE ``lab`` (user_id, content_labels)."""
    sums = ",\n  ".join(
        f"CAST(sum(len(list_filter(w, lambda x: list_contains({list(KEYWORDS[lab])}, x)))) AS DOUBLE) AS s{i}"
        for i, lab in enumerate(LABELS) if lab != "other")
    arr = ", ".join([f"coalesce(p.s{i}, 0.0)" for i, lab in enumerate(LABELS) if lab != "other"] + ["0.5"])
    return f"""
texts AS (SELECT user_id, coalesce(description, '') AS text FROM {todo}
  UNION ALL SELECT t.author_id, t.tweet_text FROM fx_tweets t WHERE t.author_id IN (SELECT user_id FROM {todo})),
toks AS (SELECT user_id, {words_expr("coalesce(text, '')")} AS w FROM texts),
per AS (SELECT user_id, {sums} FROM toks GROUP BY user_id),
sc AS (SELECT u.user_id, [{arr}] AS scores FROM {todo} u LEFT JOIN per p ON p.user_id = u.user_id),
lab AS (SELECT user_id, {list(LABELS)}[list_position(scores, list_max(scores))] AS content_labels, scores FROM sc)"""


@register("m01_keyword_scores", f"""
WITH todo AS (SELECT user_id, description FROM fx_users), {_score_sql('todo')}
SELECT user_id, {", ".join(f"scores[{i + 1}] AS s{i}" for i in range(len(LABELS)))} FROM lab""")
def m01_keyword_scores(spark, sf_dir):
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    texts = cl.user_texts(users, tweets.join(users.select(F.col("user_id").alias("author_id")), "author_id", "left_semi"))
    s = cl.keyword_scores(texts, "user_id", "text", KEYWORDS, LABELS)
    base = F.array(*[F.lit(0.0) if lab != "other" else F.lit(cl.OTHER_BASELINE) for lab in LABELS])
    s = users.select("user_id").join(s, "user_id", "left").withColumn("scores", F.coalesce("scores", base))
    return s.select("user_id", *[F.col("scores")[i].alias(f"s{i}") for i in range(len(LABELS))])


@register("m02_assign_label", f"""
WITH todo AS (SELECT user_id, description FROM fx_users), {_score_sql('todo')}
SELECT user_id, content_labels, content_labels <> 'other' AS content_is_relevant FROM lab""")
def m02_assign_label(spark, sf_dir):
    """M1 + M2 (A15 arg-max, F10) over every account; all accounts kept."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    return cl.classify_users(users.select("user_id", "description"), tweets, KEYWORDS).select(
        "user_id", "content_labels", "content_is_relevant")


@register("m03_classify_incremental", f"""
WITH prev AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS user_id,
    CASE WHEN quality = 1 THEN 'environmental research' ELSE 'other' END AS content_labels,
    quality = 1 AS content_is_relevant FROM labels),
todo AS (SELECT user_id, description FROM fx_users WHERE user_id NOT IN (SELECT user_id FROM prev)),
{_score_sql('todo')}
SELECT user_id, content_labels, content_is_relevant FROM prev
UNION
SELECT user_id, content_labels, content_labels <> 'other' FROM lab""")
def m03_classify_incremental(spark, sf_dir):
    """Previously classified accounts (labelled ids) are kept; the rest are classified and appended."""
    users, tweets, labels = tables(spark, sf_dir, "fx_users", "fx_tweets", "labels")
    prev = labels.select(F.col("doc_id").cast("string").alias("user_id"),
                         F.when(F.col("quality") == 1, "environmental research").otherwise("other").alias("content_labels"),
                         (F.col("quality") == 1).alias("content_is_relevant"))
    return cl.classify_incremental(users.select("user_id", "description", "ord"), tweets, prev, KEYWORDS)


@register("m04_reclassify_relevant", f"""
WITH todo AS (SELECT user_id, description FROM fx_users), {_score_sql('todo')}
SELECT user_id, content_labels FROM lab WHERE content_labels <> 'other'""")
def m04_reclassify_relevant(spark, sf_dir):
    """M4 with the optional relevance filter switched on (F18 off). Every account is landed twice; its
    first record counts."""
    users, tweets = tables(spark, sf_dir, "fx_users", "fx_tweets")
    once = users.select("user_id", "description", "ord")
    again = once.withColumns({"description": F.lit("the of and"), "ord": F.col("ord") + (1 << 40)})
    out = cl.reclassify_all(once.unionByName(again), tweets, KEYWORDS)
    return out.filter("content_is_relevant").select("user_id", "content_labels")


_SHEET_SQL = """
sheet AS (SELECT d.doc_id, d.source AS description, '[' || d.text || ']' AS tweets,
  CASE WHEN l.quality = 1 THEN 'Researchers' WHEN l.toxic = 1 THEN 'news outlet or journalist' ELSE 'other' END AS mc
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


def _sheet(spark, sf_dir):
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    return docs.join(labels, "doc_id").select(
        "doc_id", F.col("source").alias("description"), F.concat(F.lit("["), "text", F.lit("]")).alias("tweets"),
        F.when(F.col("quality") == 1, "Researchers").when(F.col("toxic") == 1, "news outlet or journalist")
        .otherwise("other").alias("manual classification"))


@register("m05_clean_labelled", f"""
WITH {_SHEET_SQL},
c AS (SELECT doc_id, description, CASE WHEN mc = 'Researchers' THEN 'environmental research' ELSE mc END AS mc,
  replace(replace(replace(replace(tweets, '[', ''), ']', ''), chr(10), ''), '  ', '') AS tweets FROM sheet)
SELECT doc_id, mc AS "manual classification", tweets,
  CASE WHEN tweets = '' THEN coalesce(description, 'nan') ELSE coalesce(description, 'nan') || ' ' || tweets END AS token
FROM c""")
def m05_clean_labelled(spark, sf_dir):
    out = ln.clean_labelled(_sheet(spark, sf_dir))
    return out.select("doc_id", "manual classification", "tweets", "token")


@register("m06_label_index", f"""
WITH {_SHEET_SQL}
SELECT doc_id, CAST(list_position({list(dims.FINETUNE_LABELS)},
  CASE WHEN mc = 'Researchers' THEN 'environmental research' ELSE mc END) - 1 AS INTEGER) AS label FROM sheet""")
def m06_label_index(spark, sf_dir):
    out = ln.clean_labelled(_sheet(spark, sf_dir))
    return out.select("doc_id", ln.label_index(F.col("`manual classification`")).alias("label"))


@register("m07_train_text_classifier")
def m07_train_text_classifier(spark, sf_dir):
    """Quality classifier trained on documents joined with labels; returns held-out metrics."""
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    _, metrics = ln.train_text_classifier(docs.join(labels, "doc_id"), "text", "quality")
    return metrics


def rule_client(prompt: str) -> str:
    """A stand-in reply client (no network): answers by the dominant script of the prompt."""
    text = prompt.lower()
    if " der " in text or " und " in text:
        return '{"category": "researchers"}'
    if " la " in text or " le " in text:
        return "The answer is {'category': 'media'} because of the posts."
    if " de " in text:
        return '{"category": "Politicians"}'
    return "I cannot tell."


def _conv_prompts(spark, sf_dir):
    (conv,) = tables(spark, sf_dir, "conversations")
    first = conv.filter(F.col("turn") == 0).select("conv_id", F.col("text").alias("description"))
    rest = conv.filter(F.col("turn") > 0).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("__t"))
    j = first.join(rest, "conv_id", "full_outer")
    tw = F.transform(F.coalesce("__t", F.array().cast("array<struct<turn:bigint,text:string>>")), lambda s: s["text"])
    return j.select(F.col("conv_id").cast("string").alias("conv_id"),
                    render_prompt(PROMPT, F.col("description"), tw).alias("prompt"))


@register("p21_render_prompts", f"""
WITH f AS (SELECT conv_id, text FROM conversations WHERE turn = 0),
r AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS tw FROM conversations WHERE turn > 0 GROUP BY conv_id)
SELECT CAST(coalesce(f.conv_id, r.conv_id) AS VARCHAR) AS conv_id,
  replace(replace('{PROMPT.replace(chr(10), "' || chr(10) || '")}', 'user_description', coalesce(f.text, '')),
    'user_tweets', coalesce(r.tw, '')) AS prompt
FROM f FULL OUTER JOIN r ON r.conv_id = f.conv_id""")
def p21_render_prompts(spark, sf_dir):
    """One prompt per conversation: first turn as description, later turns as posts (one per line)."""
    return _conv_prompts(spark, sf_dir)


_P21_SQL = f"""
f AS (SELECT conv_id, text FROM conversations WHERE turn = 0),
r AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS tw FROM conversations WHERE turn > 0 GROUP BY conv_id),
pr AS (SELECT CAST(coalesce(f.conv_id, r.conv_id) AS VARCHAR) AS conv_id,
  replace(replace('{PROMPT.replace(chr(10), "' || chr(10) || '")}', 'user_description', coalesce(f.text, '')),
    'user_tweets', coalesce(r.tw, '')) AS prompt
FROM f FULL OUTER JOIN r ON r.conv_id = f.conv_id)"""


@register("m08_score_with_prompts", f"""
WITH {_P21_SQL},
rep AS (SELECT conv_id, CASE
  WHEN strpos(lower(prompt), ' der ') > 0 OR strpos(lower(prompt), ' und ') > 0 THEN '{{"category": "researchers"}}'
  WHEN strpos(lower(prompt), ' la ') > 0 OR strpos(lower(prompt), ' le ') > 0
    THEN 'The answer is {{''category'': ''media''}} because of the posts.'
  WHEN strpos(lower(prompt), ' de ') > 0 THEN '{{"category": "Politicians"}}'
  ELSE 'I cannot tell.' END AS reply FROM pr)
SELECT conv_id, reply, CASE WHEN lower(trim(coalesce(CASE WHEN json_valid(reply) THEN json_extract_string(reply, '$.category') END,
  nullif(regexp_extract(reply, '[''"]category[''"]\\s*:\\s*[''"]([^''"]+)[''"]', 1), ''))))
  IN {in_list(dims.PROMPT_CATEGORIES)} THEN lower(trim(coalesce(CASE WHEN json_valid(reply) THEN json_extract_string(reply, '$.category') END,
  nullif(regexp_extract(reply, '[''"]category[''"]\\s*:\\s*[''"]([^''"]+)[''"]', 1), '')))) END AS category
FROM rep""")
def m08_score_with_prompts(spark, sf_dir):
    """Prompts -> replies through a pluggable client (here a rule stand-in) -> parsed category."""
    replies = cl.score_with_prompts(_conv_prompts(spark, sf_dir), "conv_id", "prompt", rule_client)
    return replies.select("conv_id", "reply", parse_category("reply").alias("category"))


@register("x17_parse_category", f"""
WITH r AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN '{{"category": "' || CASE WHEN turn < 2 THEN 'media' ELSE 'Healthcare' END || '"}}'
  ELSE 'reply ''category'': ''' || CASE WHEN turn < 3 THEN 'other' ELSE 'chefs' END || '''' END AS reply FROM conversations)
SELECT conv_id, turn, reply, CASE WHEN lower(trim(coalesce(CASE WHEN json_valid(reply) THEN json_extract_string(reply, '$.category') END,
  nullif(regexp_extract(reply, '[''"]category[''"]\\s*:\\s*[''"]([^''"]+)[''"]', 1), ''))))
  IN {in_list(dims.PROMPT_CATEGORIES)} THEN lower(trim(coalesce(CASE WHEN json_valid(reply) THEN json_extract_string(reply, '$.category') END,
  nullif(regexp_extract(reply, '[''"]category[''"]\\s*:\\s*[''"]([^''"]+)[''"]', 1), '')))) END AS category
FROM r""")
def x17_parse_category(spark, sf_dir):
    (conv,) = tables(spark, sf_dir, "conversations")
    reply = F.when(F.col("role") == "user", F.concat(F.lit('{"category": "'), F.when(F.col("turn") < 2, "media")
                                                     .otherwise("Healthcare"), F.lit('"}'))) \
        .otherwise(F.concat(F.lit("reply 'category': '"), F.when(F.col("turn") < 3, "other").otherwise("chefs"),
                            F.lit("'")))
    r = conv.select("conv_id", "turn", reply.alias("reply"))
    return r.select("conv_id", "turn", "reply", parse_category("reply").alias("category"))
