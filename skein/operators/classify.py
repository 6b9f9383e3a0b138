"""Topic classification of accounts.

The model is pluggable. Two scorers are offered:

* ``keyword_scores`` - a deterministic keyword scorer that runs entirely as
  built-in expressions: each text row (a description or one post) is tokenised,
  keyword hits per label are counted per row and summed per account with a hash
  aggregate. Scoring is distributive, so an account with millions of posts is
  scored by many tasks and its text is never concatenated into one row.
* ``model_scores`` - any batch scorer (e.g. a zero-shot transformer) applied
  with ``mapInPandas`` on Arrow batches (``spark.sql.execution.arrow.maxRecordsPerBatch``
  plays the reference's batch size).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.predicates import is_relevant_label
from skein.functions.text import classification_text, words

OTHER_BASELINE = 0.5  # "other" wins only when no label keyword occurs


def argmax_label(scores: Column, labels: list[str]) -> Column:
    """Label with the highest score, the first one on ties."""
    return F.element_at(dims.lit_array(labels), F.array_position(scores, F.array_max(scores)).cast("int"))


def keyword_scores(texts: DataFrame, key: str, text: str, keywords: dict[str, list[str]],
                   labels: list[str] = dims.ZERO_SHOT_LABELS) -> DataFrame:
    """M1 (built-in scorer): per key, an array of label scores in ``labels`` order.

    ``texts`` holds any number of text rows per key (description, posts); ``keywords`` lists the words
    of each label. One pass over a text's words finds the listed ones; labels are counted among those.
    """
    listed = sorted({w for lab in labels for w in keywords.get(lab, [])})
    hits = F.filter(words(F.coalesce(F.col(text), F.lit(""))), lambda w: w.isin(listed))
    found = texts.select(F.col(key), hits.alias("__w"))

    def count(ks: list[str]) -> Column:
        return F.size(F.filter("__w", lambda w: w.isin(ks))) if ks else F.lit(0)

    per_row = found.select(key, *[count(keywords.get(lab, [])).alias(f"__s{i}") for i, lab in enumerate(labels)])
    agg = per_row.groupBy(key).agg(*[F.sum(f"__s{i}").cast("double").alias(f"__s{i}") for i in range(len(labels))])
    scores = [F.col(f"__s{i}") if lab != "other" else F.lit(OTHER_BASELINE) for i, lab in enumerate(labels)]
    return agg.select(key, F.array(*scores).alias("scores"))


def model_scores(df: DataFrame, key: str, text: str, scorer: Callable[[pd.Series], list[list[float]]],
                 labels: list[str] = dims.ZERO_SHOT_LABELS) -> DataFrame:
    """M1 (pluggable model): ``scorer`` maps a batch of texts to per-label scores.

    A batch that fails is tried again text by text, so only the failing texts stay without scores; their
    rows are kept and carry the error in ``score_error`` (null for scored rows).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, errors = pdf[text].fillna(""), [None] * len(pdf)
            try:
                out = [list(map(float, r)) for r in scorer(texts)]
            except Exception:  # noqa: BLE001 - find the failing texts
                out = []
                for i in range(len(pdf)):
                    try:
                        out += [list(map(float, r)) for r in scorer(texts.iloc[i:i + 1])]
                    except Exception as e:  # noqa: BLE001 - reported in the row
                        out.append(None)
                        errors[i] = f"{type(e).__name__}: {e}"[:500]
            yield pd.DataFrame({key: pdf[key], "scores": pd.Series(out, index=pdf.index, dtype=object),
                                "score_error": pd.Series(errors, index=pdf.index, dtype=object)})

    from skein.session import ship_code
    ship_code(df.sparkSession)
    return df.select(key, text).mapInPandas(run, f"{key} string, scores array<double>, score_error string")


def assign_label(scored: DataFrame, labels: list[str] = dims.ZERO_SHOT_LABELS, only_relevant: bool = False) -> DataFrame:
    """M2: arg-max label and relevance (label != other); unscored -> relevant false, empty label.

    Every account is kept unless ``only_relevant`` (F18: the reference keeps all).
    """
    lab = argmax_label(F.col("scores"), labels)
    out = scored.withColumn("content_labels", F.when(F.col("scores").isNull(), F.lit("")).otherwise(lab)) \
        .withColumn("content_is_relevant", F.when(F.col("scores").isNull(), F.lit(False))
                    .otherwise(is_relevant_label(lab)))
    return out.filter("content_is_relevant") if only_relevant else out


def user_texts(users: DataFrame, tweets: DataFrame, key: str = "user_id", author: str = "author_id",
               tweet_text: str = "tweet_text") -> DataFrame:
    """P11 in long form: one text row per description and per post."""
    d = users.select(F.col(key), F.coalesce(F.col("description"), F.lit("")).alias("text"))
    t = tweets.select(F.col(author).alias(key), F.col(tweet_text).alias("text"))
    return d.unionByName(t)


def classify_users(users: DataFrame, tweets: DataFrame, keywords: dict[str, list[str]],
                   labels: list[str] = dims.ZERO_SHOT_LABELS, key: str = "user_id") -> DataFrame:
    """M1 + M2 for every user of ``users`` (users without text score as 'other')."""
    texts = user_texts(users, tweets.join(users.select(F.col(key).alias("author_id")), "author_id", "left_semi"))
    scored = keyword_scores(texts, key, "text", keywords, labels)
    return assign_label(users.select(key).join(scored, key, "left").withColumn(
        "scores", F.coalesce("scores", F.array(*[F.lit(0.0) if lab != "other" else F.lit(OTHER_BASELINE)
                                                  for lab in labels]))), labels)


def classify_incremental(users: DataFrame, tweets: DataFrame, previous: DataFrame, keywords: dict[str, list[str]],
                         labels: list[str] = dims.ZERO_SHOT_LABELS, key: str = "user_id") -> DataFrame:
    """M3: dedupe users, skip those already classified, classify the rest,
    union with the previous result and drop identical records."""
    from skein.operators.dedupe import dedupe_whole, row_order, unique_by
    u = unique_by(users, key, row_order(users, key))
    todo = u.join(previous.select(key), key, "left_anti")
    new = classify_users(todo, tweets, keywords, labels, key).select(key, "content_labels", "content_is_relevant")
    return dedupe_whole(previous.select(key, "content_labels", "content_is_relevant").unionByName(new))


def reclassify_all(users: DataFrame, tweets: DataFrame, keywords: dict[str, list[str]],
                   labels: list[str] = dims.ZERO_SHOT_LABELS, key: str = "user_id") -> DataFrame:
    """M4: classify every user again (no skip); the caller overwrites the output."""
    from skein.operators.dedupe import row_order, unique_by
    first = unique_by(users, key, row_order(users, key))
    return classify_users(first, tweets, keywords, labels, key)


def score_with_prompts(df: DataFrame, key: str, prompt: str, client: Callable[[str], str]) -> DataFrame:
    """M8: one reply per prompt from a user-supplied client; an error gives a null reply."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies = []
            for p in pdf[prompt]:
                try:
                    replies.append(client(p))
                except Exception:  # noqa: BLE001 - API error -> no reply
                    replies.append(None)
            yield pd.DataFrame({key: pdf[key], "reply": replies})

    from skein.session import ship_code
    ship_code(df.sparkSession)
    return df.select(key, prompt).mapInPandas(run, f"{key} string, reply string")


def concat_text(description: Column, tweets: Column) -> Column:
    """P11 for a user record that already holds its posts as an array."""
    return classification_text(description, tweets)
