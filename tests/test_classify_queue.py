"""Pluggable scorers, prompt replies, queue worker stream, retweeter processing, header gate."""

import json
import os

import pytest
from pyspark.sql import functions as F

from skein.streaming.runs import RunStore
from skein.functions import dims
from skein.operators import classify as cl
from skein.operators.export import conform_to_header
from skein.plans import jobs
from skein.streaming import queues as qu


def test_model_scores_failed_batch_keeps_rows(spark):
    df = spark.createDataFrame([(str(i), "text" if i != 3 else "boom") for i in range(6)], "user_id STRING, text STRING")

    def scorer(texts):
        if (texts == "boom").any():
            raise RuntimeError("model down")
        return [[1.0 if j == 1 else 0.0 for j in range(len(dims.ZERO_SHOT_LABELS))] for _ in texts]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        scored = cl.model_scores(df.repartition(1), "user_id", "text", scorer)
        out = {r.user_id: (r.content_labels, r.content_is_relevant) for r in cl.assign_label(scored).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")
    assert len(out) == 6
    assert out["3"] == ("", False)  # its text failed: kept, not relevant
    assert sum(1 for v in out.values() if v == ("environmental research", True)) == 5  # its batch did not


def test_keyword_scorer_ties_pick_first_label(spark):
    texts = spark.createDataFrame([("u", "air research"), ("u", "  "), ("v", "nothing here")], "user_id STRING, text STRING")
    s = cl.assign_label(cl.keyword_scores(texts, "user_id", "text", {
        "environment or pollution": ["air"], "environmental research": ["research"]}))
    got = {r.user_id: r.content_labels for r in s.collect()}
    assert got == {"u": "environment or pollution", "v": "other"}


def test_prompt_client_errors_give_null_reply(spark):
    df = spark.createDataFrame([("1", "fine"), ("2", "fail")], "k STRING, prompt STRING")

    def client(p):
        if p == "fail":
            raise ConnectionError("api")
        return '{"category": "media"}'
    got = {r.k: r.reply for r in cl.score_with_prompts(df, "k", "prompt", client).collect()}
    assert got == {"1": '{"category": "media"}', "2": None}


def test_classify_queue_keeps_single_post(spark):
    objs = spark.createDataFrame([("7", "description", "bio"), ("7", "tweet_1", "only post"), ("8", "description", "x")],
                                 "user_id STRING, name STRING, value STRING")
    got = {r.user_id: r.tweets for r in qu.classify_queue(objs).collect()}
    assert got == {"7": ["only post"], "8": []}


def test_header_gate(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"a": 1}',), ('{"b": 1, "a": 3}',)], "j STRING")
    ok, rejected = conform_to_header(df, "j", ["a", "b"])
    assert ok.count() == 2 and rejected.count() == 1


def test_process_retweeters_idempotent(spark):
    verts = spark.createDataFrame([("1", "u1", "Kolkata", "kolkata", 500, 3, "kolkata")],
                                  "user_id STRING, username STRING, profile_location STRING, target_location STRING, "
                                  "followers_count BIGINT, tweets_count BIGINT, city STRING")
    msgs = spark.createDataFrame([("t1", "1", "kolkata")], "tweet_id STRING, target_user_id STRING, location STRING")
    rts = spark.createDataFrame([("t1", "1", "2", "u2", "Calcutta", "kolkata", 900, 4, "kolkata", 1, 0),
                                 ("t1", "1", "3", "u3", "Delhi", "kolkata", 10, 0, None, 1, 1)],
                                "tweet_id STRING, root_id STRING, user_id STRING, username STRING, profile_location STRING, "
                                "target_location STRING, followers_count BIGINT, tweets_count BIGINT, city STRING, ord BIGINT, pos BIGINT")
    edges = spark.createDataFrame([], "src STRING, dst STRING, weight BIGINT")
    ids = spark.createDataFrame([], "src STRING, dst STRING, tweet_id STRING, ord BIGINT")
    out = qu.process_retweeters(msgs, rts, verts, edges, ids)
    assert {(r.src, r.dst, r.weight) for r in out["edges"].collect()} == {("2", "1", 1), ("3", "1", 1)}
    assert {r.user_id for r in out["dispatch"].collect()} == {"2"}  # only the qualifying retweeter
    again = qu.process_retweeters(msgs, rts, out["vertices"], out["edges"], out["edge_tweets"])
    assert {(r.src, r.dst, r.weight) for r in again["edges"].collect()} == {("2", "1", 1), ("3", "1", 1)}


def test_queue_worker_stream_drops_duplicate_messages(spark, tmp_dir):
    land = f"{tmp_dir}/land"
    os.makedirs(land)
    rows = [{"user_id": str(i), "username": f"u{i}", "description": "", "profile_location": "Kolkata",
             "target_location": "kolkata", "followers_count": 500, "tweets_count": 2, "city": "kolkata",
             "msg_id": f"m{i}", "sent_at": "2025-01-01T00:00:00"} for i in range(4)]
    with open(f"{land}/a.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    with open(f"{land}/b.json", "w") as f:  # the same messages delivered again
        f.write("\n".join(json.dumps(r) for r in rows[:2]))
    store = spark.createDataFrame([("3",)], "user_id STRING")
    jobs.queue_workers(spark, land, store, f"{tmp_dir}/out")
    got = sorted((r.user_id, r.topic) for r in RunStore(spark, f"{tmp_dir}/out").table("messages").collect())
    assert got == sorted((str(i), t) for i in range(3) for t in ("UserTweets", "UserFollowers"))


def test_text_classifier_trains(spark):
    docs = spark.createDataFrame([(i, ("good clean text " if i % 2 else "bad toxic junk ") * 3, i % 2) for i in range(60)],
                                 "doc_id BIGINT, text STRING, quality INT")
    from skein.operators.learn import train_text_classifier
    _, m = train_text_classifier(docs, "text", "quality", max_iter=20)
    r = m.first()
    assert r.n_train + r.n_test == 60 and r.accuracy > 0.9
