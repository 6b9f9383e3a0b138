"""Idempotent upserts and stream = batch for the queue steps."""

import json
import os

from pyspark.sql import functions as F

from skein.operators import upsert as up
from skein.streaming import queues as qu


def _v(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id STRING")


def test_upsert_retweets_idempotent(spark):
    v = _v(spark, ["a", "b", "c"])
    edges = spark.createDataFrame([("a", "b", 3)], "src STRING, dst STRING, weight BIGINT")
    ids = spark.createDataFrame([("a", "b", "t1", 1)], "src STRING, dst STRING, tweet_id STRING, ord BIGINT")
    batch = spark.createDataFrame([("a", "b", "t1", 5), ("a", "b", "t2", 6), ("a", "b", "t2", 7), ("c", "a", "t3", 8),
                                   ("z", "a", "t4", 9)], "src STRING, dst STRING, tweet_id STRING, ord BIGINT")
    e1, i1 = up.upsert_retweets(edges, ids, batch, v)
    e2, i2 = up.upsert_retweets(e1, i1, batch, v)
    w1 = {(r.src, r.dst): r.weight for r in e1.collect()}
    assert w1 == {("a", "b"): 4, ("c", "a"): 1}          # old weight kept (3), one new id; z->a has no vertex
    assert {(r.src, r.dst): r.weight for r in e2.collect()} == w1
    assert i2.count() == i1.count() == 3


def test_upsert_vertices_and_follows(spark):
    store = spark.createDataFrame([("a", "A")], "user_id STRING, username STRING")
    new = spark.createDataFrame([("a", "changed", 1), ("b", "B", 2), ("b", "B2", 3)], "user_id STRING, username STRING, ord INT")
    out = {r.user_id: r.username for r in up.upsert_vertices(store, new).collect()}
    assert out == {"a": "A", "b": "B"}
    f = spark.createDataFrame([("a", "b", 1)], "src STRING, dst STRING, weight BIGINT")
    batch = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "x")], "src STRING, dst STRING")
    got = {(r.src, r.dst) for r in up.upsert_follows(f, batch, _v(spark, ["a", "b"])).collect()}
    assert got == {("a", "b"), ("b", "a")}


def test_status_moves_forward_only(spark):
    v = spark.createDataFrame([("a", "completed", None), ("b", "pending", None)], "user_id STRING, s STRING, t STRING")
    u = spark.createDataFrame([("a", "queued", "t1"), ("b", "queued", "t2")], "user_id STRING, status STRING, at STRING")
    got = {r.user_id: r.s for r in up.advance_status(v, u, "s", "t").collect()}
    assert got == {"a": "completed", "b": "queued"}


def test_dispatch_stream_equals_batch(spark, tmp_dir):
    users = [{"user_id": str(i), "username": f"u{i}", "description": None, "profile_location": "Kolkata",
              "target_location": "kolkata", "followers_count": 50 + 40 * i, "tweets_count": i % 3, "city": "kolkata",
              "msg_id": f"m{i}", "sent_at": "2025-01-01T00:00:00"} for i in range(12)]
    land = f"{tmp_dir}/landing"
    os.makedirs(land)
    for k in range(3):
        with open(f"{land}/part{k}.json", "w") as f:
            for u in users[k * 4:(k + 1) * 4]:
                f.write(json.dumps(u) + "\n")
    ddl = ("user_id STRING, username STRING, description STRING, profile_location STRING, target_location STRING, "
           "followers_count BIGINT, tweets_count BIGINT, city STRING, msg_id STRING, sent_at STRING")
    store = _v(spark, ["5"])
    batch = qu.dispatch_roots(spark.read.schema(ddl).json(land), store)["messages"]
    stream = qu.read_queue(spark, land, ddl, max_files_per_trigger=1)
    msgs = qu.dispatch_roots(stream, store)["messages"]
    out = f"{tmp_dir}/out"
    qu.run_available(qu.write_messages(msgs, out, f"{tmp_dir}/ckpt"))
    got = {(r.user_id, r.location, r.topic) for r in spark.read.json(out).collect()}
    want = {(r.user_id, r.location, r.topic) for r in batch.collect()}
    assert got == want and len(got) > 0
    # replaying the same landing folder with the same checkpoint adds nothing
    qu.run_available(qu.write_messages(msgs, out, f"{tmp_dir}/ckpt"))
    assert spark.read.json(out).count() == len(want)


def test_city_must_exist(spark):
    import pytest
    v = spark.createDataFrame([("kolkata", "City"), ("1", "User")], "id STRING, label STRING")
    up.city_must_exist(v, "kolkata")
    with pytest.raises(ValueError):
        up.city_must_exist(v, "delhi")


def test_post_messages_keyed_by_target(spark, tmp_dir):
    land = f"{tmp_dir}/posts"
    os.makedirs(land)
    with open(f"{land}/a.json", "w") as f:
        for i in range(20):
            f.write(json.dumps({"tweet_id": f"t{i}", "target_user_id": str(i % 3), "location": "kolkata",
                                "msg_id": f"m{i}", "sent_at": "2025-01-01T00:00:00"}) + "\n")
    stream = qu.read_queue(spark, land, qu.msg_schema("tweet"))
    qu.run_available(qu.write_messages(stream.select("tweet_id", "target_user_id", "location"), f"{tmp_dir}/out",
                                       f"{tmp_dir}/ck", partition_by=None, key="target_user_id"))
    df = spark.read.json(f"{tmp_dir}/out").withColumn("f", F.input_file_name())
    files_per_key = df.groupBy("target_user_id").agg(F.countDistinct("f").alias("n")).collect()
    assert df.count() == 20 and all(r.n == 1 for r in files_per_key)
