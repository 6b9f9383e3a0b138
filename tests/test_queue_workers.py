"""Queue workers over several landings: outputs are appended once, whatever is delivered again."""

import json
import os

from skein.plans import jobs
from skein.streaming.runs import RunStore

STORE = ("user_id STRING, username STRING, description STRING, profile_location STRING, target_location STRING, "
         "followers_count BIGINT, tweets_count BIGINT, city STRING")


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r | {"msg_id": f"{name}{i}"}) for i, r in enumerate(rows)))


def _person(uid, followers=500):
    return {"user_id": uid, "username": uid, "description": "d", "profile_location": "x", "target_location": "chicago",
            "followers_count": followers, "tweets_count": 9, "city": "chicago"}


def _rows(spark, path, *cols):
    base, name = path.rsplit("/", 1)
    return sorted(map(tuple, RunStore(spark, base).table(name).select(*cols).collect()))


def test_posts_worker(spark, tmp_dir):
    roots = spark.createDataFrame([("r1", "chicago"), ("r2", "chicago"), ("r3", "chicago")], "user_id STRING, target_location STRING")
    post = lambda t, r, text, n: {"tweet_id": t, "root_id": r, "tweet_text": text, "retweet_count": n, "created_on": "2025-01-0" + t}
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    _land(land, "a", [post("1", "r1", "hello", 2), post("2", "r1", "RT @x: y", 5), post("3", "r2", "plain", 0), post("4", "zz", "no root", 1)])
    jobs.posts_worker(spark, land, roots, base, "now")
    jobs.posts_worker(spark, land, roots, base, "now")
    assert _rows(spark, f"{base}/messages", "tweet_id", "target_user_id") == [("1", "r1")]
    assert _rows(spark, f"{base}/objects", "user_id", "name") == [("r1", "tweet_1"), ("r2", "tweet_3")]
    assert _rows(spark, f"{base}/status", "user_id", "retweeter_status", "last_tweeted_at") == [
        ("r1", "queued", "2025-01-02"), ("r2", "completed", "2025-01-03")]


def test_followers_worker(spark, tmp_dir):
    roots = spark.createDataFrame([("r1",), ("r2",)], "user_id STRING")
    store = spark.createDataFrame([(r, r, None, "x", "chicago", 500, 3, "chicago") for r in ("r1", "r2")], STORE)
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    fol = lambda u, r, n=500: _person(u, n) | {"root_id": r, "ord": 1, "pos": 1}
    _land(land, "a", [fol("f", "r1"), fol("f", "r2"), fol("small", "r1", 3)])
    jobs.followers_worker(spark, land, roots, store, base)
    _land(land, "b", [fol("f", "r1"), fol("g", "r1")])
    jobs.followers_worker(spark, land, roots, store, base)
    assert _rows(spark, f"{base}/vertices", "user_id") == [("f",), ("g",), ("small",)]
    assert _rows(spark, f"{base}/follows", "src", "dst") == [("f", "r1"), ("f", "r2"), ("g", "r1"), ("small", "r1")]
    assert _rows(spark, f"{base}/messages", "user_id") == [("f",), ("f",), ("g",), ("g",)]
    assert ("r1", "completed") in _rows(spark, f"{base}/status", "user_id", "follower_status")


def test_retweeters_worker(spark, tmp_dir):
    posts = spark.createDataFrame([("t1", "r1"), ("t2", "r1")], "tweet_id STRING, target_user_id STRING")
    store = spark.createDataFrame([("r1", "r1", None, "x", "chicago", 500, 3, "chicago")], STORE)
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    rt = lambda u, t, pos: _person(u) | {"root_id": "r1", "tweet_id": t, "ord": 1, "pos": pos}
    _land(land, "a", [rt("u", "t1", 0), rt("v", "t1", 1), rt("u", "t9", 2)])
    jobs.retweeters_worker(spark, land, posts, store, base)
    _land(land, "b", [rt("u", "t1", 0), rt("u", "t2", 1)])
    jobs.retweeters_worker(spark, land, posts, store, base)
    edges = jobs.edge_weights(RunStore(spark, base).table("edge_tweets"))
    assert sorted(map(tuple, edges.collect())) == [("u", "r1", 2), ("v", "r1", 1)]
    assert _rows(spark, f"{base}/vertices", "user_id") == [("u",), ("v",)]
    assert len(_rows(spark, f"{base}/messages", "user_id")) == 4


def _client(prompt):
    return '{"category": "media"}' if "news" in prompt else "no idea"


def test_classify_worker(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    obj = lambda u, n, v: {"user_id": u, "name": n, "value": v}
    _land(land, "a", [obj("u", "description", "bio"), obj("u", "tweet_1", "news"), obj("v", "description", "bio")])
    jobs.classify_worker(spark, land, base, "user_description user_tweets", _client)
    jobs.classify_worker(spark, land, base, "user_description user_tweets", _client)
    assert _rows(spark, f"{base}/classified", "user_id", "category") == [("u", "media"), ("v", None)]
