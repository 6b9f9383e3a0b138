"""Published runs: a run that dies anywhere leaves nothing, statuses fold over runs, the loop closes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from skein.operators import graph as gr
from skein.plans import jobs
from skein.streaming import queues as qu
from skein.streaming import runs
from skein.streaming.runs import RunStore

STORE = ("user_id STRING, username STRING, description STRING, profile_location STRING, target_location STRING, "
         "followers_count BIGINT, tweets_count BIGINT, city STRING")


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """These tables have a few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Killed(Exception):
    pass


def _land(folder, name, rows, ids=True):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r | ({"msg_id": f"{name}{i}"} if ids else {})) for i, r in enumerate(rows)))


def _person(uid, followers=500):
    return {"user_id": uid, "username": uid, "description": "d", "profile_location": "x", "target_location": "chicago",
            "followers_count": followers, "tweets_count": 9, "city": "chicago"}


def _state(spark, base):
    """All published rows of every table; ids of landed rows and folders are left out."""
    store = RunStore(spark, base)
    return {name: sorted((tuple(r) for r in store.table(name).collect()), key=repr) for name in store.manifest()["tables"]}


def _client(prompt):
    return '{"category": "media"}' if "news" in prompt else "no idea"


def _workers(spark):
    """name -> (landings, one run)."""
    roots = spark.createDataFrame([("r1", "chicago"), ("r2", "chicago")], "user_id STRING, target_location STRING")
    store = spark.createDataFrame([(r, r, None, "x", "chicago", 500, 3, "chicago") for r in ("r1", "r2")], STORE)
    queued = spark.createDataFrame([("1", "r1"), ("2", "r2")], "tweet_id STRING, target_user_id STRING")
    post = lambda t, r, n: {"tweet_id": t, "root_id": r, "tweet_text": "t" + t, "retweet_count": n, "created_on": "2025-01-0" + t}
    fol = lambda u, r: _person(u) | {"root_id": r, "ord": 1, "pos": 1}
    rt = lambda u, r, t: _person(u) | {"root_id": r, "tweet_id": t, "ord": 1, "pos": 1}
    obj = lambda u, n, v: {"user_id": u, "name": n, "value": v}
    return {
        "dispatch": ([[_person("a"), _person("b")], [_person("b"), _person("c")]],
                     lambda land, base: jobs.queue_workers(spark, land, store, base)),
        "posts": ([[post("1", "r1", 2), post("2", "r2", 0)], [post("3", "r1", 0), post("4", "r2", 3)]],
                  lambda land, base: jobs.posts_worker(spark, land, roots, base, "now")),
        "followers": ([[fol("f", "r1"), fol("g", "r2")], [fol("f", "r2"), fol("h", "r1")]],
                      lambda land, base: jobs.followers_worker(spark, land, roots, store, base)),
        "retweeters": ([[rt("u", "r1", "1"), rt("v", "r2", "2")], [rt("u", "r1", "1"), rt("u", "r2", "2")]],
                       lambda land, base: jobs.retweeters_worker(spark, land, queued, store, base)),
        "classify": ([[obj("u", "description", "bio"), obj("u", "tweet_1", "news")], [obj("v", "description", "bio")]],
                     lambda land, base: jobs.classify_worker(spark, land, base, "user_description user_tweets", _client)),
    }


@pytest.mark.parametrize("name", ["dispatch", "posts", "followers", "retweeters", "classify"])
def test_a_run_that_dies_is_repeated_whole(spark, tmp_dir, monkeypatch, name):
    landings, work = _workers(spark)[name]
    land, base = f"{tmp_dir}/land0", f"{tmp_dir}/whole"
    for k, rows in enumerate(landings):
        _land(land, f"l{k}", rows)
        work(land, base)
    want = _state(spark, base)
    land, base = f"{tmp_dir}/land1", f"{tmp_dir}/died"
    for k, rows in enumerate(landings):
        _land(land, f"l{k}", rows)
        seen = _state(spark, base)
        # after each output in turn, the last time just before they are published
        for dies_after in range(len(want) + 1) if k else [len(want)]:
            written = 0

            def stage(self, *a, real=runs.Run.stage, after=dies_after, **b):
                nonlocal written
                if written == after:
                    raise Killed
                real(self, *a, **b)
                written += 1

            def publish(self, *a, **b):
                raise Killed

            with monkeypatch.context() as m:
                m.setattr(runs.Run, "stage", stage)
                m.setattr(runs.Run, "publish", publish)
                with pytest.raises(Killed):
                    work(land, base)
            assert _state(spark, base) == seen  # nobody sees what it wrote
        work(land, base)
    assert _state(spark, base) == want


def test_equal_messages_without_an_id_are_all_handled(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    step = lambda df, run: {"out": df.select("user_id", F.lit(run).alias("run"))}
    _land(land, "a", [{"user_id": "u"}, {"user_id": "u"}], ids=False)
    qu.run_worker(spark, land, "user_id STRING, msg_id STRING", base, step)
    _land(land, "b", [{"user_id": "u"}], ids=False)
    _land(land, "c", [{"user_id": "n", "msg_id": "m"}, {"user_id": "n", "msg_id": "m"}], ids=False)
    qu.run_worker(spark, land, "user_id STRING, msg_id STRING", base, step)
    _land(land, "d", [{"user_id": "n", "msg_id": "m"}], ids=False)
    qu.run_worker(spark, land, "user_id STRING, msg_id STRING", base, step)
    assert qu.run_worker(spark, land, "user_id STRING, msg_id STRING", base, step) == {}  # nothing new: no run
    rows = sorted(map(tuple, RunStore(spark, base).table("out").collect()))
    assert rows == [("n", 2), ("u", 1), ("u", 1), ("u", 2)]


def test_a_run_reads_its_increment_only(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    seen = []

    def step(df, run):
        seen.append({f.rsplit("/landed/", 1)[1].split("/")[0] for f in df.inputFiles() if "/landed/" in f})
        return {"out": df}
    for name in "abc":
        _land(land, name, [{"user_id": name}])
        qu.run_worker(spark, land, "user_id STRING, msg_id STRING", base, step)
    assert seen == [{"00000001"}, {"00000002"}, {"00000003"}]


def test_tables_are_merged_by_tiers_and_statuses_folded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(runs, "TIER", 3)
    store = RunStore(spark, f"{tmp_dir}/s", {"status_log": runs.fold_status})
    for n in range(1, 11):
        run = store.begin()
        run.stage("status_log", spark.createDataFrame(
            [("u", "follower", "failed" if n == 4 else "queued", f"t{n:02d}", n), (f"u{n}", "follower", "pending", "t", n)],
            runs.STATUS_LOG))
        run.stage("plain", spark.createDataFrame([(n,)], "n INT"))
        run.publish()
        store.compact()
    assert sorted(r["n"] for r in store.table("plain").collect()) == list(range(1, 11))
    assert len(store.folders("plain")) < 6
    assert store.table("status_log").count() < 20  # 20 rows were written
    folded = {r["user_id"]: (r["status"], r["at"]) for r in runs.fold_status(store.table("status_log")).collect()}
    assert folded["u"] == ("failed", "t04") and len(folded) == 11


def test_two_runs_of_one_number_conflict(spark, tmp_dir):
    store = RunStore(spark, f"{tmp_dir}/s")
    one, two = store.begin(), store.begin()
    one.stage("t", spark.createDataFrame([(1,)], "n INT"))
    two.stage("t", spark.createDataFrame([(2,)], "n INT"))
    one.publish()
    with pytest.raises(runs.RunConflict):
        two.publish()
    assert [r["n"] for r in store.table("t").collect()] == [1]


def test_later_posts_do_not_complete_a_root_with_queued_ones(spark, tmp_dir):
    roots = spark.createDataFrame([("r1", "chicago"), ("r2", "chicago")], "user_id STRING, target_location STRING")
    store = spark.createDataFrame([("r1", "r1", None, "x", "chicago", 500, 3, "chicago")], STORE)
    post = lambda t, r, n: {"tweet_id": t, "root_id": r, "tweet_text": "t", "retweet_count": n, "created_on": "2025-01-0" + t}
    land, base, rts, out = (f"{tmp_dir}/{x}" for x in ("land", "posts", "rts", "retweeters"))
    status = lambda: {r["user_id"]: (r["retweeter_status"], r["retweeter_last_processed"], r["last_tweeted_at"])
                      for r in jobs.retweeter_statuses(spark, base, out).collect()}
    _land(land, "a", [post("1", "r1", 2), post("2", "r1", 1), post("3", "r2", 0)])
    jobs.posts_worker(spark, land, roots, base, "now1")
    _land(land, "b", [post("4", "r1", 0)])  # a later landing without reposts
    jobs.posts_worker(spark, land, roots, base, "now2")
    assert status() == {"r1": ("queued", None, "2025-01-04"), "r2": ("completed", "now1", "2025-01-03")}
    queued = RunStore(spark, base).table("messages")
    _land(rts, "a", [_person("u") | {"root_id": "r1", "tweet_id": "1", "ord": 1, "pos": 1}])
    jobs.retweeters_worker(spark, rts, queued, store, out, "now3")
    assert status()["r1"] == ("queued", None, "2025-01-04")
    _land(rts, "b", [{"root_id": "r1", "tweet_id": "2"}])  # nobody reposted after all
    jobs.retweeters_worker(spark, rts, queued, store, out, "now4")
    assert status()["r1"] == ("completed", "now4", "2025-01-04")
    assert RunStore(spark, out).table("vertices").count() == 1


def test_a_root_without_followers_fails(spark, tmp_dir):
    roots = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "user_id STRING")
    store = spark.createDataFrame([(r, r, None, "x", "chicago", 500, 3, "chicago") for r in ("r1", "r2", "r3")], STORE)
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    _land(land, "a", [_person("f") | {"root_id": "r1", "ord": 1, "pos": 1}, {"root_id": "r2"}])
    jobs.followers_worker(spark, land, roots, store, base, now="t1")
    status = lambda: {r["user_id"]: r["follower_status"] for r in jobs.follower_statuses(spark, base).collect()}
    assert status() == {"r1": "completed", "r2": "failed"}
    _land(land, "b", [{"root_id": "r1"}, _person("g") | {"root_id": "r2", "ord": 1, "pos": 1}, {"root_id": "r3"}])
    jobs.followers_worker(spark, land, roots, store, base, now="t2")
    assert status() == {"r1": "completed", "r2": "completed", "r3": "failed"}
    assert {r["user_id"] for r in RunStore(spark, base).table("vertices").collect()} == {"f", "g"}


def test_closed_loop_equals_the_batch_expansion(spark, tmp_dir, monkeypatch):
    people = [f"p{i}" for i in range(12)]
    who = lambda u: (u, u, None, "x", "chicago", 50 if u in ("p4", "p9") else 500, 3, "chicago")
    follows = [("p1", "p0"), ("p2", "p0"), ("p3", "p1"), ("p4", "p1"), ("p5", "p4"), ("p0", "p3"), ("p6", "p3"), ("p8", "p7")]
    posts = [("t1", "p2", "hello", 1, "2025-01-01"), ("t2", "p2", "RT @x", 4, "2025-01-02"), ("t3", "p6", "x", 2, "2025-01-03")]
    reposts = [("p7", "p2", "t1"), ("p9", "p2", "t2"), ("p9", "p6", "t3"), ("p10", "p6", "t3")]
    row = lambda u, root, k: (*who(u), root, k, 0)
    fol = spark.createDataFrame([row(u, r, k) for k, (u, r) in enumerate(follows)], f"{STORE}, root_id STRING, ord BIGINT, pos BIGINT")
    rts = spark.createDataFrame([(*who(u), r, k, 0, t) for k, (u, r, t) in enumerate(reposts)],
                                f"{STORE}, root_id STRING, ord BIGINT, pos BIGINT, tweet_id STRING")
    tweets = spark.createDataFrame([(r, t, x, n, d) for t, r, x, n, d in posts],
                                   "root_id STRING, tweet_id STRING, tweet_text STRING, retweet_count BIGINT, created_on STRING")
    seeds = spark.createDataFrame([who("p0")], STORE)
    edges = spark.createDataFrame([(u, r) for u, r in follows] + [("p7", "p2"), ("p9", "p6"), ("p10", "p6")], "source STRING, target STRING")
    batch = {r["user_id"] for r in gr.snowball(edges, spark.createDataFrame([who(u) for u in people], STORE),
                                               seeds.select("user_id"), 9).collect()}
    base = f"{tmp_dir}/loop"
    # the loop dies in its fourth run and is started again
    published = 0

    def publish(self, *a, real=runs.Run.publish, **b):
        nonlocal published
        if published == 3:
            published += 1
            raise Killed
        published += 1
        return real(self, *a, **b)
    with monkeypatch.context() as m:
        m.setattr(runs.Run, "publish", publish)
        with pytest.raises(Killed):
            jobs.collection_loop(spark, base, seeds, tweets, fol, rts, "now")
        out = jobs.collection_loop(spark, base, seeds, tweets, fol, rts, "now")
    assert {r["user_id"] for r in out["roots"].collect()} == batch == {"p0", "p1", "p2", "p3", "p6", "p7", "p8", "p10"}
    assert sorted((r["src"], r["dst"]) for r in out["follows"].collect()) == sorted(x for x in follows if x[1] in batch)
    assert sorted((r["src"], r["dst"], r["weight"]) for r in jobs.edge_weights(out["edge_tweets"]).collect()) == [
        ("p10", "p6", 1), ("p7", "p2", 1), ("p9", "p6", 1)]
    assert {r["user_id"]: r["retweeter_status"] for r in out["status"].collect()} == dict.fromkeys(batch, "completed")
