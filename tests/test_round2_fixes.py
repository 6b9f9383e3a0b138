"""Repeated keys, late messages, landed time forms, mixed CSV headers, session settings."""

import json
import os


from skein.streaming.runs import RunStore
from skein.functions.predicates import date_window
from skein.operators import export as ex
from skein.operators.upsert import patch_vertices
from skein.plans import jobs
from skein.session import missing_settings
from skein.sources import readers as rd
from skein.sources import sinks as sk
from skein.streaming import queues as qu


def _user(uid, msg, sent="2024-01-01T12:00:00", **more):
    return {"user_id": uid, "username": uid, "description": "d", "profile_location": "x", "target_location": "chicago",
            "followers_count": 500, "tweets_count": 9, "city": "chicago", "msg_id": msg, "sent_at": sent} | more


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(map(json.dumps, rows)))


def test_worker_keeps_late_messages_and_drops_repeats(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/work"
    store = spark.createDataFrame([("known",)], "user_id string")
    _land(land, "a", [_user("a", "m1"), _user("known", "m2"), _user("a", "m1")])
    jobs.queue_workers(spark, land, store, base)
    _land(land, "b", [_user("late", "m3", "2024-01-01T09:00:00"), _user("b", "m4", "2024-01-01T12:30:00"),
                      _user("a", "m5"), _user("n1", None), _user("n2", None)])
    jobs.queue_workers(spark, land, store, base)
    jobs.queue_workers(spark, land, store, base)
    got = sorted((r["user_id"], r["topic"]) for r in RunStore(spark, base).table("messages").collect())
    assert got == sorted((u, t) for u in ("a", "late", "b", "n1", "n2") for t in (qu.TOPIC_TWEETS, qu.TOPIC_FOLLOWERS))
    assert RunStore(spark, base).table("roots").count() == RunStore(spark, base).table("objects").count() == 5


def test_follower_of_two_roots_is_dispatched_once_and_edges_stay(spark):
    ddl = ("root_id string, user_id string, username string, profile_location string, target_location string, "
           "followers_count bigint, tweets_count bigint, city string, verified boolean")
    fol = spark.createDataFrame([(r, "f", "f", "x", "chicago", 500, 3, "chicago", True) for r in ("r1", "r2")], ddl)
    roots = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "user_id string")
    verts = spark.createDataFrame([(r, r, "x", "chicago", 500, 3, "chicago", None) for r in ("r1", "r2")],
                                  ddl.replace("root_id string, ", ""))
    edges = spark.createDataFrame([("old", "r1", 1)], "src string, dst string, weight bigint")
    out = qu.process_followers(roots, fol, verts, True, edges)
    assert out["dispatch"].count() == 2
    assert {(r["src"], r["dst"]) for r in out["follows"].collect()} == {("old", "r1"), ("f", "r1"), ("f", "r2")}
    assert [r["verified"] for r in out["vertices"].filter("user_id = 'f'").collect()] == [True]
    assert {r["user_id"]: r["follower_status"] for r in out["status"].collect()} == {
        "r1": "completed", "r2": "completed", "r3": "failed"}


def test_patch_vertices_reduces_updates(spark):
    v = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "user_id string, name string, city string")
    u = spark.createDataFrame([("1", "n1", None, 1), ("1", None, "c2", 2), ("1", "n3", None, 3)],
                              "user_id string, name string, city string, at int")
    assert sorted(map(tuple, patch_vertices(v, u, order="at").collect())) == [("1", "n3", "c2"), ("2", "b", "y")]
    assert patch_vertices(v, u.drop("at")).count() == 2


def test_typed_export_takes_landed_times(spark):
    df = spark.createDataFrame(
        [("1", "Fri Dec 06 18:09:05 +0000 2024", "null", "2024-07-01T10:00:00", "2024-07-01T10:00:00+00:00"),
         ("2", None, "", "no time", "Fri Dec 06 18:09:05 +0000 2024")],
        "user_id string, created_at string, retweeter_last_processed string, extracted_at string, last_updated string")
    got = {r["~id"]: r.asDict() for r in ex.export_typed(df).collect()}
    pick = lambda i, c: next(v for k, v in got[i].items() if k.split(":")[0] == c)
    assert pick("1", "created_at") == "Fri Dec 06 18:09:05 +0000 2024" and pick("2", "created_at") == "null"
    assert pick("1", "retweeter_last_processed") == pick("2", "retweeter_last_processed") == "null"
    assert pick("1", "extracted_at").startswith("2024-07-01T15:00:00") and pick("2", "extracted_at") == "null"
    assert pick("1", "last_updated").startswith("2024-07-01T10:00:00")
    assert pick("2", "last_updated").startswith("2024-12-06T18:09:05")


def test_csv_files_with_two_headers(spark, tmp_dir):
    for name, text in (("a", "user_id,username\n1,ann\n"), ("b", "username,user_id\nbob,2\n"), ("c", "user_id\n3\n")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(text)
    got = rd.read_csv(spark, tmp_dir, "user_id string, username string")
    assert sorted(map(tuple, got.collect())) == [("1", "ann"), ("2", "bob"), ("3", None)]


def test_text_objects_round_trip(spark, tmp_dir):
    rows = [("chicago", "u1", "description", "a"), ("chicago", "u2", "tweet_1", ""), ("bogota", "u1", "tweet_2", "ñ\nx")]
    df = spark.createDataFrame(rows, "location string, user_id string, name string, value string")
    sk.write_text_objects(df, f"{tmp_dir}/o")
    assert sorted(map(tuple, rd.read_text_objects(spark, f"{tmp_dir}/o").collect())) == sorted(rows)


def test_default_date_window(spark):
    df = spark.sql("SELECT timestamp'2024-01-10 00:00:00' AS now, explode(array(timestamp'2024-01-04 00:00:00', "
                   "timestamp'2024-01-03 23:59:59', timestamp'2024-01-09 23:59:00', timestamp'2024-01-09 23:58:59')) AS ts")
    assert [r[0] for r in df.select(date_window("ts", now="now")).collect()] == [True, False, False, True]
    assert df.filter(date_window("ts", "2024-01-05", None)).count() == 2


def test_cluster_settings_win():
    have = {"spark.master", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"}
    got = missing_settings(have, "local[2]", 4)
    assert not set(got) & (have | {"spark.driver.memory"})
    assert missing_settings(set(), "local[2]", 4)["spark.master"] == "local[2]"
