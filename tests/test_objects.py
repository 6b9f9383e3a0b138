"""Text objects in their layout, the file catalogue and tree synchronisation."""

import json
import os

import pytest
from pyspark.sql import functions as F

from skein.sources import objects as ob
from skein.sources import readers as rd


def _put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_object_files_round_trip(spark, tmp_dir):
    rows = [("new york", "7", "description", "bio é\nline two"), ("new york", "7", "tweet_1+2", "100% \"x\""), ("kolkata", "8", "tweet_3", None)]
    df = spark.createDataFrame(rows, ob.OBJECT).repartition(3)
    for _ in range(2):  # written again: the same objects
        ob.write_object_files(df, f"{tmp_dir}/networks")
    assert os.path.exists(f"{tmp_dir}/networks/new york/classification/7/input/description.txt")
    assert not [f for _, _, fs in os.walk(f"{tmp_dir}/networks/new york") for f in fs if not f.endswith(".txt")]
    got = sorted(map(tuple, rd.read_text_objects(spark, f"{tmp_dir}/networks").collect()))
    assert got == sorted((a, b, c, d or "") for a, b, c, d in rows)
    with pytest.raises(Exception, match="not the name of an object"):
        ob.write_object_files(df.withColumn("name", F.lit("../x")), f"{tmp_dir}/networks")


def test_catalogue_chooses_before_anything_is_opened(spark, tmp_dir):
    root = f"{tmp_dir}/raw dir"
    for name, uid in [("2025-01-01/New_York_media_users_filtered.json", "1"), ("new york_users_expanded_filtered.json", "2"),
                      ("new_york_media_list.json", "3"), ("delhi_users_filtered.json", "4")]:
        _put(f"{root}/{name}", json.dumps([{"user_id": uid}]))
    _put(f"{root}/new_york_notes.bin", "\x00 no json")
    files = ob.catalogue(spark, root, ["new york", "delhi"])
    assert {r["name"]: (r["cities"], r["is_users"], r["is_lists"], r["is_expanded"], r["ending"]) for r in files.collect()}[
        "New_York_media_users_filtered.json"] == (["new york"], True, False, False, "json")
    users = ob.read_city_files(spark, root, "New York", "users", "user_id STRING")
    assert [r["user_id"] for r in users.collect()] == ["1"] and len(users.inputFiles()) == 1
    assert ob.read_city_files(spark, root, "paris", "users", "user_id STRING").count() == 0
    with pytest.raises(FileNotFoundError):
        ob.read_city_files(spark, root, "paris", "users", "user_id STRING", strict=True)


def test_csv_families(spark, tmp_dir):
    for name, uid in [("kolkata_distinct_users.csv", "1"), ("kolkata_expanded_distinct_users.csv", "2"), ("x.txt", "9")]:
        _put(f"{tmp_dir}/csv/{name}", f"user_id,n\n{uid},1\n")
    assert [r["user_id"] for r in ob.read_csv_family(spark, f"{tmp_dir}/csv", "user_id STRING", ["distinct_users"], ["expanded"]).collect()] == ["1"]
    with pytest.raises(FileNotFoundError):
        ob.read_csv_family(spark, f"{tmp_dir}/csv", "user_id STRING", ["nothing"], strict=True)


def test_sync_copies_what_changed(spark, tmp_dir):
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    for name, text in [("x.txt", "one"), ("d/e f/y.txt", "two"), ("d/z.txt", "")]:
        _put(f"{a}/{name}", text)
    _put(f"{b}/only there.txt", "stays")
    names = lambda df: sorted(r["relative"] for r in df.collect())
    assert names(ob.sync_directory(spark, a, b)) == ["d/e f/y.txt", "d/z.txt", "x.txt"]
    assert names(ob.sync_directory(spark, a, b)) == []
    _put(f"{a}/x.txt", "ONE")  # the same size
    _put(f"{a}/d/z.txt", "longer")
    assert names(ob.changed_files(spark, a, b)) == ["d/z.txt", "x.txt"]
    assert names(ob.sync_directory(spark, a, b)) == ["d/z.txt", "x.txt"]
    assert open(f"{b}/x.txt").read() == "ONE" and open(f"{b}/d/e f/y.txt").read() == "two" and open(f"{b}/only there.txt").read() == "stays"
    assert names(ob.sync_directory(spark, f"{tmp_dir}/none", b)) == []
