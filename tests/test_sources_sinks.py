"""Readers and writers on files written by the test (ragged JSON, text objects, versions)."""

import json
import os

from pyspark.sql import functions as F

from skein.operators.dedupe import dedupe_by_key
from skein.sources import objects as ob
from skein.sources import readers as rd
from skein.sources import sinks as sk


def test_ragged_json_flattens_one_level(spark, tmp_dir):
    p = f"{tmp_dir}/users_ragged.json"
    with open(p, "w") as f:
        json.dump([{"user_id": "1"}, [{"user_id": "2"}, {"user_id": "3"}], "junk", [], {"user_id": "1", "name": "dup"}], f)
    df = rd.read_ragged_json(spark, p, "user_id STRING, name STRING")
    assert [r.user_id for r in df.orderBy("pos", "sub").collect()] == ["1", "2", "3", "1"]
    first = dedupe_by_key(df, ["pos", "sub"])
    assert {(r.user_id, r.name) for r in first.collect()} == {("1", None), ("2", None), ("3", None)}


def test_missing_file_is_empty(spark, tmp_dir):
    assert rd.read_json_array(spark, f"{tmp_dir}/nope.json", "user_id STRING").count() == 0
    assert rd.read_processed_ids(spark, f"{tmp_dir}/nope").count() == 0


def test_append_distinct_writes_versions(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "user_id STRING, v STRING")
    b = spark.createDataFrame([("2", "y"), ("3", "z")], "user_id STRING, v STRING")
    sk.append_distinct(a, path)
    sk.append_distinct(b, path)
    assert sk.versions(spark, path) == [0, 1]
    assert sorted(r.user_id for r in sk.read_distinct(spark, path).collect()) == ["1", "2", "3"]
    assert [r.user_id for r in rd.read_processed_ids(spark, f"{path}/v=1").collect()] == ["3"]
    sk.append_distinct(spark.createDataFrame([("3", "z", None), (None, None, 5)], "user_id STRING, v STRING, w INT"), path)
    sk.append_distinct(spark.createDataFrame([(None, None, 5)], "user_id STRING, v STRING, w INT"), path)
    assert sk.read_distinct(spark, path).count() == 4


def test_text_objects_round_trip(spark, tmp_dir):
    base = f"{tmp_dir}/networks"
    for user, name, text in [("7", "description", "bio"), ("7", "tweet_t1", "hello"), ("8", "tweet_t2", "x")]:
        d = f"{base}/kolkata/classification/{user}/input"
        os.makedirs(d, exist_ok=True)
        with open(f"{d}/{name}.txt", "w") as f:
            f.write(text)
    df = rd.read_text_objects(spark, base)
    got = {(r.location, r.user_id, r.name, r.value) for r in df.collect()}
    assert ("kolkata", "7", "tweet_t1", "hello") in got and len(got) == 3
    sk.write_text_objects(df, f"{tmp_dir}/objects")
    assert spark.read.parquet(f"{tmp_dir}/objects").count() == 3


def test_city_files_by_name(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    os.makedirs(root)
    for fname, uid in [("kolkata_media_users_filtered.json", "1"), ("kolkata_media_users_expanded_filtered.json", "2"),
                       ("kolkata_media_list.json", "3"), ("delhi_media_users_filtered.json", "4")]:
        with open(f"{root}/{fname}", "w") as f:
            json.dump([{"user_id": uid}], f)
    users = ob.read_city_files(spark, root, "kolkata", "users", "user_id STRING")
    assert [r.user_id for r in users.collect()] == ["1"]
    exp = ob.read_city_files(spark, root, "kolkata", "expanded", "user_id STRING")
    assert [r.user_id for r in exp.collect()] == ["2"]


def test_land_pages_last_page_wins(spark):
    p0 = spark.createDataFrame([("a", 0, 0, "old"), ("b", 0, 1, "b0")], "id STRING, page INT, pos INT, v STRING")
    p1 = spark.createDataFrame([("a", 1, 0, "new"), ("a", 1, 1, "newer-in-page")], "id STRING, page INT, pos INT, v STRING")
    out = {r.id: r.v for r in rd.land_pages([p0, p1], "id").collect()}
    assert out == {"a": "new", "b": "b0"}


def test_dated_folders_become_a_partition_column(spark, tmp_dir):
    root = f"{tmp_dir}/dated"
    for day, uid in [("2025-01-01", "1"), ("2025-01-02", "2")]:
        os.makedirs(f"{root}/run_date={day}")
        with open(f"{root}/run_date={day}/users.json", "w") as f:
            json.dump([{"user_id": uid}], f)
    df = rd.read_dated(spark, root, "user_id STRING")
    got = {(r.user_id, str(r.run_date)) for r in df.filter(F.col("run_date") >= "2025-01-02").collect()}
    assert got == {("2", "2025-01-02")}
    plan = df.filter(F.col("run_date") >= "2025-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_csv_family_selection_and_labelled_sheet(spark, tmp_dir):
    root = f"{tmp_dir}/csv"
    os.makedirs(root)
    for fname, uid in [("kolkata_distinct_users.csv", "1"), ("kolkata_expanded_distinct_users.csv", "2"),
                       ("delhi_distinct_users.csv", "3")]:
        with open(f"{root}/{fname}", "w", encoding="utf-8-sig") as f:
            f.write("user_id,description,tweets,manual classification\n")
            f.write(f'{uid},"bio, with comma","[\'a\']",Researchers\n')
    df = rd.read_csv(spark, root, "user_id STRING, description STRING, tweets STRING, `manual classification` STRING")
    fam = rd.select_files(df, ["distinct_users"], ["expanded"])
    assert sorted(r.user_id for r in fam.collect()) == ["1", "3"]
    sheet = rd.read_labelled(spark, f"{root}/kolkata_distinct_users.csv")
    r = sheet.first()
    assert (r.description, r["manual classification"]) == ("bio, with comma", "Researchers")
