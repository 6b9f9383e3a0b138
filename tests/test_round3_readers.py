"""Headers of CSV files, saved classifiers and times that cannot be read."""

import gzip
import json
import os

import pytest

from skein.operators import export as ex
from skein.operators import learn as ln
from skein.sources import objects as ob
from skein.sources import readers as rd


def test_csv_by_header_name(spark, tmp_dir):
    ddl = "user_id STRING, name STRING, n BIGINT"

    def put(name, data):
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)

    put("a one.csv", b"\xef\xbb\xbfuser_id,name,n\r\n1,a,5\r\n2,\"b \"\"q\"\",\nc\",6\r\n")
    same = rd.read_csv(spark, tmp_dir, ddl)
    assert "Join" not in same._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in same.collect()} == {("1", "a", 5), ("2", 'b "q",\nc', 6)}
    put("b.csv", b'n,"odd\nname",user_id,extra,user_id\n7,x,3,y,9\n')
    put("c.csv", b"")
    put("d.csv", b"name\n")
    put("e.csv", b"name\nlast")
    put("f%20.csv.gz", gzip.compress(b"user_id\n11\n"))
    put("g.csv", ("user_id," + ",".join(f"c{i}" + "x" * 900 for i in range(100)) + ",name\n12" + "," * 100 + ",far\n").encode())
    want = {("1", "a", 5), ("2", 'b "q",\nc', 6), ("3", None, 7), (None, "last", None), ("11", None, None), ("12", "far", None)}
    assert {tuple(r) for r in rd.read_csv(spark, tmp_dir, ddl).collect()} == want
    assert rd.read_csv(spark, f"{tmp_dir}/c.csv", ddl).count() == 0
    assert rd.read_csv(spark, [f"{tmp_dir}/b.csv", f"{tmp_dir}/e.csv"], ddl).count() == 2


def test_classifier_is_saved_and_read(spark, tmp_dir):
    words = {"media": "news paper press", "activists": "march rally protest", "none": "dinner garden music"}
    rows = [(i, f"{w} number {i % 7}", k) for k, w in words.items() for i in range(60)] + [(900, None, "media"), (901, "x", "unknown")]
    rows = [(n, t, k) for n, (_, t, k) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, kind STRING")
    model, metrics = ln.train_text_classifier(df, "text", "kind", labels=list(words), num_features=1 << 10, save_to=f"{tmp_dir}/m")
    m = metrics.first()
    assert m["n_train"] + m["n_test"] == 181 and m["accuracy"] > 0.9 > m["majority_accuracy"]
    again, labels = ln.load_text_classifier(spark, f"{tmp_dir}/m")
    assert labels == list(words)
    wide = df.selectExpr("*", "1 AS features", "2 AS prediction")
    old, new = (ln.predict_labels(wide, "text", x, labels).orderBy("doc_id").collect() for x in (model, again))
    assert old == new and len(new) == len(rows) and new[0]["predicted"] == "media" and new[0]["features"] == 1
    assert ln.predict_labels(wide.limit(0), "text", again, labels).count() == 0


def test_unread_times(spark):
    df = spark.createDataFrame([("1", "2024-01-02 03:04:05"), ("2", "soon"), ("3", "soon"), ("4", ""), ("5", None), ("6", "null")],
                               "user_id STRING, last_tweeted_at STRING")
    assert [tuple(r) for r in ex.unread_times(df).collect()] == [("last_tweeted_at", "soon", 2)]
    assert [r["last_tweeted_at"] for r in ex.export_typed(df).orderBy("`~id`").collect()][1:] == ["null"] * 5
    with pytest.raises(Exception, match="no time in last_tweeted_at: soon"):
        ex.export_typed(df, strict=True).collect()
    assert ex.export_typed(df.filter("user_id > '3'"), strict=True).count() == 3
    assert ex.unread_times(df.select("user_id")).count() == 0


def test_dated_blocks_open_only_the_dates_asked(spark, tmp_path):
    root = f"{tmp_path}/dated"
    for day, ids in [("2025-01-01", ["1", "2"]), ("2025-01-02", ["3"]), ("2025-01-03", [])]:
        os.makedirs(f"{root}/run_date={day}")
        with open(f"{root}/run_date={day}/users.json", "w") as f:
            json.dump([{"user_id": i} for i in ids], f)
    ddl = "user_id STRING"
    some = rd.read_dated(spark, root, ddl, "run_date >= DATE '2025-01-02'")
    assert {(r.user_id, str(r.run_date)) for r in some.collect()} == {("3", "2025-01-02")}
    assert "run_date" in some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters", 1)[1]
    every = rd.read_dated(spark, root, ddl, "true")
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, rd.read_dated(spark, root, ddl).collect()))


def test_city_file_of_many_blocks_gives_every_record_once(spark, tmp_path):
    with open(f"{tmp_path}/new_york_media_users_filtered.json", "w") as f:
        json.dump([{"user_id": str(i), "username": "[,]" * (i % 7)} for i in range(3000)], f)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = ob.read_city_files(spark, str(tmp_path), "new york", "users", "user_id STRING, username STRING", strict=True)
        assert got.rdd.getNumPartitions() > 4
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted((int(r.user_id), r.username, r.file_name) for r in rows) == [
        (i, "[,]" * (i % 7), "new_york_media_users_filtered.json") for i in range(3000)]
