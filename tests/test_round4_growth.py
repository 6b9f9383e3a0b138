"""What the simple export writes and moves when its tables grow (round 4 finding)."""

import re

from pyspark.sql import functions as F

from skein.operators import export as ex
from skein.operators import long_lists as ll
from skein.plans.registry import queries


def _tables(spark):
    inter = spark.createDataFrame([
        ("a", "x", "1", 5, 1), ("a", "x", "2", 3, 2), ("b", "x", "3", 3, 1), (None, "x", "4", None, 1), ("a", "y", "5", 9, 1),
        (None, "x", "6", 1, 1), ("x", "x", None, 2, 1), ("b", "b", "8", 4, None)], "source string, target string, tweet_id string, ord bigint, pos int")
    users = spark.createDataFrame([("a", "A", 1), ("a", "A", 1), ("b", None, 2), ("x", "X", None), ("x", "X", None), ("x", "X", None),
                                   (None, "N", 4), (None, "N", 5), ("z", "Z", 6)], "user_id string, username string, followers_count bigint")
    return inter, users


def _carrying(inter, users):
    """Edges with the attributes of both ends, looked up edge by edge."""
    for end in ("source", "target"):
        inter = inter.join(users.select(F.col("user_id").alias(end), F.col("username").alias(f"{end}_username"),
                                        F.col("followers_count").alias(f"{end}_followers")), end, "left")
    return inter


def _rows(df):
    return sorted(map(str, df.collect()))


def test_simple_export_with_people_gives_the_same_tables(spark):
    """an id that repeats in people counts for each of its records, a null id and an unknown one keep their vertices."""
    inter, users = _tables(spark)
    for people in (users, users.dropDuplicates(["user_id"]), users.limit(0)):
        for kind in ("retweet", "follower"):
            v, e = ex.export_graph_simple(inter, kind, "c", people)
            v0, e0 = ex.export_graph_simple(_carrying(inter, people), kind, "c")
            assert v.columns == v0.columns and e.dtypes == e0.dtypes and _rows(v) == _rows(v0) and _rows(e) == _rows(e0)
    _, e = ex.export_graph_simple(inter, "retweet", "c", users)
    got = {(r["~from"], r["~to"]): (r["~id"], r["weight"], r["tweet_ids:String"]) for r in e.collect()}
    assert got[("a", "x")] == ("e4", 12, ",".join(["2"] * 6 + ["1"] * 6)) and got[(None, "x")] == ("e1", 6, "4,4,4,6,6,6")


def test_simple_vertices_move_no_edge_for_attributes(spark):
    """every edge moved twice with both ends' attributes, and the edges were derived once more for the vertices."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = queries()["k08_simple_vertices"](spark, "/root/testdata/sf0.001")
        plan = v._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not re.search(r"Exchange hashpartitioning\((source|target)#", plan) and "l_orderkey" not in plan


def test_whole_chunks_are_not_moved_again(spark):
    """every chunk moved to its key once more, also where it was the only one."""
    rows = [(f"k{k:02d}", i, f"{k}.{i}") for k, n in enumerate([4, 1, 3, 8, 1, 2, 1, 11, 2, 2, 1, 4, 5]) for i in range(n)] + [(None, 0, "n"), ("k99", 0, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    want = {}
    for k, _, v in rows:
        want.setdefault(k, []).append(v)
    for size in (1, 2, 4, 5, 64):
        chunks = ll.in_chunks(df, ["k"], ["o"], "v", size)
        found = chunks.collect()
        alone = {k for k in want if sum(r["k"] == k for r in found) == 1}
        assert {r["k"] for r in found if r["whole"]} <= alone
        assert sum(not r["whole"] and r["k"] in alone for r in found) <= 2 * (len(rows) // size + 1)
        assert {r["k"]: (r["n"], r["text"]) for r in ll.joined(chunks, ["k"], ";").collect()} == {
            k: (len(v), ";".join(x for x in v if x is not None)) for k, v in want.items()}


def test_columns_of_the_order_alone_are_not_stored(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("c", 1)], "`x:String` string, o int")
    assert sorted(map(tuple, ex.sequential_ids(df, ["o"], drop=("o",)).collect())) == [("a", "e3"), ("b", "e2"), ("c", "e1")]
