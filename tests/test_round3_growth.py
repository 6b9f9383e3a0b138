"""What a job writes and moves when its tables grow (round 3 findings)."""

import os
import re

from pyspark.sql import functions as F

from skein.operators import dedupe as dd
from skein.operators import export as ex
from skein.operators import graph as gr
from skein.operators import long_lists as ll
from skein.plans import jobs
from skein.plans.registry import queries
from skein.session import ensure_checkpoint_dir, stored
from skein.sources import objects as ob
from skein.sources.readers import read_text_objects


def _checkpointed(spark) -> set[str]:
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(base) if d.startswith("rdd-")}


def _edges(spark):
    rows = [(f"s{i % 40}", f"t{i % 7}", 1 + i % 3) for i in range(400)] + [("s1", "s2", 1), ("t1", "s1", 2)]
    return spark.createDataFrame(rows, "src string, dst string, weight bigint")


def _steps(spark, monkeypatch, edges, parts):
    kept, cls = [], type(edges)
    persist = cls.persist
    monkeypatch.setattr(cls, "persist", lambda df, *a: kept.append(df) or persist(df, *a))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        ranks = {r.id: r["rank"] for r in gr.pagerank(None, edges, fixed_iterations=4, partitions=parts).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    return ranks, [df._jdf.queryExecution().executedPlan().toString() for df in kept if "rank" in df.columns]


def test_pagerank_steps_leave_the_edges_in_place(spark, monkeypatch):
    """With fewer parts than shuffle partitions every step dealt the edge table anew."""
    ranks, plans = _steps(spark, monkeypatch, _edges(spark), 3)
    assert len(plans) == 4 and abs(sum(ranks.values()) - 1) < 1e-9
    for plan in plans:
        assert not re.search(r"Exchange hashpartitioning\(src#\d+, \d+\), ENSURE_REQUIREMENTS", plan)


def test_pagerank_hot_source_gives_the_same_ranks(spark, monkeypatch):
    hot = spark.range(300).select(F.lit("hub").alias("src"), F.concat(F.lit("x"), "id").alias("dst"), F.lit(1).cast("bigint").alias("weight"))
    edges = _edges(spark).unionByName(hot).unionByName(hot.select(F.col("dst").alias("src"), F.lit("hub").alias("dst"), "weight").limit(50))
    many, one = _steps(spark, monkeypatch, edges, 5)[0], _steps(spark, monkeypatch, edges, 1)[0]
    assert many.keys() == one.keys() and all(abs(many[k] - one[k]) < 1e-12 for k in one)


def test_numbering_writes_no_whole_rows(spark):
    """The sorted copy was an uncompressed checkpoint of whole rows."""
    df = spark.range(500).select((500 - F.col("id")).alias("n"), F.lit("x" * 50).alias("~to:String"))
    before = _checkpointed(spark)
    rows = ll.numbered(df, ["n"]).orderBy("__no").collect()
    assert [(r["__no"], r["n"]) for r in rows] == [(i, i + 1) for i in range(500)] and rows[0]["~to:String"] == "x" * 50
    assert _checkpointed(spark) <= before


def test_stored_keeps_rows_names_and_untyped_columns(spark):
    df = spark.createDataFrame([(1, None, [1, None]), (None, "a\n", None)], "`a b` int, `a:Int` string, c array<int>")
    back = stored(df)
    assert back.dtypes == df.dtypes and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    void = df.select("a b", F.lit(None).alias("v"))
    assert sorted(map(str, stored(void).collect())) == sorted(map(str, void.collect()))


def _interactions(spark):
    rows = [("a", "x", "1", 5, 1), ("a", "x", "2", 3, 2), ("b", "x", "3", 3, 1), (None, "x", "4", None, 1), ("a", "y", "5", 9, 1), (None, "x", "6", 1, 1)]
    e = spark.createDataFrame(rows, "source string, target string, tweet_id string, ord bigint, pos int")
    for side in ("source", "target"):
        e = e.withColumns({f"{side}_username": F.lit(f"u{side}"), f"{side}_followers": F.lit(1).cast("bigint")})
    return e


def test_simple_edges_need_one_pass(spark, monkeypatch):
    """the first places came from a second aggregate over the edges, joined with the chunks."""
    edges = _interactions(spark)
    calls, cls = [], type(edges)
    plain = cls.join
    monkeypatch.setattr(cls, "join", lambda df, other, on=None, how=None: calls.append(on) or plain(df, other, on, how))
    _, e = ex.export_graph_simple(edges, "retweet", "c")
    assert calls == ["__pid", "__pid"]  # the offsets of the two numberings
    got = [tuple(r) for r in e.select("~id", "~from", "~to", "weight", "tweet_ids:String").orderBy("~id").collect()]
    assert got == [("e1", None, "x", 2, "4,6"), ("e2", "b", "x", 1, "3"), ("e3", "a", "x", 2, "2,1"), ("e4", "a", "y", 1, "5")]


def test_graph_report_names_the_top_alone(spark, monkeypatch):
    """every vertex's attributes were chosen a second time for the few of the top."""
    asked, touching = [], gr.edges_touching
    monkeypatch.setattr(gr, "edges_touching", lambda e, top: asked.append(sorted(r.id for r in top.collect())) or touching(e, top))
    out = jobs.graph_report(_interactions(spark).filter("source IS NOT NULL"), "retweet", 2, fixed_iterations=3)
    assert {r.id: r.username for r in out["top"].collect()} == {"x": "utarget", "y": "utarget"} and asked == [["x", "y"]]


def test_object_files_are_dealt_by_number_and_listed_in_tasks(spark, tmp_dir, monkeypatch):
    """objects were written where the rows lay (a small table is one task), and the driver held the name of every folder."""
    rows = [("rome", f"u{i}", "description", f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "location string, user_id string, name string, value string").coalesce(1)
    parts, cls = [], type(df)
    write = cls.write
    monkeypatch.setattr(cls, "write", property(lambda d: parts.append(d.rdd.getNumPartitions()) or write.fget(d)))
    ob.write_object_files(df, f"{tmp_dir}/networks")
    monkeypatch.undo()
    assert parts[0] >= spark.sparkContext.defaultParallelism
    sent, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda s, data, *a, **k: sent.append(len(data)) or create(s, data, *a, **k))
    os.makedirs(f"{tmp_dir}/networks/.hidden/classification/u/input")
    open(f"{tmp_dir}/networks/.hidden/classification/u/input/x.txt", "w").close()
    open(f"{tmp_dir}/networks/top.csv", "w").close()
    back = read_text_objects(spark, f"{tmp_dir}/networks")
    assert sorted(map(tuple, back.collect())) == sorted(rows) and max(sent) <= 1
    names = {r["relative"]: r["name"] for r in ob.listing(spark, f"{tmp_dir}/networks").collect()}
    assert len(names) == 301 and names["top.csv"] == "top.csv"
    assert names["rome/classification/u7/input/description.txt"] == "description.txt"


def test_vertex_attributes_looked_up_after_the_pick(spark):
    """Two lookups moved every edge with both endpoints' attributes."""
    users = spark.createDataFrame([("a", "A", 1), ("b", "B", None), ("a", "A", 1), (None, "N", 3)], "user_id string, username string, followers_count long")
    inter = spark.createDataFrame([("a", "b", 2, 1), ("b", "c", 1, 1), (None, "a", 1, 2), ("a", "a", 1, 3)], "source string, target string, ord long, pos int")
    for policy in ("first", "last"):
        assert sorted(map(tuple, gr.vertex_attributes(inter, policy, users).collect()), key=str) == \
            sorted([("a", "A", 1), ("b", "B", None), ("c", None, None), (None, None, None)], key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("first", "last"):
            plan = queries()[f"a14_vertex_attributes_{name}"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"Exchange hashpartitioning\((source|target)#", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_steps_by_one_key_move_rows_once(spark):
    """every dedupe of the posts by their id dealt the whole texts anew."""
    df = spark.createDataFrame([("1", "x", 0, 1), ("1", "y", 1, 0), (None, "z", 0, 0), ("2", "x", 0, 0)], "id string, text string, page int, pos int")
    landed = dd.merge_pages(df, "id").select(F.col("id").alias("tweet_id"), "text")
    out = dd.dedupe_whole(dd.dedupe_by_key(landed, ["text"], key_cols=("tweet_id",)))
    assert sorted(map(tuple, out.collect())) == [("1", "y"), ("2", "x")]
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    zero = spark.createDataFrame([(-0.0, 1), (0.0, 0)], "k double, o int")
    assert str(dd.keep_last(zero, ["k"], ["o"]).first()["k"]) == "-0.0"
