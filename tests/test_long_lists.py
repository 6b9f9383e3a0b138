"""Lists of a key in chunks: bounded groups, whole lists, a hot key over many chunks."""

import random

from pyspark.sql import functions as F

from skein.operators import graph as gr
from skein.operators.long_lists import in_chunks, joined
from skein.streaming import queues as qu


def test_chunks_are_bounded_and_whole(spark):
    rnd = random.Random(2)
    rows = [("hot", i, f"h{i}") for i in range(5000)] + [(f"k{rnd.randrange(50)}", i, f"v{i}") for i in range(300)] + [(None, 1, "n")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long, v string").repartition(5)
    chunks = in_chunks(df, ["k"], ["o"], "v", 64)
    got = sorted(chunks.collect(), key=lambda r: (r["k"] or "", r["chunk"]))
    assert max(r["n"] for r in got) <= 64 and sum(r["n"] for r in got) == len(rows)
    want = {}
    for k, _, v in sorted(rows, key=lambda r: r[1]):
        want.setdefault(k, []).append(v)
    back = {}
    for r in got:
        back.setdefault(r["k"], []).extend(r["values"])
    assert back == want
    numbers = [r["chunk"] for r in got if r["k"] == "hot"]
    assert numbers == list(range(numbers[0], numbers[0] + len(numbers))) and len(numbers) > 70
    assert {r["k"]: (r["n"], r["text"]) for r in joined(chunks, ["k"], ";").collect()} == {
        k: (len(v), ";".join(v)) for k, v in want.items()}


def test_edge_ids_of_a_hot_pair_are_written_in_chunks(spark, tmp_dir):
    n = 200_000
    edges = spark.range(n).select(F.lit("a").alias("source"), F.lit("b").alias("target"), F.col("id").alias("ord"),
                                  F.lit(0).alias("pos"), F.col("id").cast("string").alias("tweet_id"))
    gr.retweet_id_chunks(edges, size=1000).write.parquet(f"{tmp_dir}/ids")
    rows = spark.read.parquet(f"{tmp_dir}/ids").orderBy("chunk")
    assert rows.count() == n / 1000 and rows.agg(F.max("n")).first()[0] == 1000
    assert [r["values"][0] for r in rows.limit(3).collect()] == ["0", "1000", "2000"]


def test_prompt_parts_make_the_prompt(spark):
    objects = spark.createDataFrame([("u", "description", "bio"), *[("u", f"tweet_{i}", f"t{i}") for i in range(7)],
                                     ("v", "description", "only"), ("w", "tweet_1", "post")], "user_id string, name string, value string")
    template = "About user_description: user_tweets (end of user_description)"
    whole = {r["user_id"]: r["prompt"] for r in qu.render_queue_prompts(objects, template).collect()}
    parts = {}
    for r in sorted(qu.prompt_parts(objects, template, 2).collect(), key=lambda r: r["part"]):
        parts[r["user_id"]] = parts.get(r["user_id"], "") + r["text"]
    assert parts == whole and whole["u"].startswith("About bio: t0\nt1")
