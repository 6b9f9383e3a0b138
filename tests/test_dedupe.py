"""Keep-first / keep-last rules, whole-record dedupe and page merges."""

from skein.operators.dedupe import dedupe_by_key, dedupe_whole, merge_pages, unique_by


def test_dedupe_by_key_keeps_first_and_drops_keyless(spark):
    df = spark.createDataFrame([
        ("u1-2025-01-01", None, "u1", 3), ("u1-2025-01-01", None, "u1", 1), (None, "t9", "u2", 2),
        (None, "t9", "u3", 5), (None, None, "u4", 4), (None, None, None, 0)],
        "user_date_id STRING, tweet_id STRING, user_id STRING, ord INT")
    out = {(r.user_date_id, r.tweet_id, r.user_id): r.ord for r in dedupe_by_key(df, ["ord"]).collect()}
    assert out == {("u1-2025-01-01", None, "u1"): 1, (None, "t9", "u2"): 2, (None, None, "u4"): 4}


def test_dedupe_whole_collapses_identical_records_with_maps(spark):
    df = spark.createDataFrame([("a", {"k": 1}), ("a", {"k": 1}), ("a", {"k": 2})], "id STRING, m MAP<STRING,BIGINT>")
    assert dedupe_whole(df).count() == 2


def test_merge_pages_last_page_first_in_page(spark):
    df = spark.createDataFrame([("u", 0, 0, "p0"), ("u", 1, 5, "p1b"), ("u", 1, 2, "p1a"), ("v", 0, 1, "v0")],
                               "id STRING, page INT, pos INT, payload STRING")
    out = {r.id: r.payload for r in merge_pages(df, "id").collect()}
    assert out == {"u": "p1a", "v": "v0"}


def test_unique_by_hot_key_is_exact(spark):
    # one key holds most rows: the aggregate pre-combines per partition, result stays exact
    rows = [("hot", i) for i in range(5000)] + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "user_id STRING, ord INT").repartition(8)
    out = {r.user_id: r.ord for r in unique_by(df, "user_id", ["ord"]).collect()}
    assert out["hot"] == 0 and len(out) == 51
