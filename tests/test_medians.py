"""Exact distributed medians against the plain ones."""

import random
import statistics

from pyspark.sql import functions as F

from skein.operators import network as nw
from skein.operators.medians import exact_medians


def test_exact_medians(spark):
    rnd = random.Random(1)
    for n in (0, 1, 2, 7, 500, 501):
        rows = [(rnd.randrange(9), rnd.random() * 100 - 50, None if rnd.random() < 0.3 else rnd.randrange(1000), None) for _ in range(n)]
        df = spark.createDataFrame(rows, "a int, b double, c long, d double").repartition(3)
        got = exact_medians(df, {"a": F.col("a"), "b": F.col("b"), "c": F.col("c"), "d": F.col("d"), "hot": F.lit(3)}).first()
        for k, name in enumerate("abc"):
            values = [r[k] for r in rows if r[k] is not None]
            assert got[name] == (statistics.median(values) if values else None)
        assert got["d"] is None and got["hot"] == (3.0 if n else None)


def test_no_median_aggregate_is_left(spark):
    posts = spark.createDataFrame([("r1", "RT @x"), ("r1", "own"), ("r2", "own")], "root_id STRING, tweet_text STRING")
    shares = nw.query_shares(posts)
    assert "median(" not in shares._jdf.queryExecution().toString().replace("median_", "")
    assert tuple(shares.first()) == (0.25, 0.75)
