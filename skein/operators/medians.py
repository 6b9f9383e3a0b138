"""Exact medians of several columns at once, without a task or a buffer that holds a column's values.

Values are counted per (column, value), so repeated values are combined before the shuffle. The counts are
range-partitioned by (column, value) and sorted inside the partitions. Each partition's total per column
(a row per partition and column) gives the rank at which its values of a column start. The one or two
values whose ranks are in the middle are then picked by a filter, in whatever partition they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import ensure_checkpoint_dir


def exact_medians(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row: the median of each expression over its non-null values (null if there is none), as doubles.

    The only window over all partitions' totals has a row per partition and column; the
    window over values runs inside one (partition, column), which the range partitioning bounds.
    """
    names = list(columns)
    if not names:
        raise ValueError("no columns")
    ensure_checkpoint_dir(df.sparkSession)
    one = [F.struct(F.lit(i).alias("k"), columns[n].cast("double").alias("v")) for i, n in enumerate(names)]
    counts = (df.select(F.explode(F.array(*one)).alias("x")).select("x.k", "x.v").filter("v IS NOT NULL")
              .groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
              .repartitionByRange("k", "v").withColumn("p", F.spark_partition_id()))
    counts = counts.checkpoint()  # partition numbers are fixed before they are used twice
    parts = counts.groupBy("k", "p").agg(F.sum("n").alias("n"))
    starts = parts.select("k", "p", (F.sum("n").over(Window.partitionBy("k").orderBy("p")) - F.col("n")).alias("start"),
                          F.sum("n").over(Window.partitionBy("k")).alias("total"))
    # the partitions of a column that hold a middle rank: two at most
    middle = lambda c: (F.col("start") < c) & (c <= F.col("start") + F.col("size"))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    near = (starts.join(parts.withColumnRenamed("n", "size"), ["k", "p"]).filter(middle(low) | middle(high))
            .select("k", "p", "start", "total"))
    rank = F.sum("n").over(Window.partitionBy("k", "p").orderBy("v"))
    ranked = counts.join(F.broadcast(near), ["k", "p"]).select(  # two rows a column
        "k", "v", "total", (F.col("start") + rank).alias("last"), (F.col("start") + rank - F.col("n")).alias("before"))
    holds = lambda c: (F.col("before") < c) & (c <= F.col("last"))
    picked = ranked.select("k", F.when(holds(low), F.col("v")).alias("lo"), F.when(holds(high), F.col("v")).alias("hi"))
    return picked.agg(*[((F.max(F.when(F.col("k") == i, F.col("lo"))) + F.max(F.when(F.col("k") == i, F.col("hi")))) / 2).alias(n)
                        for i, n in enumerate(names)])
