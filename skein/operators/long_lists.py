"""Lists of a key in chunks of bounded length (post ids of an edge, posts of a prompt).

All rows are range-sorted by (key, order) and numbered, and a chunk is what a key has of one block of ``size``
numbers. So a key with any number of rows is spread over partitions, no group exceeds ``size`` rows, and the chunks
of a key follow each other by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import stored

#: Rows of a chunk at most.
CHUNK = 4096


def numbered(df: DataFrame, order: list[str], col: str = "__no", drop: tuple[str, ...] = ()) -> DataFrame:
    """Rows numbered from 0 in a total order: sorted by ranges, numbered inside each partition, shifted by the
    sizes of those before it (one row per partition). No task sees all rows. Columns in ``drop`` are there for the order only
    and are not stored."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in drop]
    sorted_ = stored(df.orderBy(*order).select(*kept, F.spark_partition_id().alias("__pid"),
                                               F.monotonically_increasing_id().alias("__mid")), "numbered")
    counts = sorted_.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return sorted_.join(F.broadcast(offsets), "__pid").withColumn(col, F.col("__off") + local).drop("__pid", "__mid", "__off")


def in_order(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The rows of ``df`` numbered by key, ``order`` and value, stored: keys, order as ``__o0``.., value as ``__v``, ``__no``."""
    return numbered(df.select(*keys, *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], F.col(value).alias("__v")),
                    [*keys, *[f"__o{i}" for i in range(len(order))], "__v"])


def in_chunks(df: DataFrame, keys: list[str], order: list[str], value: str, size: int = CHUNK) -> DataFrame:
    """(keys, chunk, n, first, whole, values): the values of each key in ``order``, at most ``size`` in a row, and the ``order``
    columns of the chunk's first row. Chunks of a key are to be read by ``chunk``; its numbers follow each other without a
    gap. A chunk that is ``whole`` is the only one of its key."""
    return chunks_of(in_order(df, keys, order, value), keys, order, size)


def chunks_of(rows: DataFrame, keys: list[str], order: list[str], size: int = CHUNK) -> DataFrame:
    """``in_chunks`` of rows that ``in_order`` has numbered. A key with rows in two blocks has the last number of one and the first of
    the next, so a chunk with neither end of its block has all rows of its key."""
    place = F.struct(*[F.col(f"__o{i}").alias(o) for i, o in enumerate(order)])
    items = F.array_sort(F.collect_list(F.struct("__no", "__v")))  # length and ends come from the list: sums beside it would move with it
    whole = (items[0]["__no"] % size != 0) & (F.element_at(items, -1)["__no"] % size != size - 1)
    return rows.groupBy(*keys, F.floor(F.col("__no") / size).alias("chunk")).agg(
        F.size(items).cast("bigint").alias("n"), F.min(place).alias("first"), whole.alias("whole"),
        F.transform(items, lambda s: s["__v"]).alias("values"))


def joined(chunks: DataFrame, keys: list[str], sep: str) -> DataFrame:
    """(keys, n, first, text): the chunks of each key put together, one text per key, for a target whose format has the whole list
    in one cell. That cell is the only thing here that grows with a key; ``in_chunks`` is the form without it.

    A whole chunk has its key's text already, so only the others (two a block at most, but for keys with more rows than a block)
    move once more."""
    named = [F.col(f"`{k}`") for k in keys]
    part = F.struct("chunk", F.array_join("values", sep).alias("t"))
    several = chunks.filter(~F.col("whole")).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.array_sort(F.collect_list(part)).alias("__parts")).select(
        *named, "n", "first", F.array_join(F.transform("__parts", lambda p: p["t"]), sep).alias("text"))
    return chunks.filter("whole").select(*named, "n", "first", F.array_join("values", sep).alias("text")).unionByName(several)


def text_parts(chunks: DataFrame, keys: list[str], sep: str, before: Column, after: Column) -> DataFrame:
    """(keys, part, text): a long text per key in rows to be written one after the other: ``before``, the chunks' values
    with ``sep`` between them, ``after``. ``part`` numbers them; nothing holds the whole text."""
    first = chunks.groupBy(*keys).agg(F.min("chunk").alias("__first"), F.max("chunk").alias("__last"))
    j = chunks.join(first, keys)
    lead = F.when(F.col("chunk") == F.col("__first"), before).otherwise(F.lit(sep))
    tail = F.when(F.col("chunk") == F.col("__last"), after).otherwise(F.lit(""))
    return j.select(*keys, (F.col("chunk") - F.col("__first")).alias("part"),
                    F.concat(lead, F.array_join("values", sep), tail).alias("text"))
