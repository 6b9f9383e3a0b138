"""Writers (K1-K7). Every writer takes any Hadoop URI (local, HDFS, s3a, ...); trees that exist already are
synchronised by ``objects.sync_directory`` (K10).

Rewrites never replace data in place: ``write_version`` writes a new numbered
version next to the old ones and readers pick the newest complete version
(a ``_SUCCESS`` marker), so a failed or retried job never leaves a half-written
table behind.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.dedupe import dedupe_whole
from skein.sources.readers import path_exists


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions (``v=<n>`` folders holding ``_SUCCESS``) under ``path``."""
    if not path_exists(spark, path):
        return []
    fs, hpath = _fs(spark, path)
    out = []
    for st in fs.listStatus(hpath):
        m = re.fullmatch(r"v=(\d+)", st.getPath().getName())
        if m and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def read_latest(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    vs = versions(spark, path)
    if not vs:
        return None
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/v={vs[-1]}")


def write_version(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write ``df`` as the next version of ``path``; returns the version folder."""
    spark = df.sparkSession
    vs = versions(spark, path)
    target = f"{path.rstrip('/')}/v={(vs[-1] + 1) if vs else 0}"
    df.write.mode("overwrite").format(fmt).save(target)
    return target


def read_distinct(spark: SparkSession, path: str) -> DataFrame | None:
    """All records of a K1 store (every complete version holds what was new in it)."""
    vs = versions(spark, path)
    if not vs:
        return None
    return spark.read.option("mergeSchema", True).parquet(*[f"{path.rstrip('/')}/v={v}" for v in vs])


def append_distinct(df: DataFrame, path: str) -> str:
    """K1: existing union new, identical records collapse. Only records that the store does not hold
    yet are written, as its next version, so an append costs its own size; a repeated append adds an
    empty version."""
    old = read_distinct(df.sparkSession, path)
    new = dedupe_whole(df)
    if old is not None:
        missing = [f for f in old.schema.fields if f.name not in new.columns]
        new = new.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
        old = old.select(*[F.col(f"`{f.name}`") if f.name in old.columns else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in new.schema.fields])
        new = new.subtract(old)  # null-safe, on the whole record
    return write_version(new, path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2: existing ++ new, no dedupe (creates the folder)."""
    df.write.mode("append").format(fmt).save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K3"""
    df.write.mode("overwrite").format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K4: header CSV; list columns become JSON text."""
    out = df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct")
                      else F.col(f"`{f.name}`") for f in df.schema.fields])
    out.write.mode("overwrite").option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_interactions(edges: DataFrame, path: str) -> None:
    """K5: edge records as JSON lines (non-ASCII kept); the ``{"edges": [...]}``
    envelope of the reference is an export wrapper and not needed by readers here."""
    edges.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_records_json(df: DataFrame, path: str) -> None:
    """K6"""
    df.write.mode("overwrite").json(path)


def write_text_objects(objects: DataFrame, path: str) -> None:
    """K7 as a table: one row per (location, user, name), in a folder per location (a file per user would
    mean millions of tiny objects); S8 reads it back. ``objects.write_object_files`` writes the files other programs read."""
    objects.select("location", "user_id", "name", "value").write.mode("overwrite").partitionBy("location").parquet(path)
