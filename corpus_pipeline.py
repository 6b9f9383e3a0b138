"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
``run(spark, sf_dir)`` applies them to the ``documents`` table; the result of each stage is
written as Parquet into the session's shared checkpoint folder and read back as the next one's
input, so no stage is computed twice and a lost executor costs one stage's tasks only.

Every stage but the last returns the columns of ``documents``. Stages that take text away set
``n_chars`` to the length of what is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import common, decontaminate, line_dedup, packing, quality_rules, simhash_dups
from skein.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failing lines."""
    return quality_rules.apply_quality(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that occur in ten documents or more."""
    columns = docs.columns
    out = line_dedup.line_dedup(docs, line_dedup.MIN_DOCS)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents linked by their SimHash fingerprints."""
    return simhash_dups.apply_simhash(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the ``benchmark`` table."""
    return decontaminate.apply_decontamination(docs, common.table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece, ids included."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Tokenizer ids have no SQL; the tests run every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    base = scratch_dir(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
