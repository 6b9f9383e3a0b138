"""Query registry: one Spark callable and (where SQL can say it) one DuckDB oracle per operator.

Each Spark callable takes (spark, sf_dir), reads the driver tables through the
fixture views and returns a DataFrame built with the library's operators. The
oracle is independent SQL over the same fixture views (``skein.fixtures``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skein import fixtures


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None  # SQL over fixture views; None -> rows-only / unit-tested


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, oracle)
        return fn
    return deco


def load_sql(name: str) -> str | None:
    """The oracle of a query registered before."""
    return REGISTRY[name].oracle


def load_all() -> dict[str, Query]:
    # Importing the query modules fills REGISTRY.
    from skein.plans import (  # noqa: F401
        q_analysis, q_clean, q_network, q_graph, q_upsert, q_export, q_classify,
        q_text, q_queue, q_jobs, q_records, q_files,
    )
    return REGISTRY


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: q.run for n, q in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {n: fixtures.with_prefix(q.oracle) for n, q in load_all().items() if q.oracle}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    from skein.session import ship_code
    ship_code(spark)
    fixtures.register_views(spark, sf_dir)
    return [spark.table(n) for n in names]
