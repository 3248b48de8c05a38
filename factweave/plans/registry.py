"""Names of queries, the functions that run them, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame."""

    def put(f):
        _queries[name] = f
        if sql:
            _sql[name] = sql
        return f

    return put


def _load() -> None:
    from factweave.plans import dump_queries, extractor_queries, fact_queries, date_queries, graph_queries, join_queries, mapping_queries, more_extractor_queries, more_value_queries, page_queries, relational_queries, store_queries, stream_queries, value_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return _queries


def oracle_sql() -> dict[str, str]:
    _load()
    return _sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _queries["e2_e3_page_links"](spark, sf_dir)
