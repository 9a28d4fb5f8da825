"""Named queries over the tables of one directory, each with its DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from corpusmill.sources.shared import spread

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP = "dedup_keep_min"

#: Modules of this package that register queries when imported.
MODULES = ("text_queries", "duplicate_queries", "span_queries", "thread_queries", "entity_queries")

#: Tables of texts, over which queries do heavy work.
TEXTS = ("documents", "pages", "conversations")

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers the decorated function as query ``name``."""

    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if oracle:
            _ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXTS else df


def _load() -> None:
    for module in MODULES:
        import_module(f"corpusmill.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
