"""Registered queries of the shelf-tag engine and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle:
            _ORACLES[name] = oracle
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Query]:
    from tagloom.plans import detections, records, runs, steps  # noqa: F401  they register their queries

    return _QUERIES


def oracle_sql() -> dict[str, str]:
    queries()
    return _ORACLES
