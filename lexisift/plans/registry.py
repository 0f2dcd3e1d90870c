"""All registered queries of the engine, by operator id, with the SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("relational", "aggregates", "text", "vectors", "search", "features", "storage", "reports")

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracle: dict[str, str] = {}


class Tables:
    """The tables of a folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Tables under an operator id."""

    def register(f):
        if name in _queries:
            raise ValueError(f"two queries are named {name}")
        _queries[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            _oracle[name] = sql
        return f

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"lexisift.plans.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracle)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    _load()
    return _queries["A13_topk_accuracy_curve"](spark, folder)
