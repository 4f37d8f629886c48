"""Registry of queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Callable[[Warehouse], DataFrame]] = {}


def query(name: str):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        _REGISTRY[name] = fn
        return fn
    return deco


def _bind(fn: Callable[[Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Warehouse(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    from . import registered  # noqa: F401  (fills the registry)
    return {k: _bind(v) for k, v in _REGISTRY.items()}
