"""Name, Spark query and oracle SQL of every registered query."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from .tables import Tables, with_ctes

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
MODULES = ("projections", "joins", "aggregations", "windows", "ordering", "scalars",
           "sources", "sinks", "loads", "quality", "streams", "models")


def query(name: str, sql: str | None = None, feeds: str = ""):
    """Register ``fn(tables) -> DataFrame``; ``feeds`` names the trip feeds that ``sql`` reads."""
    def add(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            _ORACLES[name] = with_ctes(sql, *feeds.split())
        return fn
    return add


def load() -> None:
    for module in MODULES:
        import_module(f"{__package__}.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    load()
    return dict(_ORACLES)
