"""Column names that cannot clash with a caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def renamed(docs: DataFrame, *known: str) -> DataFrame:
    """``docs`` with the ``known`` columns under their names and all others as ``c0``, ``c1`` and so on, in order."""
    found = [docs.columns.index(k) for k in known]
    return docs.toDF(*[known[found.index(i)] if i in found else f"c{i}" for i in range(len(docs.columns))])


def only(docs: DataFrame, *known: str) -> DataFrame:
    return renamed(docs, *known).select(*known)


def schema_of(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
