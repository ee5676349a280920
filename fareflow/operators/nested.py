"""Nested documents to flat parent and child tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import row_hash_safe
from ..functions.names import snake_case


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    out = []
    for f in schema:
        here = (*path, f.name)
        out += _leaves(f.dataType, here) if isinstance(f.dataType, T.StructType) else [(here, f.dataType)]
    return out


def _field(path: tuple[str, ...]) -> Column:
    c = F.col(f"`{path[0]}`")
    for name in path[1:]:
        c = c.getField(name)
    return c


def _flat(path: tuple[str, ...]) -> str:
    return "__".join(snake_case(p) for p in path)


def flatten(df: DataFrame) -> DataFrame:
    """Struct fields become ``parent__child`` columns; arrays stay as they are."""
    return df.select(*[_field(p).alias(_flat(p)) for p, _ in _leaves(df.schema)])


def normalise(df: DataFrame, name: str, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Parent table plus one child table per array, at any depth.

    ``keys`` identify a document; its ``row_id`` is a hash of them. A child carries its
    parent's id and its place in the list.
    """
    tables: dict[str, DataFrame] = {}
    _split(df.withColumn("row_id", row_hash_safe(*keys)), name, tables)
    return tables


def _split(df: DataFrame, name: str, tables: dict[str, DataFrame]) -> None:
    flat = flatten(df)
    arrays = [f.name for f in flat.schema if isinstance(f.dataType, T.ArrayType)]
    tables[name] = flat.drop(*arrays)
    for a in arrays:
        items = flat.select(F.col("row_id").alias("parent_id"), F.posexplode(a).alias("list_idx", "value"))
        item_type = flat.schema[a].dataType.elementType
        body = ["value.*"] if isinstance(item_type, T.StructType) else ["value"]
        child = items.select(
            "parent_id", "list_idx", *body,
            row_hash_safe("parent_id", F.lit(a), "list_idx").alias("row_id"))
        _split(child, f"{name}__{a}", tables)


def with_defaults(df: DataFrame, columns: Sequence[str], default: str = "N/A") -> DataFrame:
    """Listed columns only, as text where absent or NULL; a missing column is all default."""
    have = set(df.columns)
    return df.select(*[
        (F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in have else F.lit(default)).alias(c)
        for c in columns])


def typed_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")) for c in columns})
