"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import sort_column


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order``; all other columns break ties.

    The filter sits directly on the window, so each task already drops all but one row per
    key before the shuffle; a key that holds a third of the rows costs no more than others.
    """
    used = {o.lstrip("-") for o in order if isinstance(o, str)} | set(keys)
    rest = [c for c in df.columns if c not in used]
    w = Window.partitionBy(*keys).orderBy(*[sort_column(o) for o in [*order, *rest]])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, rank: str = "row_number") -> DataFrame:
    """First ``k`` rows (or ranks) per group, pruned before the shuffle like ``keep_first``."""
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[rank]
    w = Window.partitionBy(*keys).orderBy(*[sort_column(o) for o in order])
    return df.withColumn(rank, fn().over(w)).filter(F.col(rank) <= k)


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Sort and limit: every task keeps k rows, one task merges them."""
    return df.orderBy(*[sort_column(o) for o in order]).limit(k)


def top_k_numbered(df: DataFrame, order: Sequence[str], k: int, name: str = "ranking") -> DataFrame:
    """The k first rows with their global row number; the window sees k rows only."""
    w = Window.orderBy(*[sort_column(o) for o in order])
    return top_k(df, order, k).withColumn(name, F.row_number().over(w))


def nth_value_rows(df: DataFrame, by: str, n: int) -> DataFrame:
    """Rows whose ``rank() over (order by <by>)`` is exactly ``n``; none if a tie skips it.

    Only the first n rows are ranked; their values are then matched against the table.
    """
    value = by.lstrip("-")
    w = Window.orderBy(sort_column(by))
    leaders = top_k(df.select(value), [by], n).withColumn("_rank", F.rank().over(w))
    target = leaders.filter(F.col("_rank") == n).agg(F.max(value))
    return df.filter(F.col(value) == target.scalar()).withColumn("rank", F.lit(n))
