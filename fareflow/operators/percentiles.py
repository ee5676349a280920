"""Exact interpolated percentiles without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from . import ordered


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """One row per group with a column per entry of ``shares`` (name -> 0..1).

    Equal values fold into counts before the shuffle, and the distinct values are sorted over
    all tasks. The counts per slice tell which slices hold a target position; only their rows
    are read again.
    """
    counts = ordered.value_counts(
        df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v")), keys, "_v")
    rows, spans = ordered.sorted_spans(counts, keys, ["_v"], "_n")
    places = [F.lit(float(p)) * (F.col("_size") - 1) for p in shares.values()]
    ends = [end for at in places for end in (F.floor(at), F.ceil(at))]

    def covers(first, weight, position):  # does a run of rows cover the 0-based position?
        return (first <= position) & (position < first + weight)

    needed = spans.filter(reduce(lambda a, b: a | b, [covers(F.col("_before"), F.col("_here"), e) for e in ends]))
    local = Window.partitionBy("_slice", "_group").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(needed, ["_slice", "_group"]).withColumn(
        "_start", F.sum("_n").over(local) - F.col("_n") + F.col("_before"))
    rows = rows.select(*keys, "_size", *[
        F.when(covers(F.col("_start"), F.col("_n"), e), F.col("_v")).alias(f"_e{i}") for i, e in enumerate(ends)])
    found = rows.groupBy(*keys).agg(F.max("_size").alias("_size"), *[F.max(f"_e{i}").alias(f"_e{i}") for i in range(len(ends))])
    out = []
    for i, (name, at) in enumerate(zip(shares, places)):
        low, high = F.col(f"_e{2 * i}"), F.col(f"_e{2 * i + 1}")
        out.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return found.select(*keys, *out)


def percentile_over(df: DataFrame, keys: Sequence[str], value: str, share: float, name: str) -> DataFrame:
    """Every input row with its group's percentile (the windowed form).

    The group table is written first: a join with a plain table is one that adaptive execution
    can turn into a broadcast or split at a hot group.
    """
    per_group = percentiles(df, keys, value, {name: share})
    per_group = materialise(per_group.select(ordered._group(keys).alias("_group"), name), "percentiles")
    return df.withColumn("_group", ordered._group(keys)).join(per_group, "_group", "left").drop("_group")


def approximate(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], accuracy: int = 10000) -> DataFrame:
    """Opt-in sketch for interactive use."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, p, accuracy).alias(n) for n, p in shares.items()])
