"""Declarative data checks. Each gives one row: check, column, failing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, check: str, column: str) -> DataFrame:
    """Name the single count in ``df``."""
    return df.select(F.lit(check).alias("check"), F.lit(column).alias("column"),
                     F.col("failing").cast("long").alias("failing"))


def _count_if(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("failing"))


def row_checks(df: DataFrame, checks: dict[tuple[str, str], Column]) -> DataFrame:
    """Any number of row conditions in one pass; a row fails where the condition is not true."""
    names = list(checks)
    one = df.agg(*[F.count_if(~F.coalesce(cond, F.lit(False))).alias(f"f{i}")
                   for i, cond in enumerate(checks.values())])
    results = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"f{i}").alias("failing"))
        for i, (check, column) in enumerate(names)])
    return one.select(F.inline(results))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return row_checks(df, {("not_null", c): F.col(c).isNotNull() for c in columns})


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """NULL passes."""
    ok = F.col(column).isNull() | F.col(column).isin(list(values))
    return row_checks(df, {("accepted_values", column): ok})


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Number of repeated values (or combinations); NULL keys are not compared."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    groups = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    check = "unique" if len(columns) == 1 else "unique_combination"
    return _row(_count_if(groups, F.col("n") > 1), check, ",".join(columns))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null key has no parent. Repeated keys fold into counts before the join."""
    keys = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti")
    return _row(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing")), "relationships", column)


def run(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def profile(df: DataFrame, columns: Sequence[str], scale: int = 9) -> DataFrame:
    """One row per numeric column: rows, nulls, sign composition, mean, spread and total; one pass.

    Signs and extremes are those of the values themselves. The total, and the mean from it, add up
    decimals of ``scale`` digits, so they do not depend on the order of the rows.
    """
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c)
        aggs += [
            F.count(F.lit(1)).alias(f"rows{i}"), F.count_if(v.isNull()).alias(f"nulls{i}"),
            F.count_if(v > 0).alias(f"pos{i}"), F.count_if(v == 0).alias(f"zero{i}"),
            F.count_if(v < 0).alias(f"neg{i}"), F.sum(v.cast(f"decimal(28,{scale})")).cast("double").alias(f"sum{i}"),
            F.min(v).cast("double").alias(f"min{i}"), F.max(v).cast("double").alias(f"max{i}"),
            F.stddev(F.col(c).cast("double")).alias(f"sd{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(
        F.lit(c).alias("column"), F.col(f"rows{i}").alias("rows"), F.col(f"nulls{i}").alias("nulls"),
        F.col(f"pos{i}").alias("positive"), F.col(f"zero{i}").alias("zero"), F.col(f"neg{i}").alias("negative"),
        (F.col(f"sum{i}") / (F.col(f"rows{i}") - F.col(f"nulls{i}"))).alias("mean"),
        F.col(f"sd{i}").alias("stddev"), F.col(f"min{i}").alias("min"),
        F.col(f"max{i}").alias("max"), F.col(f"sum{i}").alias("total")) for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows)))


def compare_profiles(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Profiles of two versions of a model, side by side."""
    old, new = profile(before, columns), profile(after, columns)
    keep = ["rows", "mean", "min", "max", "total"]
    return (old.select("column", *[F.col(c).alias(f"{c}_before") for c in keep])
            .join(new.select("column", *[F.col(c).alias(f"{c}_after") for c in keep]), "column", "full"))
