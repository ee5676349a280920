"""Distinct counts and quantiles from sketches that are stored by period and united later.

A period's rows are read once; any longer span is then answered from the sketches of its periods, whose
size does not grow with the rows. Both kinds fold within each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** DISTINCT_BITS counters; three standard errors of the estimate, as a share of it.
DISTINCT_BITS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)
#: Size parameter of a quantile sketch, and the error of a rank that 99 of 100 sketches of this size keep to.
QUANTILE_SIZE = 400
RANK_ERROR = 0.0102


def distinct_by(df: DataFrame, keys: Sequence[str], period: Column, value: str) -> DataFrame:
    """keys, ``period`` and a sketch of the distinct ``value``; NULLs do not count."""
    return df.groupBy(*keys, period.alias("period")).agg(F.hll_sketch_agg(value, F.lit(DISTINCT_BITS)).alias("sketch"))


def united_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, ``periods`` and ``estimate`` over all periods of the sketches."""
    return sketches.groupBy(*keys).agg(F.count(F.lit(1)).alias("periods"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def quantiles_by(df: DataFrame, keys: Sequence[str], period: Column, value: str) -> DataFrame:
    """keys, ``period`` and a quantile sketch of ``value``; NULLs are left out, and so are periods without a value."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys, period.alias("period"))
            .agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_SIZE)).alias("sketch")))


def united_quantiles(sketches: DataFrame, keys: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """keys, ``n`` (values) and a column for each share over all periods of the sketches."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(QUANTILE_SIZE)).alias("_all"))
    return merged.select(*keys, F.kll_sketch_get_n_double("_all").alias("n"),
                         *[F.kll_sketch_get_quantile_double("_all", F.lit(p)).alias(name) for name, p in shares.items()])


def rank_errors(df: DataFrame, found: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys and, for each share, how far the found value's true rank is from it (0 within a run of equal values)."""
    from .joins import small_side

    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    joined = rows.join(small_side(found), list(keys))
    aggs = []
    for name, p in shares.items():
        below, upto = F.avg((F.col("_v") < F.col(name)).cast("int")), F.avg((F.col("_v") <= F.col(name)).cast("int"))
        aggs.append(F.greatest(below - p, F.lit(p) - upto, F.lit(0.0)).alias(name))
    return joined.groupBy(*keys).agg(*aggs)
