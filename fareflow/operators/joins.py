"""Joins of trips with zones and with each other.

No side is hinted for broadcast unless its size is checked first: ``small_side`` asks the
optimizer for a size bound. Beyond the bound the join shuffles and adaptive execution
splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size bound of a plan (file sizes, scaled by projected columns)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its estimated size is under ``limit``."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def hot_keys(df: DataFrame, key: str, share: float = 0.05) -> list:
    """Keys that hold at least ``share`` of the rows; so at most ``1 / share`` of them reach the driver."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    least = df.agg((F.count(F.lit(1)) * share).alias("least")).scalar()
    return [r[0] for r in counts.filter(F.col(key).isNotNull() & (F.col("n") >= least)).collect()]


def with_zone(trips: DataFrame, zones: DataFrame, key: str, prefix: str, how: str = "left",
              attributes: Sequence[str] = ("Borough", "Zone")) -> DataFrame:
    """Attach zone attributes for one role (pickup or dropoff).

    A right or full join must keep unmatched zones, and then neither a broadcast nor a split of
    a hot zone is possible. So the trips are joined as in an inner or left join, and the zones
    that no trip has are added.
    """
    dim = zones.select(F.col("LocationID").alias("_loc"),
                       *[F.col(a).alias(f"{prefix}_{a.lower()}") for a in attributes])
    kept = {"right": "inner", "full": "left"}.get(how, how)
    out = trips.join(small_side(dim), F.col(key) == F.col("_loc"), kept).drop("_loc")
    if how in ("right", "full"):
        used = trips.select(F.col(key).alias("_loc")).distinct()
        out = out.unionByName(dim.join(used, "_loc", "left_anti").drop("_loc"), allowMissingColumns=True)
    return out


def unknown_locations(trips: DataFrame, zones: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows where any non-null key is missing from the zones (NOT IN joined by OR).

    Two equi-joins with flags instead of a nested loop over an OR of subqueries.
    """
    out = trips
    known = zones.select("LocationID").distinct()
    for i, key in enumerate(keys):
        side = known.select(F.col("LocationID").alias(f"_k{i}"))
        out = out.join(small_side(side), F.col(key) == F.col(f"_k{i}"), "left")
    missing = None
    for i, key in enumerate(keys):
        test = F.col(key).isNotNull() & F.col(f"_k{i}").isNull()
        missing = test if missing is None else missing | test
    return out.filter(missing).select(*trips.columns)


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """SQL ``NOT IN``: empty when the right side holds a NULL, drops rows with a NULL key
    unless the right side is empty. ``left_anti`` keeps those rows.
    """
    stats = right.agg(F.count(F.lit(1)).alias("rows"), F.count(right_key).alias("values"))
    any_null = stats.select(F.col("rows") > F.col("values")).scalar()
    is_empty = stats.select(F.col("rows") == 0).scalar()
    candidates = right.select(F.col(right_key).alias("_r")).filter("_r is not null").distinct()
    out = left.join(candidates, F.col(key) == F.col("_r"), "left_anti")
    return out.filter(is_empty | (~any_null & F.col(key).isNotNull()))


def at_latest(df: DataFrame, ts: str) -> DataFrame:
    """Rows at the latest time of the table (dynamic filter)."""
    return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())


def within_latest(df: DataFrame, ts: str, interval: str) -> DataFrame:
    """Rows in the trailing interval that ends at the latest time, both ends included."""
    start = df.agg((F.max(ts) - F.expr(f"INTERVAL {interval}")).alias("start"))
    return df.filter(F.col(ts) >= start.scalar())


def near_in_time(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
    window_seconds: int, residual: Column | None = None,
) -> DataFrame:
    """Pairs with the same key and times at most ``window_seconds`` apart.

    Times are cut into buckets of the window's length, and the right row goes to its own
    bucket and both neighbours. The equi-join then runs on (key, bucket), so one hot key
    spreads over its time range, and no pair of one bucket is further apart than two windows.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    width = window_seconds * 1_000_000
    right_key = f"_{key}_r"
    l = left.withColumn("_bucket", F.floor(micros(left_ts) / width))
    own = F.floor(micros(right_ts) / width)
    r = right.withColumnRenamed(key, right_key).withColumn(
        "_bucket", F.explode(F.array(own - 1, own, own + 1)))
    on = (F.col(key) == F.col(right_key)) & (l["_bucket"] == r["_bucket"])
    close = F.abs(micros(left_ts) - micros(right_ts)) <= width
    out = l.join(r, on & close, "inner").drop("_bucket", right_key)
    return out.filter(residual) if residual is not None else out
