"""Stream-stream joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rekey(df: DataFrame, key: str, source: str) -> DataFrame:
    return df.withColumn(key, F.col(source).cast("string"))


def dropoffs_near_pickups(
    rides: DataFrame, pickups: DataFrame, window_minutes: int = 20, grace: str = "5 minutes", minutes: int = 10,
    salts: int = 1, hot: Sequence[str] | None = None,
) -> DataFrame:
    """Rides that end where and when another trip starts.

    ``rides``: key, vendor_id, dropoff_datetime. ``pickups``: key, location_id, pickup_datetime.
    Times at most ``window_minutes`` apart pair up; pairs more than ``minutes`` whole minutes
    apart are filtered out again. Both streams forget rows a window plus ``grace`` old.

    State is kept by key and time bucket, so a hot key's rows spread over its time range;
    ``salts`` splits each such group of the ``hot`` keys (of all, if none are named) further, at the price of as
    many copies of their pickups. The named keys must stay the same while the query keeps its checkpoint.
    """
    salted = lambda key: F.lit(True) if hot is None else F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    width = window_minutes * 60_000_000
    r = rides.select(F.col("key").alias("ride_key"), "vendor_id",
                     F.col("dropoff_datetime").cast("timestamp").alias("dropoff_datetime")
                     ).withWatermark("dropoff_datetime", grace)
    p = pickups.select(F.col("key").alias("pickup_key"), "location_id",
                       F.col("pickup_datetime").cast("timestamp").alias("pickup_datetime")
                       ).withWatermark("pickup_datetime", grace)
    at = F.floor(F.unix_micros("pickup_datetime") / width)
    r = r.withColumns({
        "ride_bucket": F.floor(F.unix_micros("dropoff_datetime") / width),
        "ride_salt": F.when(salted("ride_key"), F.pmod(F.xxhash64("vendor_id", "dropoff_datetime"), F.lit(salts)).cast("int")).otherwise(0)})
    p = (p.withColumn("pickup_bucket", F.explode(F.array(at - 1, at, at + 1)))
         .withColumn("pickup_salt", F.explode(F.when(salted("pickup_key"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))))
    span = F.expr(f"INTERVAL {window_minutes} MINUTES")
    pairs = r.join(p, (F.col("ride_key") == F.col("pickup_key"))
                   & (F.col("ride_bucket") == F.col("pickup_bucket")) & (F.col("ride_salt") == F.col("pickup_salt"))
                   & (F.col("pickup_datetime") >= F.col("dropoff_datetime") - span)
                   & (F.col("pickup_datetime") <= F.col("dropoff_datetime") + span), "inner")
    apart = F.abs(F.unix_micros("pickup_datetime") - F.unix_micros("dropoff_datetime"))
    return (pairs.filter(F.floor(apart / 60_000_000) <= minutes)
            .select("vendor_id", "location_id", F.col("pickup_datetime").alias("pickup_time"),
                    F.col("dropoff_datetime").alias("last_dropoff_time")))
