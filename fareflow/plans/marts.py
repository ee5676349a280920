"""Star-schema fact and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import minute_diff, second_diff, trunc_ts
from ..operators import percentiles
from ..operators.dedup import top_per_group
from ..operators.joins import with_zone
from .staging import AMOUNTS

UNKNOWN_ZONE = "Unknown Zone"


def fact_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    out = with_zone(trips, zones, "pickup_location_id", "pickup")
    out = with_zone(out, zones, "dropoff_location_id", "dropoff")
    return out.withColumn("trip_duration_minutes", minute_diff("pickup_datetime", "dropoff_datetime"))


def _average(c: str) -> Column:
    """Decimal sum over count, so that neither rounding nor row order matters."""
    return F.sum(F.col(c).cast("decimal(18,3)")).cast("double") / F.count(c)


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue by zone, month and service; the zone label is filled before grouping."""
    sums = [F.sum(a).cast("double").alias("revenue_monthly_" + a.removesuffix("_amount") if a == "fare_amount"
            else "revenue_monthly_" + a) for a in AMOUNTS]
    return fact.groupBy(
        F.coalesce("pickup_zone", F.lit(UNKNOWN_ZONE)).alias("pickup_zone"),
        trunc_ts("month", "pickup_datetime").alias("revenue_month"), "service_type",
    ).agg(*sums, F.count("trip_id").alias("total_monthly_trips"),
          _average("passenger_count").alias("avg_monthly_passenger_count"),
          _average("trip_distance").alias("avg_monthly_trip_distance"))


def known_locations(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose both ends are known zones."""
    out = with_zone(trips, zones, "pickup_location_id", "pickup", "inner")
    return with_zone(out, zones, "dropoff_location_id", "dropoff", "inner")


def hourly_zone_revenue(trips: DataFrame, start: str, pickup: str, zone: str, amount: str) -> DataFrame:
    """Revenue and count by hour and zone from ``start`` on; partial sums before the shuffle."""
    return (trips.filter(F.col(pickup) >= F.lit(start).cast("timestamp_ntz"))
            .groupBy(trunc_ts("hour", pickup).alias("hour"), F.col(zone).alias("zone"))
            .agg(F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("amount"),
                 F.count(F.lit(1)).alias("number_records")))


def quarterly_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("service_type", F.year("pickup_datetime").cast("long").alias("year"),
                        F.quarter("pickup_datetime").cast("long").alias("quarter")).agg(
        F.sum("total_amount").cast("double").alias("revenue"))


def yearly_growth(quarters: DataFrame) -> DataFrame:
    """Percent change against the same quarter of the year before; NULL without one."""
    past = quarters.select("service_type", (F.col("year") + 1).alias("year"), "quarter",
                           F.col("revenue").alias("past_revenue"))
    out = quarters.join(past, ["service_type", "year", "quarter"], "left")
    return out.select("service_type", "year", "quarter", "revenue",
                      ((F.col("revenue") - F.col("past_revenue")) / F.col("past_revenue") * 100.0).alias("growth_pct"))


def valid_fares(fact: DataFrame) -> DataFrame:
    return fact.filter((F.col("fare_amount") > 0) & (F.col("trip_distance") > 0)
                       & F.col("payment_type_description").isin("Cash", "Credit card"))


def monthly_fare_percentiles(fact: DataFrame) -> DataFrame:
    rows = valid_fares(fact).select(
        "service_type", F.year("pickup_datetime").cast("long").alias("year"),
        F.month("pickup_datetime").cast("long").alias("month"), "fare_amount")
    return percentiles.percentiles(rows, ["service_type", "year", "month"], "fare_amount",
                                   {"p97": 0.97, "p95": 0.95, "p90": 0.90})


def travel_time_percentiles(trips: DataFrame, keys: list[str], share: float = 0.9) -> DataFrame:
    rows = trips.withColumn("trip_duration", second_diff("pickup_datetime", "dropoff_datetime"))
    return percentiles.percentiles(rows, keys, "trip_duration", {"p90": share})


def nth_longest_dropoff(p90: DataFrame, partition: list[str], n: int = 2) -> DataFrame:
    """Per pickup zone, the dropoff zones with the n-th longest p90 (ties share a rank)."""
    return top_per_group(p90, partition, ["-p90"], n, "dense_rank").filter(F.col("dense_rank") == n)
