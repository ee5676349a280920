"""Raw feeds to one typed trip table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import NTZ, NUMERIC, surrogate_key
from ..functions.names import common_columns
from ..operators.dedup import keep_first
from ..operators.joins import small_side

# --- fixed values: standard names and types, vendor and payment tables ---
IDS = {"VendorID": "vendor_id", "RatecodeID": "rate_code_id",
       "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id"}
TIMES = ("pickup_datetime", "dropoff_datetime")
AMOUNTS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
           "improvement_surcharge", "total_amount")
TRIP_COLUMNS = (
    "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id", "pickup_datetime",
    "dropoff_datetime", "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "service_type")
VENDORS = {1: "Creative Mobile Technologies", 2: "VeriFone Inc.", 4: "Unknown/Other"}
PAYMENTS = {0: "Unknown", 1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown", 6: "Voided trip"}
# --- end of fixed values ---

# One trip per value of these; the most selective first, as sorts compare them in this order.
TRIP_KEY = ("pickup_datetime", "pickup_location_id", "vendor_id", "service_type")


def lookup(spark: SparkSession, entries: Mapping[int, str], key: str, value: str) -> DataFrame:
    """Table from a mapping (seed data, table macro)."""
    rows = [F.struct(F.lit(k).cast("int").alias(key), F.lit(v).alias(value)) for k, v in entries.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def vendors(spark: SparkSession) -> DataFrame:
    return lookup(spark, VENDORS, "vendor_id", "vendor_name")


def payment_types(spark: SparkSession) -> DataFrame:
    return lookup(spark, PAYMENTS, "payment_type_code", "payment_type_description")


def standardise(raw: DataFrame, prefix: str, record_limit: int | None = None) -> DataFrame:
    """One feed (``lpep`` or ``tpep``) with standard names and types; rows without vendor drop out.

    ``record_limit`` is for development runs only.
    """
    typed: list[Column] = [F.col(old).cast("int").alias(new) for old, new in IDS.items()]
    typed += [F.col(f"{prefix}_{t}").cast(NTZ).alias(t) for t in TIMES]
    typed.append(F.col("store_and_fwd_flag"))
    have = set(raw.columns)
    for name in ("passenger_count", "trip_type", "payment_type"):
        if name in have:
            typed.append(F.col(name).cast("int").alias(name))
    typed += [F.col(a).cast(NUMERIC).alias(a) for a in ("trip_distance", *AMOUNTS) if a in have]
    out = raw.filter(F.col("VendorID").isNotNull()).select(*typed)
    return out.limit(record_limit) if record_limit is not None else out


def union_services(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Staged feeds in one table; the street-hail type and a zero fee fill what yellow lacks."""
    g = green.withColumn("service_type", F.lit("Green"))
    y = yellow.withColumns({
        "trip_type": F.lit(1), "ehail_fee": F.lit(0).cast(NUMERIC), "service_type": F.lit("Yellow")})
    return g.select(*TRIP_COLUMNS).unionByName(y.select(*TRIP_COLUMNS))


def plain_union(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Raw feeds cut to the columns both have, after giving their times the same names."""
    rename = lambda p: {f"{p}_{t}": t for t in TIMES}
    g, y = green.withColumnsRenamed(rename("lpep")), yellow.withColumnsRenamed(rename("tpep"))
    shared = common_columns(g, y)
    tag = lambda df, name: df.select(*shared).withColumn("service_type", F.lit(name))
    return tag(g, "green").unionAll(tag(y, "yellow"))


def enrich(trips: DataFrame, payments: DataFrame) -> DataFrame:
    """Trip id, payment description, one row per trip key (the earliest dropoff).

    Duplicates go first: the payment lookup is unique by code, so the order of the two steps
    does not change the result, and fewer rows reach the join.
    """
    one = keep_first(trips, TRIP_KEY, ["dropoff_datetime"])
    code = F.coalesce("payment_type", F.lit(0))
    out = one.withColumn("payment_type", code).join(
        small_side(payments), F.col("payment_type") == F.col("payment_type_code"), "left")
    return out.select(
        surrogate_key("vendor_id", time_text("pickup_datetime"), "pickup_location_id", "service_type").alias("trip_id"),
        *TRIP_COLUMNS, F.coalesce("payment_type_description", F.lit("Unknown")).alias("payment_type_description"))


def time_text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
