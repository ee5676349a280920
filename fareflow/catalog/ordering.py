"""L and U: sort, limit, top-k, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import joins
from ..operators.dedup import top_k
from ..plans import staging
from ..sources import readers
from ..sources.writers import by_size
from .registry import query

DAILY = "SELECT CAST(tpep_dropoff_datetime AS DATE) AS day, DOLocationID, count(*) AS count FROM trips GROUP BY 1, 2"


@query("l01_sorted", f"{DAILY} ORDER BY 1, 2 DESC", "trips")
def sorted_rows(t):
    return (t.trips.groupBy(F.to_date("tpep_dropoff_datetime").alias("day"), "DOLocationID").count()
            .orderBy("day", F.desc("DOLocationID")))


@query("l02_limit", "SELECT count(*) AS n FROM (SELECT * FROM lineitem LIMIT 100)")
def limited(t):
    return readers.table_scan(t.lineitem, ["l_orderkey"], 100).agg(F.count(F.lit(1)).alias("n"))


@query("l03_top_5", """SELECT dispatching_base_num, count(*) AS count FROM fhv GROUP BY 1
       ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5""", "fhv")
def top_5(t):
    return top_k(t.fhv.groupBy("dispatching_base_num").count(), ["-count", "dispatching_base_num"], 5)


@query("l03_top_10_days", """SELECT CAST(pickup_datetime AS DATE) AS pickup_date,
       max(date_diff('second', pickup_datetime, dropOff_datetime)) / 60.0::DOUBLE AS duration FROM fhv GROUP BY 1
       ORDER BY 2 DESC, 1 LIMIT 10""", "fhv")
def top_10_days(t):
    days = t.fhv.groupBy(F.to_date("pickup_datetime").alias("pickup_date")).agg(
        F.max(C.duration_minutes("pickup_datetime", "dropOff_datetime")).cast("double").alias("duration"))
    return top_k(days, ["-duration", "pickup_date"], 10)


@query("l04_development_cap", "SELECT least(count(*), 10000) AS n FROM stg_green", "stg_green")
def development_cap(t):
    return staging.standardise(t.green, "lpep", record_limit=10000).agg(F.count(F.lit(1)).alias("n"))


@query("l05_take", "SELECT * FROM zones ORDER BY LocationID LIMIT 10", "zones")
def take(t):
    return top_k(t.zones, ["LocationID"], 10)


@query("l06_bottom_1", """SELECT Zone, count(*) AS n FROM trips JOIN zones ON PULocationID = LocationID GROUP BY 1
       ORDER BY 2, 1 LIMIT 1""", "trips zones")
def bottom_1(t):
    counts = t.trips.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))
    named = joins.with_zone(counts, t.zones, "PULocationID", "pickup", "inner", ["Zone"])
    return top_k(named.select(F.col("pickup_zone").alias("Zone"), "n"), ["n", "Zone"], 1)


@query("l07_busiest_recent", """SELECT Zone, count(*) AS n FROM trips JOIN zones ON PULocationID = LocationID
       WHERE tpep_pickup_datetime >= (SELECT max(tpep_pickup_datetime) - INTERVAL 17 HOUR FROM trips)
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""", "trips zones")
def busiest_recent(t):
    counts = joins.within_latest(t.trips, "tpep_pickup_datetime", "17 hours").groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))
    named = joins.with_zone(counts, t.zones, "PULocationID", "pickup", "inner", ["Zone"])
    return top_k(named.select(F.col("pickup_zone").alias("Zone"), "n"), ["-n", "Zone"], 3)


@query("u01_union_all", """SELECT service_type, PULocationID, count(*) AS n FROM (
       SELECT 'green' AS service_type, PULocationID FROM green UNION ALL SELECT 'yellow', PULocationID FROM yellow)
       GROUP BY 1, 2""", "green yellow")
def union_all(t):
    return staging.plain_union(t.green, t.yellow).groupBy("service_type", "PULocationID").agg(F.count(F.lit(1)).alias("n"))


@query("u02_union_filled", "SELECT * FROM unioned", "unioned")
def union_filled(t):
    return t.unioned


@query("u03_literal_rows", """WITH v AS (SELECT 1 AS vendor_id, 'Creative Mobile Technologies' AS vendor_name
       UNION ALL SELECT 2, 'VeriFone Inc.' UNION ALL SELECT 4, 'Unknown/Other')
       SELECT vendor_name, count(VendorID) AS trips FROM v LEFT JOIN trips ON vendor_id = VendorID GROUP BY 1""", "trips")
def literal_rows(t):
    counts = t.trips.groupBy("VendorID").agg(F.count(F.lit(1)).alias("trips"))
    return staging.vendors(t.spark).join(counts, F.col("vendor_id") == F.col("VendorID"), "left").select(
        "vendor_name", F.coalesce("trips", F.lit(0)).alias("trips"))


@query("u04_concatenated_months", """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2""")
def concatenated_months(t):
    """One file set per month, read back as one table by a list of paths."""
    path = t.scratch("months")
    parts = t.orders.withColumns({"y": F.date_format("o_orderdate", "yyyy"), "m": F.date_format("o_orderdate", "MM")})
    by_size(parts, "y", "m").write.partitionBy("y", "m").parquet(path)
    months = t.spark.read.parquet(f"{path}/*/*")
    return months.groupBy(F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month")
                          ).agg(F.count(F.lit(1)).alias("n"), C.exact_sum("o_totalprice").alias("total"))
