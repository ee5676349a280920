"""P: projections and predicates."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import names
from ..operators.nested import with_defaults
from ..plans import staging
from .registry import query

N = "count(*) AS n"


@query("p01_standardise", "SELECT * FROM stg_green", "stg_green")
def standardise(t):
    return staging.standardise(t.green, "lpep")


@query("p02_rename", """SELECT VendorID, tpep_pickup_datetime AS pickup_datetime,
       tpep_dropoff_datetime AS dropoff_datetime, PULocationID FROM trips""", "trips")
def rename(t):
    return (t.trips.withColumnsRenamed({"tpep_pickup_datetime": "pickup_datetime",
                                        "tpep_dropoff_datetime": "dropoff_datetime"})
            .select("VendorID", "pickup_datetime", "dropoff_datetime", "PULocationID"))


SHARED = ("VendorID, store_and_fwd_flag, RatecodeID, PULocationID, DOLocationID, passenger_count, trip_distance,"
          " fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, payment_type,"
          " congestion_surcharge")


@query("p03_common_columns", f"SELECT {SHARED} FROM green", "green")
def common_columns(t):
    return t.green.select(*names.common_columns(t.green, t.yellow))


@query("p04_literal_column", """SELECT service_type, count(*) AS n FROM (SELECT 'green' AS service_type FROM green
       UNION ALL SELECT 'yellow' AS service_type FROM yellow) GROUP BY 1""", "green yellow")
def literal_column(t):
    tag = lambda df, name: df.select(F.lit(name).alias("service_type"))
    return tag(t.green, "green").unionAll(tag(t.yellow, "yellow")).groupBy("service_type").agg(F.count("*").alias("n"))


@query("p05_drop_columns", "SELECT * EXCLUDE (Borough, service_zone) FROM zones", "zones")
def drop_columns(t):
    return t.zones.drop("Borough", "service_zone")


@query("p06_equality_filter", """SELECT tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID
       FROM trips WHERE RatecodeID = 3""", "trips")
def equality_filter(t):
    return t.trips.filter(F.col("RatecodeID") == 3).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID")


@query("p07_not_null", "SELECT VendorID, count(*) AS n FROM trips WHERE VendorID IS NOT NULL GROUP BY 1", "trips")
def not_null(t):
    return t.trips.filter(F.col("VendorID").isNotNull()).groupBy("VendorID").agg(F.count("*").alias("n"))


@query("p08_null_either", """SELECT pickup_datetime, PUlocationID, DOlocationID FROM fhv
       WHERE PUlocationID IS NULL OR DOlocationID IS NULL""", "fhv")
def null_either(t):
    return (t.fhv.filter(F.col("PUlocationID").isNull() | F.col("DOlocationID").isNull())
            .select("pickup_datetime", "PUlocationID", "DOlocationID"))


@query("p08_null_both_count", """SELECT count(*) AS n FROM fhv
       WHERE PUlocationID IS NULL AND DOlocationID IS NULL""", "fhv")
def null_both(t):
    return (t.fhv.filter(F.col("PUlocationID").isNull() & F.col("DOlocationID").isNull())
            .agg(F.count("*").alias("n")))


@query("p09_in_list", """SELECT count(*) AS n FROM fhv
       WHERE dispatching_base_num IN ('B00017', 'B00042', 'B00099')""", "fhv")
def in_list(t):
    return t.fhv.filter(F.col("dispatching_base_num").isin("B00017", "B00042", "B00099")).agg(F.count("*").alias("n"))


@query("p10_date_between", """SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date, count(*) AS n FROM trips
       WHERE CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-06-30' GROUP BY 1""", "trips")
def date_between(t):
    day = F.to_date("tpep_pickup_datetime")
    return (t.trips.filter(day.between("1996-06-01", "1996-06-30"))
            .groupBy(day.alias("pickup_date")).agg(F.count("*").alias("n")))


@query("p11_half_open_range", """SELECT count(*) AS n FROM trips WHERE tpep_pickup_datetime >= TIMESTAMP '1996-10-01'
       AND tpep_pickup_datetime < TIMESTAMP '1996-11-01'""", "trips")
def half_open(t):
    ts = F.col("tpep_pickup_datetime")
    return t.trips.filter((ts >= F.expr("TIMESTAMP_NTZ '1996-10-01'")) & (ts < F.expr("TIMESTAMP_NTZ '1996-11-01'"))
                          ).agg(F.count("*").alias("n"))


@query("p12_from_timestamp", """SELECT PULocationID, count(*) AS n FROM trips
       WHERE tpep_pickup_datetime >= TIMESTAMP '1997-01-01' GROUP BY 1""", "trips")
def from_timestamp(t):
    return (t.trips.filter(F.col("tpep_pickup_datetime") >= F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'"))
            .groupBy("PULocationID").agg(F.count("*").alias("n")))


@query("p13_zero_and_nonzero", """SELECT count(*) FILTER (fare_amount <> 0) AS nonzero,
       count(*) FILTER (fare_amount = 0) AS zero FROM trips""", "trips")
def zero_nonzero(t):
    return t.trips.agg(F.count_if(F.col("fare_amount") != 0).alias("nonzero"),
                       F.count_if(F.col("fare_amount") == 0).alias("zero"))


@query("p14_same_day", """SELECT count(*) AS n FROM trips WHERE CAST(tpep_pickup_datetime AS DATE) = DATE '1996-09-18'
       AND CAST(tpep_dropoff_datetime AS DATE) = DATE '1996-09-18'""", "trips")
def same_day(t):
    day = F.lit("1996-09-18").cast("date")
    return t.trips.filter((F.to_date("tpep_pickup_datetime") == day) & (F.to_date("tpep_dropoff_datetime") == day)
                          ).agg(F.count("*").alias("n"))


@query("p15_drop_any_null", """SELECT * FROM fhv WHERE dispatching_base_num IS NOT NULL AND pickup_datetime IS NOT NULL
       AND dropOff_datetime IS NOT NULL AND PUlocationID IS NOT NULL AND DOlocationID IS NOT NULL
       AND affiliated_base_number IS NOT NULL""", "fhv")
def drop_any_null(t):
    return t.fhv.na.drop()


@query("p16_keys_with_default", """SELECT p_brand AS brand, coalesce(CAST(nullif(p_size, 1) AS VARCHAR), 'N/A') AS size,
       'N/A' AS warranty FROM part""")
def keys_with_default(t):
    return with_defaults(t.part.select(F.col("p_brand").alias("brand"), F.expr("nullif(p_size, 1)").alias("size")),
                         ["brand", "size", "warranty"])


@query("p17_snake_names", """SELECT VendorID AS vendor_id, RatecodeID AS ratecode_id, PULocationID AS pu_location_id,
       DOLocationID AS do_location_id, payment_type FROM trips""", "trips")
def snake_names(t):
    return names.snake_columns(t.trips.select("VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type"))


@query("p18_remove_zero_trips", """SELECT passenger_count, count(*) AS n FROM trips
       WHERE passenger_count > 0 AND trip_distance > 0 GROUP BY 1""", "trips")
def remove_zero(t):
    return (t.trips.filter((F.col("passenger_count") > 0) & (F.col("trip_distance") > 0))
            .groupBy("passenger_count").agg(F.count("*").alias("n")))


@query("p19_retyped_table", """SELECT passenger_count, CAST(PULocationID AS VARCHAR) AS PULocationID,
       CAST(DOLocationID AS VARCHAR) AS DOLocationID, CAST(payment_type AS VARCHAR) AS payment_type, fare_amount
       FROM trips""", "trips")
def retyped(t):
    ids = [F.col(c).cast("string").alias(c) for c in ("PULocationID", "DOLocationID", "payment_type")]
    return t.trips.select("passenger_count", *ids, "fare_amount")


@query("p20_distance_segments", """SELECT CASE WHEN trip_distance <= 1 THEN 'up to 1' WHEN trip_distance <= 3 THEN '1 to 3'
       WHEN trip_distance <= 7 THEN '3 to 7' WHEN trip_distance <= 10 THEN '7 to 10' ELSE 'over 10' END AS segment,
       count(*) AS n FROM trips GROUP BY 1""", "trips")
def distance_segments(t):
    segment = C.bucket("trip_distance", [1, 3, 7, 10], ["up to 1", "1 to 3", "3 to 7", "7 to 10", "over 10"])
    return t.trips.groupBy(segment.alias("segment")).agg(F.count("*").alias("n"))


@query("p21_calendar_columns", """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(quarter(pickup_datetime) AS INTEGER) AS quarter,
       concat(CAST(year(pickup_datetime) AS VARCHAR), '/Q', CAST(quarter(pickup_datetime) AS VARCHAR)) AS year_quarter,
       CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS n FROM fhv GROUP BY ALL""", "fhv")
def calendar(t):
    ts = "pickup_datetime"
    return t.fhv.groupBy(F.year(ts).alias("year"), F.quarter(ts).alias("quarter"), C.quarter_label(ts).alias("year_quarter"),
                         F.month(ts).alias("month")).agg(F.count("*").alias("n"))


@query("p22_last_n_days", """SELECT CAST(tpep_pickup_datetime AS DATE) AS day, count(*) AS n FROM trips
       WHERE tpep_pickup_datetime >= DATE '1998-01-01' - INTERVAL 30 DAY GROUP BY 1""", "trips")
def last_n_days(t):
    return (t.trips.filter(C.in_last_days("tpep_pickup_datetime", C.days_back(30), datetime.date(1998, 1, 1)))
            .groupBy(F.to_date("tpep_pickup_datetime").alias("day")).agg(F.count("*").alias("n")))


@query("p23_distinct", "SELECT DISTINCT VendorID, payment_type FROM trips", "trips")
def distinct(t):
    return t.trips.select("VendorID", "payment_type").distinct()


@query("p24_masked_column", "SELECT sha256(c_name) AS c_name, c_nationkey FROM customer")
def masked_column(t):
    return t.customer.select(C.masked("c_name").alias("c_name"), "c_nationkey")


@query("p25_outlier_cap", "SELECT max(trip_distance) AS longest, count(*) AS n FROM trips WHERE trip_distance < 40", "trips")
def outlier_cap(t):
    return t.trips.filter(F.col("trip_distance") < 40).agg(F.max("trip_distance").alias("longest"), F.count("*").alias("n"))


@query("p26_valid_fares", """SELECT service_type, count(*) AS n FROM enriched WHERE fare_amount > 0 AND trip_distance > 0
       AND payment_type_description IN ('Cash', 'Credit card') GROUP BY 1""", "enriched")
def valid_fares(t):
    from ..plans.marts import valid_fares as valid
    return valid(t.enriched).groupBy("service_type").agg(F.count("*").alias("n"))


@query("p28_cte_chain", """WITH paid AS (SELECT * FROM trips WHERE fare_amount > 0),
       daily AS (SELECT CAST(tpep_pickup_datetime AS DATE) AS day, count(*) AS n FROM paid GROUP BY 1)
       SELECT n, count(*) AS days FROM daily GROUP BY n""", "trips")
def cte_chain(t):
    t.trips.createOrReplaceTempView("fareflow_trips")
    return t.spark.sql("""
        WITH paid AS (SELECT * FROM fareflow_trips WHERE fare_amount > 0),
             daily AS (SELECT to_date(tpep_pickup_datetime) AS day, count(*) AS n FROM paid GROUP BY 1)
        SELECT n, count(*) AS days FROM daily GROUP BY n""")
