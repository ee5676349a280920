"""A: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import joins, loads, percentiles, quality, sketches
from ..operators.dedup import top_k
from ..plans import marts, staging
from ..plans.staging import AMOUNTS
from ..session import materialise
from .registry import query

SQL_DAY = "CAST(tpep_dropoff_datetime AS DATE) AS day"


def day():
    return F.to_date("tpep_dropoff_datetime").alias("day")


def money(expr: str, name: str | None = None) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)" + (f" AS {name}" if name else "")


def mean(expr: str, name: str) -> str:
    """Exact to nine decimals; only what is money is rounded to money."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(28,9))) AS DOUBLE) / count({expr}) AS {name}"


@query("a01_group_count", "SELECT service_type, count(*) AS count FROM unioned GROUP BY 1", "unioned")
def group_count(t):
    return t.unioned.groupBy("service_type").count()


REVENUE = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
           "total_amount", "congestion_surcharge")
NAMES = {a: "revenue_monthly_" + ("fare" if a == "fare_amount" else a.removesuffix("_amount") if a == "total_amount" else a)
         for a in REVENUE}


@query("a02_monthly_revenue", f"""WITH both_feeds AS (
       SELECT PULocationID, lpep_pickup_datetime AS pickup_datetime, 'green' AS service_type, passenger_count,
       trip_distance, {', '.join(REVENUE)} FROM green UNION ALL
       SELECT PULocationID, tpep_pickup_datetime, 'yellow', passenger_count, trip_distance, {', '.join(REVENUE)} FROM yellow)
       SELECT PULocationID AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month, service_type,
       {', '.join(money(a, n) for a, n in NAMES.items())}, {mean('passenger_count', 'avg_monthly_passenger_count')},
       {mean('trip_distance', 'avg_monthly_trip_distance')} FROM both_feeds GROUP BY 1, 2, 3""", "green yellow")
def monthly_revenue(t):
    return staging.plain_union(t.green, t.yellow).groupBy(
        F.col("PULocationID").alias("revenue_zone"), C.trunc_ts("month", "pickup_datetime").alias("revenue_month"),
        "service_type").agg(*[C.exact_sum(a).alias(n) for a, n in NAMES.items()],
                            C.exact_avg("passenger_count", C.EXACT).alias("avg_monthly_passenger_count"),
                            C.exact_avg("trip_distance", C.EXACT).alias("avg_monthly_trip_distance"))


MART = ", ".join(f"CAST(sum({a}) AS DOUBLE) AS revenue_monthly_{'fare' if a == 'fare_amount' else a}" for a in AMOUNTS)


@query("a03_monthly_zone_revenue", f"""SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
       date_trunc('month', pickup_datetime) AS revenue_month, service_type, {MART},
       count(trip_id) AS total_monthly_trips,
       CAST(sum(passenger_count) AS DOUBLE) / count(passenger_count) AS avg_monthly_passenger_count,
       CAST(sum(trip_distance) AS DOUBLE) / count(trip_distance) AS avg_monthly_trip_distance
       FROM fact GROUP BY coalesce(pickup_zone, 'Unknown Zone'), 2, 3""", "fact")
def monthly_zone_revenue(t):
    return marts.monthly_zone_revenue(t.fact)


HOURLY = f"""SELECT date_trunc('hour', lpep_pickup_datetime) AS hour, PULocationID AS zone,
    {money('total_amount', 'amount')}, count(*) AS number_records FROM green
    WHERE lpep_pickup_datetime >= TIMESTAMP '1996-01-01' GROUP BY 1, 2"""


@query("a04_hourly_revenue", HOURLY, "green")
def hourly_revenue(t):
    return marts.hourly_zone_revenue(t.green, "1996-01-01", "lpep_pickup_datetime", "PULocationID", "total_amount")


@query("a05_hourly_revenue_reduced", HOURLY, "green")
def hourly_reduced(t):
    """The filter / map / reduce-by-key form: the pair (amount, 1) is summed per key."""
    kept = t.green.filter(F.col("lpep_pickup_datetime") >= F.expr("TIMESTAMP_NTZ '1996-01-01'"))
    pairs = kept.select(C.trunc_ts("hour", "lpep_pickup_datetime").alias("hour"), F.col("PULocationID").alias("zone"),
                        F.col("total_amount").cast(C.MONEY).alias("amount"), F.lit(1).cast("long").alias("one"))
    return pairs.groupBy("hour", "zone").agg(F.sum("amount").cast("double").alias("amount"),
                                             F.sum("one").alias("number_records"))


@query("a06_daily_count", f"SELECT {SQL_DAY}, count(*) AS count FROM trips GROUP BY 1", "trips")
def daily_count(t):
    return t.trips.groupBy(day()).count()


@query("a07_daily_maxima", f"""SELECT {SQL_DAY}, count(*) AS count, max(total_amount) AS total_amount,
       max(passenger_count) AS passenger_count FROM trips GROUP BY 1""", "trips")
def daily_maxima(t):
    return t.trips.groupBy(day()).agg(F.count(F.lit(1)).alias("count"), F.max("total_amount").alias("total_amount"),
                                    F.max("passenger_count").alias("passenger_count"))


@query("a08_day_and_zone", f"""SELECT {SQL_DAY}, DOLocationID, count(*) AS count, max(total_amount) AS total_amount,
       max(passenger_count) AS passenger_count FROM trips GROUP BY 1, 2 ORDER BY 1, 2""", "trips")
def day_and_zone(t):
    return t.trips.groupBy(day(), "DOLocationID").agg(
        F.count(F.lit(1)).alias("count"), F.max("total_amount").alias("total_amount"),
        F.max("passenger_count").alias("passenger_count")).orderBy("day", "DOLocationID")


@query("a09_count_star", "SELECT count(*) AS all_rows, count(1) AS ones, count(VendorID) AS with_vendor FROM trips", "trips")
def count_star(t):
    return t.trips.agg(F.count("*").alias("all_rows"), F.count(F.lit(1)).alias("ones"), F.count("VendorID").alias("with_vendor"))


@query("a10_count_distinct", "SELECT count(DISTINCT affiliated_base_number) AS n FROM fhv", "fhv")
def count_distinct(t):
    return t.fhv.select("affiliated_base_number").distinct().agg(F.count("affiliated_base_number").alias("n"))


@query("a10_approx_count_distinct")
def approx_distinct(t):
    return t.fhv.agg(F.approx_count_distinct("affiliated_base_number", 0.02).alias("n"))


@query("a10_stored_sketches", """SELECT dispatching_base_num, count(DISTINCT date_trunc('month', pickup_datetime)) AS periods, true AS within_bound
       FROM fhv GROUP BY 1""", "fhv")
def stored_distinct(t):
    """Sketches by month, stored and united: each base's estimate is as near to the exact count as the bound says."""
    made = sketches.distinct_by(t.fhv, ["dispatching_base_num"], F.date_format("pickup_datetime", "yyyy-MM"), "affiliated_base_number")
    stored = loads.replace(loads.Target(t.scratch("sketches"), made.schema, "period"), made).read(t.spark)
    united = sketches.united_distinct(stored, ["dispatching_base_num"])
    exact = (t.fhv.select("dispatching_base_num", "affiliated_base_number").distinct().groupBy("dispatching_base_num")
             .agg(F.count("affiliated_base_number").alias("n")))
    off = F.abs(F.col("estimate") - F.col("n")) <= F.greatest(F.col("n") * sketches.DISTINCT_ERROR, F.lit(1))
    united = united.withColumnRenamed("dispatching_base_num", "_base")
    return united.join(exact, F.col("_base").eqNullSafe(F.col("dispatching_base_num"))).select(
        "dispatching_base_num", "periods", off.alias("within_bound"))


@query("a11_longest_trip_day", """SELECT CAST(tpep_pickup_datetime AS DATE) AS day, max(trip_distance) AS trip_distance
       FROM trips GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""", "trips")
def longest_trip_day(t):
    days = t.trips.groupBy(F.to_date("tpep_pickup_datetime").alias("day")).agg(F.max("trip_distance").alias("trip_distance"))
    return top_k(days, ["-trip_distance", "day"], 1)


@query("a12_longest_duration", """SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
       max(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)) AS seconds,
       max(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)) / 60.0::DOUBLE AS minutes
       FROM trips GROUP BY 1""", "trips")
def longest_duration(t):
    span = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return t.trips.groupBy(F.to_date(span[0]).alias("pickup_date")).agg(
        F.max(C.second_diff(*span)).alias("seconds"), F.max(C.duration_minutes(*span)).cast("double").alias("minutes"))


@query("a13_rounded_sum_top", """SELECT Zone, round(CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE), 3) AS revenue
       FROM trips JOIN zones ON PULocationID = LocationID GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""", "trips zones")
def rounded_sum_top(t):
    out = joins.with_zone(t.trips, t.zones, "PULocationID", "pickup", "inner")
    out = out.groupBy(F.col("pickup_zone").alias("Zone")).agg(F.round(C.exact_sum("total_amount"), 3).alias("revenue"))
    return top_k(out, ["-revenue", "Zone"], 3)


@query("a14_having", f"""SELECT PULocationID, CAST(tpep_pickup_datetime AS DATE) AS day, {money('total_amount', 'revenue')}
       FROM trips GROUP BY 1, 2 HAVING sum(CAST(total_amount AS DECIMAL(18,2))) > 130000""", "trips")
def having(t):
    out = t.trips.groupBy("PULocationID", F.to_date("tpep_pickup_datetime").alias("day")).agg(
        C.exact_sum("total_amount").alias("revenue"))
    return out.filter(F.col("revenue") > 130000)


SECS = "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)"
PAIR_TIMES = f"""SELECT p.Zone AS pickup_zone, d.Zone AS dropoff_zone, CAST(sum({SECS}) AS DOUBLE) / count(*) AS avg_seconds,
    min({SECS}) AS min_seconds, max({SECS}) AS max_seconds, count(*) AS trips FROM trips
    JOIN zones p ON PULocationID = p.LocationID JOIN zones d ON DOLocationID = d.LocationID GROUP BY 1, 2"""


def pair_times(t):
    """Trip times by ordered zone pair. Keys are grouped first and named after, so the joins see few rows."""
    secs = C.second_diff("tpep_pickup_datetime", "tpep_dropoff_datetime")
    out = t.trips.select("PULocationID", "DOLocationID", secs.alias("s")).groupBy("PULocationID", "DOLocationID").agg(
        (F.sum("s").cast("double") / F.count("s")).alias("avg_seconds"), F.min("s").alias("min_seconds"),
        F.max("s").alias("max_seconds"), F.count(F.lit(1)).alias("trips"))
    out = joins.with_zone(out, t.zones, "PULocationID", "pickup", "inner", ["Zone"])
    out = joins.with_zone(out, t.zones, "DOLocationID", "dropoff", "inner", ["Zone"])
    return out.drop("PULocationID", "DOLocationID")


@query("a15_pair_trip_times", PAIR_TIMES, "trips zones")
def pair_trip_times(t):
    return pair_times(t)


@query("a15_longest_average_pair", f"SELECT * FROM ({PAIR_TIMES}) ORDER BY avg_seconds DESC, pickup_zone, dropoff_zone LIMIT 1",
       "trips zones")
def longest_average_pair(t):
    return top_k(pair_times(t), ["-avg_seconds", "pickup_zone", "dropoff_zone"], 1)


@query("a16_anomalies", f"SELECT * FROM ({PAIR_TIMES}) WHERE max_seconds > avg_seconds * 2", "trips zones")
def anomalies(t):
    return pair_times(t).filter(F.col("max_seconds") > F.col("avg_seconds") * 2)


@query("a17_average_minutes", """SELECT CAST(sum(date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)) AS DOUBLE)
       / count(*) AS avg_minutes FROM trips""", "trips")
def average_minutes(t):
    m = C.minute_diff("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return t.trips.agg((F.sum(m).cast("double") / F.count(m)).alias("avg_minutes"))


@query("a18_group_average", """SELECT p_brand AS brand, round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE)
       / count(p_retailprice), 2) AS avg_price FROM part GROUP BY 1 ORDER BY 2 DESC, 1""")
def group_average(t):
    return (t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.round(C.exact_avg("p_retailprice"), 2).alias("avg_price"))
            .orderBy(F.desc("avg_price"), "brand"))


@query("a19_most_and_least_frequent", """(SELECT 'most' AS which, Zone, count(*) AS n FROM trips JOIN zones ON
       PULocationID = LocationID GROUP BY Zone ORDER BY n DESC, Zone LIMIT 1) UNION ALL
       (SELECT 'least', Zone, count(*) AS n FROM trips JOIN zones ON PULocationID = LocationID GROUP BY Zone
       ORDER BY n, Zone LIMIT 1)""", "trips zones")
def most_and_least(t):
    counts = t.trips.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))
    named = joins.with_zone(counts, t.zones, "PULocationID", "pickup", "inner", ["Zone"])
    pick = lambda which, order: top_k(named.select(F.lit(which).alias("which"), F.col("pickup_zone").alias("Zone"), "n"),
                                      [order, "Zone"], 1)
    return pick("most", "-n").unionAll(pick("least", "n"))


@query("a20_dearest_pair", f"""SELECT concat(p.Zone, '/', d.Zone) AS pair, {mean('total_amount', 'avg_amount')} FROM trips
       JOIN zones p ON PULocationID = p.LocationID JOIN zones d ON DOLocationID = d.LocationID
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""", "trips zones")
def dearest_pair(t):
    out = t.trips.groupBy("PULocationID", "DOLocationID").agg(C.exact_avg("total_amount").alias("avg_amount"))
    out = joins.with_zone(out, t.zones, "PULocationID", "pickup", "inner", ["Zone"])
    out = joins.with_zone(out, t.zones, "DOLocationID", "dropoff", "inner", ["Zone"])
    return top_k(out.select(C.label("/", "pickup_zone", "dropoff_zone").alias("pair"), "avg_amount"), ["-avg_amount", "pair"], 1)


@query("a21_daily_max_tip", """SELECT CAST(tpep_pickup_datetime AS DATE) AS day, max(tip_amount) AS tip,
       max(DOLocationID) FILTER (tip_amount = best) AS dropoff FROM (SELECT *, max(tip_amount) OVER
       (PARTITION BY CAST(tpep_pickup_datetime AS DATE)) AS best FROM trips) GROUP BY 1""", "trips")
def daily_max_tip(t):
    """Largest tip per day and where it was dropped off; the higher zone id wins a tie."""
    return t.trips.groupBy(F.to_date("tpep_pickup_datetime").alias("day")).agg(
        F.max("tip_amount").alias("tip"), F.max_by("DOLocationID", F.struct("tip_amount", "DOLocationID")).alias("dropoff"))


P = {"p90": 0.9, "p95": 0.95, "p97": 0.97}


@query("a22_percentiles", """SELECT PULocationID, round(quantile_cont(total_amount, 0.9), 6) AS p90,
       round(quantile_cont(total_amount, 0.95), 6) AS p95, round(quantile_cont(total_amount, 0.97), 6) AS p97
       FROM trips GROUP BY 1""", "trips")
def exact_percentiles(t):
    out = percentiles.percentiles(t.trips, ["PULocationID"], "total_amount", P)
    return out.select("PULocationID", *[F.round(p, 6).alias(p) for p in P])


@query("a22_approx_percentiles")
def approx_percentiles(t):
    return percentiles.approximate(t.trips, ["PULocationID"], "total_amount", P)


@query("a22_stored_sketches", """SELECT PULocationID, count(total_amount) AS n, true AS p90_within, true AS p95_within, true AS p97_within
       FROM trips GROUP BY 1""", "trips")
def stored_percentiles(t):
    """Sketches by year, stored and merged: the true ranks of the values they give are within the bound."""
    made = sketches.quantiles_by(t.trips, ["PULocationID"], F.year("tpep_pickup_datetime"), "total_amount")
    stored = loads.replace(loads.Target(t.scratch("sketches"), made.schema, "period"), made).read(t.spark)
    found = materialise(sketches.united_quantiles(stored, ["PULocationID"], P), "quantiles")
    errors = sketches.rank_errors(t.trips, found.drop("n"), ["PULocationID"], "total_amount", P)
    return found.select("PULocationID", "n").join(errors, "PULocationID").select(
        "PULocationID", "n", *[(F.col(p) <= sketches.RANK_ERROR).alias(f"{p}_within") for p in P])


@query("a23_share", """SELECT service_type, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct
       FROM unioned GROUP BY 1""", "unioned")
def share(t):
    counts = t.unioned.groupBy("service_type").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / total)


@query("a24_signs", """SELECT count(*) FILTER (total_amount > 0) AS positive, count(*) FILTER (total_amount = 0) AS zero,
       count(*) FILTER (total_amount < 0) AS negative FROM trips""", "trips")
def signs(t):
    a = F.col("total_amount")
    return t.trips.agg(F.count_if(a > 0).alias("positive"), F.count_if(a == 0).alias("zero"), F.count_if(a < 0).alias("negative"))


def profile_sql(column: str, feed: str) -> str:
    v = f"CAST({column} AS DECIMAL(28,9))"
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) FILTER ({column} IS NULL) AS nulls,
        count(*) FILTER ({column} > 0) AS positive, count(*) FILTER ({column} = 0) AS zero, count(*) FILTER ({column} < 0) AS negative,
        CAST(sum({v}) AS DOUBLE) / count({v}) AS mean, round(stddev({column}), 6) AS stddev,
        CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, CAST(sum({v}) AS DOUBLE) AS total FROM {feed}"""


@query("a25_profile", f"{profile_sql('trip_distance', 'trips')} UNION ALL {profile_sql('payment_type', 'trips')}", "trips")
def column_profile(t):
    return quality.profile(t.trips, ["trip_distance", "payment_type"]).withColumn("stddev", F.round("stddev", 6))


@query("a26_months_by_service", """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) FILTER (service_type = 'Green') AS Green,
       count(*) FILTER (service_type = 'Yellow') AS Yellow FROM unioned GROUP BY 1, 2""", "unioned")
def months_by_service(t):
    return (t.unioned.groupBy(F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month"))
            .pivot("service_type", ["Green", "Yellow"]).agg(F.count(F.lit(1))).na.fill(0))


@query("a27_sum_of_column", "SELECT sum(l_linenumber)::BIGINT AS total, count(*) AS n FROM lineitem")
def sum_of_column(t):
    return t.lineitem.agg(F.sum("l_linenumber").alias("total"), F.count(F.lit(1)).alias("n"))


@query("a28_first_cursor", "SELECT min(ts) AS first_ts FROM events")
def first_cursor(t):
    return t.events.agg(F.min("ts").alias("first_ts"))


@query("a29_quarterly_revenue", """SELECT service_type, year(pickup_datetime) AS year, quarter(pickup_datetime) AS quarter,
       CAST(sum(total_amount) AS DOUBLE) AS revenue FROM unioned GROUP BY 1, 2, 3""", "unioned")
def quarterly_revenue(t):
    return marts.quarterly_revenue(t.unioned)


@query("a30_passengers_on_date", """SELECT passenger_count, count(*) AS n FROM trips
       WHERE CAST(tpep_pickup_datetime AS DATE) = DATE '1997-01-01' GROUP BY 1""", "trips")
def passengers_on_date(t):
    return (t.trips.filter(F.to_date("tpep_pickup_datetime") == F.lit("1997-01-01").cast("date"))
            .groupBy("passenger_count").agg(F.count(F.lit(1)).alias("n")))
