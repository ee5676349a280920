"""W: window functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import dedup, ordered, percentiles
from ..plans import marts
from ..plans.staging import TRIP_COLUMNS, TRIP_KEY
from .registry import query
from .tables import _TIE

LINE = "l_orderkey, l_linenumber"
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
TIES = ", ".join(LINE_KEY)


@query("w01_row_number_top", f"""SELECT l_extendedprice AS total_amount, row_number() OVER (ORDER BY l_extendedprice DESC, {TIES})
       AS ranking FROM lineitem ORDER BY ranking LIMIT 10""")
def row_number_top(t):
    top = dedup.top_k_numbered(t.lineitem.select("l_extendedprice", *LINE_KEY), ["-l_extendedprice", *LINE_KEY], 10)
    return top.select(F.col("l_extendedprice").alias("total_amount"), "ranking")


@query("w01_row_number_all", f"""SELECT {LINE}, l_extendedprice, row_number() OVER
       (ORDER BY l_extendedprice DESC, {TIES}) AS ranking FROM lineitem""")
def row_number_all(t):
    rows = ordered.number_rows(t.lineitem.select("l_extendedprice", *LINE_KEY), [], ["-l_extendedprice", *LINE_KEY], "ranking")
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", "ranking")


@query("w02_row_number_by_group", f"""SELECT {LINE}, l_suppkey, l_extendedprice, row_number() OVER
       (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, {TIES}) AS ranking FROM lineitem""")
def row_number_by_group(t):
    rows = ordered.number_rows(t.lineitem.select("l_extendedprice", *LINE_KEY), ["l_suppkey"],
                               ["-l_extendedprice", *LINE_KEY], "ranking")
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "ranking")


@query("w03_ranks", f"""SELECT {LINE}, l_linestatus, l_quantity, row_number() OVER (PARTITION BY l_linestatus
       ORDER BY l_quantity DESC, {TIES}) AS row_number, rank() OVER s AS rank, dense_rank() OVER s AS dense_rank
       FROM lineitem WINDOW s AS (PARTITION BY l_linestatus ORDER BY l_quantity DESC)""")
def ranks(t):
    rows = t.lineitem.select("l_linestatus", "l_quantity", *LINE_KEY)
    out = ordered.ranked(rows, ["l_linestatus"], "-l_quantity", LINE_KEY)
    return out.drop("l_partkey", "l_suppkey")


@query("w04_lag_lead", """SELECT event_id, ts, value, lag(value) OVER s AS previous_value, lead(value) OVER s AS next_value
       FROM events WINDOW s AS (ORDER BY ts, event_id)""")
def lag_lead(t):
    return ordered.lag_lead(t.events.select("event_id", "ts", "value"), [], ["ts", "event_id"], "value",
                            "previous_value", "next_value")


@query("w05_percentile_over", """SELECT event_id, event_type, value, round(quantile_cont(value, 0.9) OVER
       (PARTITION BY event_type), 6) AS p90 FROM events""")
def percentile_over(t):
    out = percentiles.percentile_over(t.events.select("event_id", "event_type", "value"), ["event_type"], "value", 0.9, "p90")
    return out.withColumn("p90", F.round("p90", 6))


@query("w06_running_and_moving", """SELECT event_id, event_type,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (s ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (s ROWS 6 PRECEDING) AS DOUBLE) /
       count(value) OVER (s ROWS 6 PRECEDING) AS moving_avg
       FROM events WINDOW s AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def running_and_moving(t):
    rows = t.events.select("event_id", "event_type", "ts", F.col("value").cast(C.MONEY).alias("v"))
    rows = ordered.number_rows(rows, ["event_type"], ["ts", "event_id"])
    last = lambda w: w.rowsBetween(-6, 0)
    rows = ordered.chunked(rows, ["event_type"], {
        "moving_avg": lambda w: F.sum("v").over(last(w)).cast("double") / F.count("v").over(last(w))},
        sums={"running_total": "v"}, before=6)
    return rows.select("event_id", "event_type", F.col("running_total").cast("double").alias("running_total"), "moving_avg")


@query("w07_keep_first", f"""SELECT * FROM unioned QUALIFY row_number() OVER (PARTITION BY {', '.join(TRIP_KEY)}
       ORDER BY dropoff_datetime, {_TIE}) = 1""", "unioned")
def keep_first(t):
    return dedup.keep_first(t.unioned.select(*TRIP_COLUMNS), TRIP_KEY, ["dropoff_datetime"])


@query("w08_second_largest", """SELECT l_orderkey, l_extendedprice, CAST(rnk AS INTEGER) AS rank FROM (SELECT *, rank() OVER
       (ORDER BY l_extendedprice DESC) AS rnk FROM lineitem) WHERE rnk = 2""")
def second_largest(t):
    return dedup.nth_value_rows(t.lineitem.select("l_orderkey", "l_extendedprice"), "-l_extendedprice", 2)


@query("w09_p90_duration", """WITH d AS (SELECT PUlocationID, date_diff('second', pickup_datetime, dropOff_datetime)
       AS trip_duration FROM fhv) SELECT PUlocationID, trip_duration,
       round(quantile_cont(trip_duration, 0.9) OVER (PARTITION BY PUlocationID), 6) AS trip_duration_p90 FROM d""", "fhv")
def p90_duration(t):
    rows = t.fhv.select("PUlocationID", C.second_diff("pickup_datetime", "dropOff_datetime").alias("trip_duration"))
    out = percentiles.percentile_over(rows, ["PUlocationID"], "trip_duration", 0.9, "trip_duration_p90")
    return out.withColumn("trip_duration_p90", F.round("trip_duration_p90", 6))


@query("w10_yearly_growth", """WITH q AS (SELECT service_type, year(pickup_datetime) AS year, quarter(pickup_datetime) AS quarter,
       CAST(sum(total_amount) AS DOUBLE) AS revenue FROM unioned GROUP BY 1, 2, 3)
       SELECT a.*, (a.revenue - b.revenue) / b.revenue * 100.0::DOUBLE AS growth_pct FROM q a LEFT JOIN q b
       ON a.service_type = b.service_type AND a.quarter = b.quarter AND a.year = b.year + 1""", "unioned")
def yearly_growth(t):
    return marts.yearly_growth(marts.quarterly_revenue(t.unioned))


@query("w11_monthly_fare_percentiles", """SELECT service_type, year(pickup_datetime) AS year, month(pickup_datetime) AS month,
       round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.97), 6) AS p97,
       round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.95), 6) AS p95,
       round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.90), 6) AS p90 FROM enriched
       WHERE fare_amount > 0 AND trip_distance > 0 AND payment_type_description IN ('Cash', 'Credit card')
       GROUP BY 1, 2, 3""", "enriched")
def monthly_fare_percentiles(t):
    out = marts.monthly_fare_percentiles(t.enriched)
    return out.select("service_type", "year", "month", *[F.round(p, 6).alias(p) for p in ("p97", "p95", "p90")])


@query("w12_second_longest_p90", """WITH d AS (SELECT PUlocationID, DOlocationID, round(quantile_cont(
       date_diff('second', pickup_datetime, dropOff_datetime), 0.9), 6) AS p90 FROM fhv
       WHERE dispatching_base_num IS NOT NULL GROUP BY 1, 2),
       r AS (SELECT *, dense_rank() OVER (PARTITION BY PUlocationID ORDER BY p90 DESC) AS dr FROM d)
       SELECT PUlocationID, DOlocationID, p90 FROM r WHERE dr = 2""", "fhv")
def second_longest_p90(t):
    rows = t.fhv.filter("dispatching_base_num is not null").withColumnRenamed("dropOff_datetime", "dropoff_datetime")
    p90 = marts.travel_time_percentiles(rows, ["PUlocationID", "DOlocationID"])
    p90 = p90.withColumn("p90", F.round("p90", 6))
    return marts.nth_longest_dropoff(p90, ["PUlocationID"], 2).drop("dense_rank")


@query("w13_latest_per_category", """SELECT event_type, event_id, ts, value FROM events QUALIFY row_number() OVER
       (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_category(t):
    return dedup.keep_first(t.events.select("event_type", "event_id", "ts", "value"), ["event_type"], ["-ts", "-event_id"])


SESSIONS = """gaps AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 3 HOUR
    OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM events),
    runs AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM gaps),
    sessions AS (SELECT user_id, min(ts) AS started, count(*) AS rides FROM runs GROUP BY user_id, run)"""


@query("w14_longest_streak", f"WITH {SESSIONS} SELECT * FROM sessions ORDER BY rides DESC, user_id, started LIMIT 1")
def longest_streak(t):
    runs = ordered.sessions(t.events, ["user_id"], "ts", 3 * 3600, ["event_id"])
    out = runs.select("user_id", F.col("session_start").alias("started"), F.col("count").alias("rides"))
    return dedup.top_k(out, ["-rides", "user_id", "started"], 1)


@query("w14_all_streaks", f"WITH {SESSIONS} SELECT user_id, started, rides FROM sessions")
def all_streaks(t):
    runs = ordered.sessions(t.events, ["user_id"], "ts", 3 * 3600, ["event_id"])
    return runs.select("user_id", F.col("session_start").alias("started"), F.col("count").alias("rides"))
