"""K: sinks. Each writes a given table whole, reads it back and reports on what was stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import loads
from ..plans import marts
from ..schemas import GREEN, as_ntz
from ..sources import messages, writers
from .registry import query
from .sources import GREEN_SQL, by_zone, green_rows, write_csv


def stored(t, path):
    return t.spark.read.parquet(path)


@query("k01_repartitioned", GREEN_SQL, "green")
def repartitioned(t):
    path = t.scratch("out")
    writers.write_parts(green_rows(t), path, 24)
    return by_zone(stored(t, path), "lpep_pickup_datetime")


@query("k02_single_file", "SELECT service_type, count(*) AS zone_months, sum(n)::BIGINT AS trips, 1 AS files FROM (SELECT service_type,"
       " pickup_location_id, date_trunc('month', pickup_datetime), count(*) AS n FROM unioned GROUP BY 1, 2, 3) GROUP BY 1", "unioned")
def single_file(t):
    path = t.scratch("out")
    report = t.unioned.groupBy("service_type", "pickup_location_id", C.trunc_ts("month", "pickup_datetime").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    writers.write_single(report, path)
    return stored(t, path).withColumn("file", F.col("_metadata.file_path")).groupBy("service_type").agg(
        F.count(F.lit(1)).alias("zone_months"), F.sum("n").alias("trips"), F.count_distinct("file").cast("int").alias("files"))


@query("k03_repartitioned_overwrite", """SELECT count(*) AS hours, sum(n)::BIGINT AS trips FROM (SELECT count(*) AS n FROM green
       GROUP BY date_trunc('hour', lpep_pickup_datetime), PULocationID)""", "green")
def repartitioned_overwrite(t):
    path = t.scratch("out")
    report = marts.hourly_zone_revenue(t.green, "1900-01-01", "lpep_pickup_datetime", "PULocationID", "total_amount")
    for _ in range(2):  # the second write replaces the first
        writers.write_parts(report, path, 20, "overwrite")
    return stored(t, path).agg(F.count(F.lit(1)).alias("hours"), F.sum("number_records").alias("trips"))


@query("k04_csv_to_parquet", GREEN_SQL, "green")
def csv_to_parquet(t):
    path = t.scratch("out")
    writers.csv_to_parquet(t.spark, write_csv(green_rows(t), t.scratch("csv")), path, GREEN)
    return by_zone(stored(t, path), "lpep_pickup_datetime")


@query("k05_create_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def create_table(t):
    path = t.scratch("table")
    name = "fareflow_" + path.rsplit("-", 1)[1]
    writers.create_table(t.orders, name, path)
    out = t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    t.spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return out


@query("k06_partitioned", """SELECT event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE)
       BETWEEN DATE '2024-01-06' AND DATE '2024-01-12' GROUP BY 1""")
def partitioned(t):
    path = t.scratch("by_day")
    writers.write_by_date(t.events, path, "ts")
    return writers.read_by_date(t.spark, path, "2024-01-06", "2024-01-12").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("k07_partitioned_clustered", """SELECT count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE CAST(ts AS DATE)
       BETWEEN DATE '2024-01-06' AND DATE '2024-01-25' AND event_type = 'click'""")
def partitioned_clustered(t):
    path = t.scratch("clustered")
    writers.write_by_date(t.events, path, "ts", ["event_type", "user_id"])
    rows = writers.read_by_date(t.spark, path, "2024-01-06", "2024-01-25")
    return rows.filter("event_type = 'click'").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("k08_partitioned_by_pickup", """SELECT CAST(ts AS DATE) AS pickup_date, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def partitioned_by_pickup(t):
    path = t.scratch("by_day")
    writers.write_by_date(t.events, path, "ts", partition="pickup_date")
    return stored(t, path).groupBy("pickup_date", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("k09_create_then_append", GREEN_SQL, "green")
def create_then_append(t):
    """An empty table from the schema, then the rows; a rerun starts over."""
    table = loads.Target(t.scratch("table"), as_ntz(GREEN))
    for _ in range(2):
        table = loads.replace(table, t.spark.createDataFrame([], as_ntz(GREEN)))
        loads.append(table, green_rows(t))
    return by_zone(table.read(t.spark), "lpep_pickup_datetime")


@query("k10_connector_write", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def connector_write(t):
    path = t.scratch("connector")
    writers.save_external(t.events.select("event_id", "event_type"), "orc", "overwrite", path=path)
    return t.spark.read.orc(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("k11_dispositions", """SELECT 'append' AS disposition, count(*) * 2 AS n FROM orders UNION ALL SELECT 'merge', count(*) FROM orders
       UNION ALL SELECT 'replace', count(*) FROM orders""")
def dispositions(t):
    out, rows = None, t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    for disposition in ("replace", "append", "merge"):
        table = loads.create(t.spark, t.scratch(disposition), rows.schema, "year")
        for _ in range(2):
            table = loads.load(table, rows, disposition, ["o_orderkey"], ["o_orderstatus"])
        part = table.read(t.spark).agg(F.lit(disposition).alias("disposition"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionAll(part)
    return out


@query("k12_temp_view", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def temp_view(t):
    t.orders.createOrReplaceTempView("fareflow_orders")
    return t.spark.sql("SELECT o_orderpriority, count(*) AS n FROM fareflow_orders GROUP BY 1")


@query("k15_text_messages", """SELECT CAST(user_id AS VARCHAR) AS key, concat_ws(', ', CAST(event_id AS VARCHAR),
       strftime(ts, '%Y-%m-%d %H:%M:%S'), event_type) AS value FROM events""")
def text_messages(t):
    out = messages.as_text(t.events, ["event_id", "ts", "event_type"], "user_id")
    return out.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("k20_publish_records", """SELECT event_type AS key, count(*) AS messages, count(DISTINCT value) AS bodies FROM (SELECT event_type,
       '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events) GROUP BY 1""")
def publish_records(t):
    """Messages go to a folder that stands for the topic."""
    path = t.scratch("topic")
    messages.as_json(t.events, ["user_id", "event_type"], "event_type").write.parquet(path)
    sent = stored(t, path).select(F.col("key").cast("string").alias("key"), "value")
    bodies = sent.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return bodies.groupBy("key").agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("bodies"))


@query("k22_create_if_absent", "SELECT count(*) AS n, 20 AS columns FROM green", "green")
def create_if_absent(t):
    path = t.scratch("typed")
    writers.create_empty(t.spark, path, as_ntz(GREEN))
    green_rows(t).write.mode("append").parquet(path)
    kept = writers.create_empty(t.spark, path, as_ntz(GREEN))  # present: nothing is made
    return kept.agg(F.count(F.lit(1)).alias("n"), F.lit(len(kept.columns)).alias("columns"))
