"""S: sources. Each writes a given table in the source's layout and reads it back whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import GREEN, YELLOW
from ..sources import messages, paging, readers
from ..sources.writers import by_size
from .registry import query

BY_ZONE = """SELECT PULocationID, count(*) AS n, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total,
    min({ts}) AS first_pickup FROM {feed} GROUP BY 1"""
GREEN_SQL, TRIPS_SQL = (BY_ZONE.format(ts=ts, feed=feed) for ts, feed in
                        (("lpep_pickup_datetime", "green"), ("tpep_pickup_datetime", "trips")))


def by_zone(df, ts: str):
    return df.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"), C.exact_sum("total_amount").alias("total"),
                                          F.min(ts).cast(C.NTZ).alias("first_pickup"))


def green_rows(t):
    return t.green.select(*[F.col(f.name) for f in GREEN])


def yellow_rows(t):
    return t.trips.select(*[F.col(f.name) for f in YELLOW])


def write_csv(df, path: str, **options):
    df.write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", **options).csv(path)
    return path


@query("s01_csv_typed", GREEN_SQL, "green")
def csv_typed(t):
    return by_zone(readers.csv_typed(t.spark, write_csv(green_rows(t), t.scratch("csv")), GREEN), "lpep_pickup_datetime")


@query("s02_csv_strings", "SELECT CAST(PULocationID AS VARCHAR) AS PULocationID, count(*) AS n FROM trips GROUP BY 1", "trips")
def csv_strings(t):
    df = readers.csv_strings(t.spark, write_csv(yellow_rows(t), t.scratch("csv")))
    return df.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))


@query("s03_csv_sampled", TRIPS_SQL, "trips")
def csv_sampled(t):
    df = readers.csv_sampled(t.spark, write_csv(yellow_rows(t), t.scratch("csv")), 0.1)
    return by_zone(df, "tpep_pickup_datetime")


@query("s03_widened_types", """SELECT l_linestatus, 'double' AS quantity_type, 'int' AS line_type, 'string' AS tag_type, count(*) AS n,
       sum(l_linenumber) AS lines, sum(CASE WHEN last THEN l_quantity + 0.5 ELSE l_quantity END) AS quantity,
       count(*) FILTER (last) AS odd_tags FROM (SELECT *, l_orderkey = max(l_orderkey) OVER () AS last FROM lineitem) GROUP BY 1""")
def widened_types(t):
    """Quantities and tags are whole numbers but in the rows of the last order."""
    rows = t.lineitem.select("l_orderkey", "l_linestatus", "l_linenumber", F.col("l_quantity").cast("long").alias("whole"))
    last = F.col("l_orderkey") == rows.agg(F.max("l_orderkey")).scalar()
    odd = rows.select("l_linestatus", "l_linenumber", F.when(last, F.concat("whole", F.lit(".5"))).otherwise(F.col("whole").cast("string")).alias("quantity"),
                      F.when(last, F.lit("n/a")).otherwise(F.col("whole").cast("string")).alias("tag"))
    df = readers.csv_widened(t.spark, write_csv(odd, t.scratch("csv")))
    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.groupBy("l_linestatus").agg(
        F.lit(kind["quantity"]).alias("quantity_type"), F.lit(kind["l_linenumber"]).alias("line_type"), F.lit(kind["tag"]).alias("tag_type"),
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"), F.sum("quantity").alias("quantity"),
        F.count(F.when(F.col("tag") == "n/a", 1)).alias("odd_tags"))


def monthly_files(t):
    """Gzipped files in one folder per month."""
    root = t.scratch("raw")
    month = {"year": F.date_format("tpep_pickup_datetime", "yyyy"), "month": F.date_format("tpep_pickup_datetime", "MM")}
    (by_size(yellow_rows(t).withColumns(month), "year", "month").write.partitionBy("year", "month")
     .options(header=True, compression="gzip", timestampNTZFormat="yyyy-MM-dd HH:mm:ss").csv(f"{root}/yellow"))
    return root


@query("s04_gzipped_months", """SELECT year(tpep_pickup_datetime) AS year, month(tpep_pickup_datetime) AS month, count(*) AS n
       FROM trips WHERE year(tpep_pickup_datetime) IN (1996, 1997) GROUP BY 1, 2""", "trips")
def gzipped_months(t):
    df = readers.csv_months(t.spark, monthly_files(t), "yellow", [1996, 1997])
    ts = "tpep_pickup_datetime"
    return df.groupBy(F.year(ts).cast("long").alias("year"), F.month(ts).cast("long").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("s05_parquet_glob", GREEN_SQL, "green")
def parquet_glob(t):
    path = t.scratch("pq")
    df = green_rows(t).withColumns({"y": F.year("lpep_pickup_datetime"), "m": F.month("lpep_pickup_datetime")})
    by_size(df, "y", "m").write.partitionBy("y", "m").parquet(path)
    return by_zone(readers.parquet(t.spark, f"{path}/*/*"), "lpep_pickup_datetime")


@query("s06_detected_format", """SELECT 'csv' AS format, count(*) AS n FROM trips UNION ALL
       SELECT 'csv.gz', count(*) FROM trips UNION ALL SELECT 'parquet', count(*) FROM trips""", "trips")
def detected_format(t):
    """The feed is built once: the text formats are written from the Parquet folder."""
    root, parts = t.scratch("any"), {}
    yellow_rows(t).write.parquet(f"{root}/trips.parquet")
    rows = t.spark.read.parquet(f"{root}/trips.parquet")
    write_csv(rows, f"{root}/trips.csv")
    write_csv(rows, f"{root}/trips.csv.gz", compression="gzip")
    for suffix in ("csv", "csv.gz", "parquet"):
        df = readers.read_any(t.spark, f"{root}/trips.{suffix}", feed="yellow")
        parts[suffix] = df.agg(F.lit(suffix).alias("format"), F.count(F.lit(1)).alias("n"))
    return parts["csv"].unionAll(parts["csv.gz"]).unionAll(parts["parquet"])


@query("s07_union_by_name", """SELECT l_returnflag, count(*) AS n, count(l_tax) FILTER (l_linestatus = 'F') AS with_tax
       FROM lineitem GROUP BY 1""")
def union_by_name(t):
    path = t.scratch("evolving")
    t.lineitem.filter("l_linestatus = 'F'").select("l_returnflag", "l_orderkey", "l_tax").write.parquet(f"{path}/new")
    t.lineitem.filter("l_linestatus <> 'F'").select("l_orderkey", "l_returnflag").write.parquet(f"{path}/old")
    return readers.union_by_name(t.spark, f"{path}/old", f"{path}/new").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("with_tax"))


@query("s08_external_csv", "SELECT count(*) AS n, count(DISTINCT PULocationID) AS zones FROM trips", "trips")
def external_csv(t):
    root = t.scratch("external")
    write_csv(yellow_rows(t).filter("passenger_count < 3"), f"{root}/2019")
    write_csv(yellow_rows(t).filter("passenger_count >= 3"), f"{root}/2020")
    readers.external_csv(t.spark, "external_trips", [f"{root}/2019/*.csv", f"{root}/2020/*.csv"])
    return t.spark.sql("SELECT count(*) AS n, count(DISTINCT PULocationID) AS zones FROM external_trips")


@query("s09_external_typed", TRIPS_SQL, "trips")
def external_typed(t):
    """The file has one trailing value more than the table has columns."""
    path = write_csv(yellow_rows(t).withColumn("extra_value", F.lit("ignored")), t.scratch("csv"), quoteAll=True)
    return by_zone(readers.external_csv(t.spark, "external_typed", [path], YELLOW), "tpep_pickup_datetime")


@query("s10_external_parquet", GREEN_SQL, "green")
def external_parquet(t):
    path = t.scratch("external")
    green_rows(t).write.parquet(path)
    return by_zone(readers.external_parquet(t.spark, "external_green", path), "lpep_pickup_datetime")


@query("s11_json_array", """SELECT p_brand AS brand, round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2)
       AS avg_price, count(*) AS n FROM part GROUP BY 1""")
def json_array(t):
    """Documents {"products": [...]}, a line each."""
    path = t.scratch("products")
    item = F.struct(F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"))
    docs = t.part.select(F.array(item).alias("products"))
    docs.select("products").write.json(path)
    return readers.json_array(t.spark, path, "products", whole_files=False).groupBy("brand").agg(F.round(C.exact_avg("price"), 2).alias("avg_price"), F.count(F.lit(1)).alias("n"))


@query("s12_json_lines", "SELECT event_id, user_id, event_type, value FROM events")
def json_lines(t):
    path = t.scratch("lines")
    t.events.select("event_id", "user_id", "event_type", "value").write.json(path)
    return readers.json_lines(t.spark, path, t.events.select("event_id", "user_id", "event_type", "value").schema)


@query("s13_paged_records", """SELECT CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) + 1 AS page,
       event_id, event_type FROM events""")
def paged_records(t):
    path = t.scratch("pages")
    rows = t.events.select("event_id", "event_type")
    readers.write_pages(rows, path, ["event_id"])
    return readers.read_pages(t.spark, path, rows.schema)


@query("s13_paged_source", """SELECT CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) + 1 AS page,
       event_id, event_type FROM events""")
def paged_source(t):
    """The same pages through the paged data source: tasks read ranges of pages."""
    path = t.scratch("pages")
    rows = t.events.select("event_id", "event_type")
    paging.write_pages(rows, path, ["event_id"])
    return paging.read_pages(t.spark, path, rows.schema)


@query("s13_paged_increments", """SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids,
       (SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-08') FROM events) AS first_run, (SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-08') FROM events) AS second_run,
       0 AS third_run FROM events GROUP BY 1""")
def paged_increments(t):
    """Pages of the first week, then those added after it, then nothing new: the cursor is the stream's place."""
    path, target, state = t.scratch("pages"), t.scratch("events"), t.scratch("state")
    rows = t.events.select("event_id", "event_type", "ts").withColumn("late", F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz"))
    schema = t.events.select("event_id", "event_type").schema
    early = rows.filter(~F.col("late")).select("event_id", "event_type")
    paging.write_pages(early, path, ["event_id"])
    runs = [paging.load_new(t.spark, path, schema, target, state)]
    paging.add_pages(rows.filter("late").select("event_id", "event_type"), path, ["event_id"], early.count())
    runs += [paging.load_new(t.spark, path, schema, target, state) for _ in range(2)]
    return t.spark.read.schema(schema).parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), *[F.lit(n).alias(f"{w}_run") for w, n in zip(("first", "second", "third"), runs)])


@query("s14_generated_rows", """WITH days AS (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders)::TIMESTAMP,
       (SELECT max(o_orderdate) FROM orders)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day)
       SELECT day, count(o_orderkey) AS n FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1""")
def generated_rows(t):
    """A calendar made by Spark over the orders' date range."""
    day = F.to_date("o_orderdate")
    span = t.orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    counts = t.orders.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("s15_seed_tables", "SELECT Borough, count(*) AS zones, count(DISTINCT service_zone) AS kinds FROM zones GROUP BY 1", "zones")
def seed_tables(t):
    from ..schemas import ZONES
    path = t.scratch("seed")
    t.zones.select(*ZONES.fieldNames()).write.option("header", True).csv(path)
    return readers.csv_typed(t.spark, path, ZONES).groupBy("Borough").agg(
        F.count(F.lit(1)).alias("zones"), F.count_distinct("service_zone").alias("kinds"))


@query("s16_object_store", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def object_store(t):
    uri = t.path("events")
    uri = uri if "://" in uri else f"file://{uri}"
    return readers.object_store(t.spark, uri, "parquet", {"fs.gs.impl.disable.cache": "false"}).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("s17_scan_with_limit", "SELECT count(*) AS n, 2 AS columns FROM (SELECT n_nationkey, n_name FROM nation LIMIT 100)")
def scan_with_limit(t):
    out = readers.table_scan(t.nation, ["n_nationkey", "n_name"], 100)
    return out.agg(F.count(F.lit(1)).alias("n")).withColumn("columns", F.lit(len(out.columns)))


@query("s23_partition_listing", "SELECT CAST(ts AS DATE) AS partition_id, count(*) AS total_rows FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def partition_listing(t):
    path = t.scratch("by_day")
    by_size(t.events.withColumn("day", F.to_date("ts")), "day").write.partitionBy("day").parquet(path)
    return readers.partition_listing(t.spark.read.parquet(path), "day")


@query("s24_describe", """SELECT 0 AS position, 'n_nationkey' AS column_name, 'int' AS data_type, true AS is_nullable,
       count(*) AS table_rows FROM nation UNION ALL SELECT 1, 'n_name', 'string', true, count(*) FROM nation UNION ALL
       SELECT 2, 'n_regionkey', 'int', true, count(*) FROM nation""")
def describe(t):
    return readers.describe(t.nation)


# ---- message sources: the same rows as keyed messages in files --------------
def envelope(df, topic: str):
    """Messages with their place in the topic, as a topic reader shows them."""
    return df.select("key", "value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
                     F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"))


@query("s21_json_topic", "SELECT event_type AS payment_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS distance, count(*) AS n FROM events GROUP BY 1")
def json_topic(t):
    path = t.scratch("topic")
    rows = t.events.select(F.col("user_id").cast("string").alias("VendorId"), F.col("value").alias("trip_distance"),
                           F.col("event_type").alias("payment_type"))
    envelope(messages.as_json(rows, rows.columns, "VendorId"), "rides").write.parquet(path)
    parsed = messages.parse_json(t.spark.read.parquet(path), rows.schema)
    return parsed.groupBy("payment_type").agg(C.exact_sum("trip_distance").alias("distance"), F.count(F.lit(1)).alias("n"))


@query("s22_text_consumer", """SELECT VendorID AS vendor_id, payment_type, count(*) AS n, max(CAST(total_amount AS FLOAT)) AS total
       FROM trips GROUP BY 1, 2""", "trips")
def text_consumer(t):
    from ..schemas import RIDE_TEXT
    rows = t.trips.select(F.col("VendorID").alias("vendor_id"), "tpep_pickup_datetime", "tpep_dropoff_datetime",
                          "passenger_count", "trip_distance", "payment_type", "total_amount")
    path = t.scratch("topic")
    envelope(messages.as_text(rows, rows.columns, "vendor_id"), "rides_csv").write.parquet(path)
    parsed = messages.parse_text(t.spark.read.parquet(path), RIDE_TEXT)
    return parsed.groupBy("vendor_id", "payment_type").agg(F.count(F.lit(1)).alias("n"), F.max("total_amount").alias("total"))


@query("s22_quoted_json_consumer", """SELECT payment_type, count(tpep_pickup_datetime) AS n, min(tpep_pickup_datetime) AS first_pickup
       FROM trips GROUP BY 1""", "trips")
def quoted_json(t):
    """Every value quoted, the pickup time as a one-element list."""
    from ..schemas import ddl
    pickup = F.when(F.col("passenger_count") < 3, F.to_json(F.array(C.ts_text("tpep_pickup_datetime")))).otherwise(C.ts_text("tpep_pickup_datetime"))
    rows = t.trips.select(pickup.alias("tpep_pickup_datetime"), F.col("payment_type").cast("string").alias("payment_type"))
    path = t.scratch("topic")
    messages.as_json(rows, rows.columns).write.parquet(path)
    parsed = messages.parse_json_strings(t.spark.read.parquet(path), ddl("tpep_pickup_datetime timestamp, payment_type int"))
    return parsed.groupBy("payment_type").agg(F.count("tpep_pickup_datetime").alias("n"),
                                              F.min("tpep_pickup_datetime").cast(C.NTZ).alias("first_pickup"))
