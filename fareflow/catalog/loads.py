"""M: load, merge and normalise."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..functions import columns as C
from ..functions import names
from ..operators import loads, nested
from ..plans import staging
from ..schemas import YELLOW
from ..session import materialise
from ..sources import readers
from ..sources.writers import by_size
from .registry import query
from .scalars import HASHED, HASHED_ALL, UP, all_hash_parts, hash_parts
from .sources import monthly_files, yellow_rows


def landed(df, filename):
    """Staging rows with their hash id over all seven fields, and file name."""
    return df.withColumns({"unique_row_id": C.row_hash(*all_hash_parts()), "filename": filename})


@query("m01_stage_and_stamp", f"""SELECT md5({HASHED_ALL}) AS unique_row_id, strftime({UP}, 'month=%m') AS folder, count(*) AS n FROM trips
       GROUP BY 1, 2""", "trips")
def stage_and_stamp(t):
    path = t.scratch("landing")
    by_size(yellow_rows(t).withColumn("month", F.date_format(UP, "MM")), "month").write.partitionBy("month").parquet(path)
    staged = landed(t.spark.read.parquet(path), F.regexp_extract(F.col("_metadata.file_path"), "(month=[0-9]+)", 1))
    rows = staged.select("unique_row_id", "filename")
    table = loads.Target(t.scratch("staging"), rows.schema)
    for _ in range(2):  # truncate and load
        loads.replace(table, rows)
    return table.read(t.spark).groupBy("unique_row_id", F.col("filename").alias("folder")).agg(F.count(F.lit(1)).alias("n"))


ID = f"md5({HASHED_ALL})"


def month():
    """Follows from the id, which hashes the pickup time."""
    return F.date_format(UP, "yyyy-MM").alias("month")


@query("m02_insert_only_merge", f"""WITH s AS (SELECT {ID} AS id, * FROM trips), old AS (SELECT * FROM s WHERE passenger_count < 4)
       SELECT id AS unique_row_id, fare_amount FROM old UNION ALL
       SELECT id, fare_amount FROM s WHERE id NOT IN (SELECT id FROM old)""", "trips")
def insert_only_merge(t):
    """Half of the feed is loaded first; the whole feed then adds only unknown ids. A rerun adds nothing.

    The digests are kept as 16 bytes, and get their 32 digits when they are read.
    """
    digest = F.unhex("unique_row_id").alias("unique_row_id")
    feed = materialise(landed(yellow_rows(t), F.lit("feed")).select(digest, "fare_amount", "passenger_count", month()), "feed")
    table = loads.create(t.spark, t.scratch("trips"), feed.schema, "month")
    loads.append(table, feed.filter("passenger_count < 4"))
    for _ in range(2):
        loads.append_missing(table, feed, "unique_row_id")
    return table.read(t.spark).select(F.lower(F.hex("unique_row_id")).alias("unique_row_id"), "fare_amount")


NEW = "SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'"


def changed_orders(t, *more):
    return t.orders.filter("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"), *more)


def year():
    """The partition that orders are kept in."""
    return F.year("o_orderdate").alias("year")


@query("m03_upsert", f"""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'
       UNION ALL {NEW}""")
def upsert(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", year())
    target = loads.replace(loads.Target(t.scratch("orders"), rows.schema, "year"), rows)
    return loads.merge(target, changed_orders(t, year()), ["o_orderkey"], ["o_orderstatus"]).read(t.spark).drop("year")


@query("m04_append", f"""SELECT o_orderstatus, count(*) AS n FROM (SELECT o_orderstatus FROM orders UNION ALL
       SELECT o_orderstatus FROM ({NEW})) GROUP BY 1""")
def append(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    table = loads.append(loads.Target(t.scratch("orders"), rows.schema), rows)
    return loads.append(table, changed_orders(t)).read(t.spark).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("m05_replace", NEW)
def replace(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    table = loads.replace(loads.Target(t.scratch("orders"), rows.schema), rows)
    return loads.replace(table, changed_orders(t)).read(t.spark)


@query("m06_incremental", f"""SELECT o_orderkey, o_orderdate FROM orders""")
def incremental(t):
    """Orders up to 1996 are there; the rest comes by cursor. The years before keep their files."""
    rows = t.orders.select("o_orderkey", "o_orderdate", year())
    target = loads.Target(t.scratch("orders"), rows.schema, "year")
    loads.replace(target, rows.filter("o_orderdate < TIMESTAMP_NTZ '1997-01-01'"))
    return loads.incremental(target, rows, "o_orderkey", "o_orderdate", ["o_orderdate"]).read(t.spark).drop("year")


@query("m07_cursor_extraction", """SELECT 1 AS run, count(*) AS rows FROM events WHERE ts >= TIMESTAMP '2024-01-08'
       UNION ALL SELECT 2, 0""")
def cursor_extraction(t):
    """The first run loads from the initial value on; the second finds nothing new."""
    rows = t.events.select("event_id", "ts")
    cursor = loads.Cursor(t.spark, t.scratch("state"), "2024-01-08 00:00:00")
    table = loads.create(t.spark, t.scratch("events"), rows.schema)
    counts = loads.create(t.spark, t.scratch("counts"), "run int, rows long")
    for run in (1, 2):
        fresh = cursor.extract(rows, "ts", table.read(t.spark), "event_id")
        loads.append(counts, fresh.agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("rows")))
        loads.append(table, fresh)
        cursor.advance(table.read(t.spark), "ts")
    return counts.read(t.spark)


@query("m08_key_dedup_enrich", "SELECT * FROM enriched", "enriched")
def key_dedup_enrich(t):
    return staging.enrich(t.unioned, staging.payment_types(t.spark))


def ride_documents(t):
    """A nested document per event: time and place structs, and a list of passengers."""
    return t.events.select(
        F.col("event_type").alias("vendor_name"), F.col("event_id").alias("record_hash"),
        F.struct(C.ts_text("ts").alias("pickup")).alias("time"),
        F.struct(F.struct(F.col("value").alias("lon"), F.col("user_id").alias("lat")).alias("start")).alias("coordinates"),
        F.transform(F.sequence(F.lit(1), (F.col("user_id") % 4 + 1).cast("int")),
                    lambda i: F.struct(F.concat(F.lit("p"), i.cast("string")).alias("name"),
                                       (F.col("user_id") + i).alias("rating"))).alias("passengers"))


@query("m09_parent_table", """SELECT event_type AS vendor_name, event_id AS record_hash, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time__pickup,
       value AS coordinates__start__lon, user_id AS coordinates__start__lat,
       md5('{"c0":"' || event_id || '"}') AS row_id FROM events""")
def parent_table(t):
    return nested.normalise(ride_documents(t), "rides", ["record_hash"])["rides"]


@query("m09_child_table", """SELECT md5('{"c0":"' || event_id || '"}') AS parent_id, CAST(i - 1 AS INTEGER) AS list_idx,
       'p' || i AS name, user_id + i AS rating, md5('{"c0":"' || md5('{"c0":"' || event_id || '"}') || '","c1":"passengers","c2":"'
       || (i - 1) || '"}') AS row_id FROM (SELECT *, unnest(range(1, user_id % 4 + 2)) AS i FROM events)""")
def child_table(t):
    return nested.normalise(ride_documents(t), "rides", ["record_hash"])["rides__passengers"]


@query("m10_normalised_names", """SELECT l_orderkey AS trip_order_key, l_linenumber AS trip_line_number,
       l_shipdate AS trip_pickup_date_time FROM lineitem""")
def normalised_names(t):
    raw = t.lineitem.select(F.col("l_orderkey").alias("Trip_OrderKey"), F.col("l_linenumber").alias("Trip_LineNumber"),
                            F.col("l_shipdate").alias("Trip_Pickup_DateTime"))
    return names.snake_columns(raw)


@query("m11_typed_timestamps", "SELECT event_id, date_trunc('second', ts) AS pickup FROM events")
def typed_timestamps(t):
    text = t.events.select("event_id", C.ts_text("ts").alias("pickup"))
    return nested.typed_timestamps(text, ["pickup"]).withColumn("pickup", F.col("pickup").cast(C.NTZ))


@query("m12_schema_evolution", """SELECT o_orderkey, NULL::VARCHAR AS occupation FROM orders UNION ALL
       SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW'""")
def schema_evolution(t):
    rows = t.orders.select("o_orderkey")
    table = loads.append(loads.Target(t.scratch("people"), rows.schema), rows)
    wider = t.orders.filter("o_orderpriority = '5-LOW'").select("o_orderkey", F.col("o_orderstatus").alias("occupation"))
    return loads.append(table, wider).read(t.spark)


@query("m13_schema_compatibility", """SELECT 'added column' AS change, true AS compatible, count(*) AS n FROM orders UNION ALL
       SELECT 'changed type', false, count(*) FROM orders""")
def schema_compatibility(t):
    """Two changed versions of the orders table against the stored one."""
    old = t.orders.schema
    added = t.orders.withColumn("zone", F.lit(None).cast("long"))
    retyped = t.orders.withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    one = lambda df, what: df.agg(F.lit(what).alias("change"), F.lit(loads.compatible(old, df.schema)).alias("compatible"), F.count(F.lit(1)).alias("n"))
    return one(added, "added column").unionAll(one(retyped, "changed type"))


@query("m14_version_history", """SELECT user_id, event_id, ts AS valid_from, row_number() OVER w AS version, lead(ts) OVER w AS valid_to,
       lead(ts) OVER w IS NULL AS is_current FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def version_history(t):
    rows = t.events.select("user_id", "event_id", F.col("ts").alias("valid_from"))
    return loads.history(rows, ["user_id"], "valid_from", ["event_id"])


@query("m15_month_set", f"""SELECT strftime({UP}, '%Y-%m') AS month, count(DISTINCT {ID}) AS ids FROM trips
       WHERE {UP} >= TIMESTAMP '1996-11-01' AND {UP} < TIMESTAMP '1997-02-01' GROUP BY 1""", "trips")
def month_set(t):
    """A backfill of three months over a year's end as one job."""
    root = monthly_files(t)
    paths = readers.month_paths(root, "yellow", [1996], [11, 12]) + readers.month_paths(root, "yellow", [1997], [1])
    feed = landed(readers.csv_typed(t.spark, paths, YELLOW), F.col("_metadata.file_name")).withColumn("month", month())
    table = loads.create(t.spark, t.scratch("trips"), feed.schema, "month")
    for _ in range(2):
        loads.append_missing(table, feed, "unique_row_id")
    ids = table.read(t.spark).select("month", "unique_row_id").distinct()
    return ids.groupBy("month").agg(F.count(F.lit(1)).alias("ids"))


@query("m16_delete_by_key", "SELECT * FROM zones WHERE LocationID <> 17", "zones")
def delete_by_key(t):
    return loads.delete_by_key(t.zones, "LocationID", [17])


@query("m17_month_table", f"""SELECT unhex(md5({HASHED})) AS unique_row_id, 'yellow_tripdata_1996-11.csv' AS filename, PULocationID, fare_amount
       FROM trips WHERE {UP} >= TIMESTAMP '1996-11-01' AND {UP} < TIMESTAMP '1996-12-01'""", "trips")
def month_table(t):
    paths = readers.month_paths(monthly_files(t), "yellow", [1996], [11])
    external = readers.external_csv(t.spark, "external_month", paths, YELLOW)
    return external.select(C.row_hash_bytes(*hash_parts()).alias("unique_row_id"),
                           F.lit("yellow_tripdata_1996-11.csv").alias("filename"), "PULocationID", "fare_amount")


@query("r02_validated_copy", "SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS rows, count(*) AS copied FROM orders GROUP BY 1")
def validated_copy(t):
    """Many files checked and copied in one job, with rows per file set before and after."""
    source, target = t.scratch("upload"), t.scratch("bucket")
    by_size(t.orders.withColumn("y", F.date_format("o_orderdate", "yyyy")), "y").write.partitionBy("y").parquet(source)
    files = t.spark.read.option("basePath", source).parquet(f"{source}/y=*")
    files.write.partitionBy("y").parquet(target)
    count = lambda path, name: t.spark.read.parquet(path).groupBy(F.col("y").cast("string").alias("year")).agg(F.count(F.lit(1)).alias(name))
    return count(source, "rows").join(count(target, "copied"), "year", "full")


@query("r03_colour_year_month", """SELECT 'yellow' AS colour, year(tpep_pickup_datetime) AS year, count(*) AS n FROM trips
       WHERE month(tpep_pickup_datetime) IN (1, 2, 3) AND year(tpep_pickup_datetime) IN (1995, 1996) GROUP BY 2""", "trips")
def colour_year_month(t):
    df = readers.csv_months(t.spark, monthly_files(t), "yellow", [1995, 1996], [1, 2, 3])
    return df.groupBy(F.lit("yellow").alias("colour"), F.year(UP).cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"))
