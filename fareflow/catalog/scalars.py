"""F and X: scalar functions and user functions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import nested
from ..plans import staging
from .registry import query

UP, DOWN = "tpep_pickup_datetime", "tpep_dropoff_datetime"


@query("f01_casts", """SELECT event_id, CAST(event_id AS INTEGER) AS as_int, CAST(value AS DECIMAL(18,3)) AS as_numeric,
       CAST(event_id AS VARCHAR) AS as_text, CAST(ts AS DATE) AS as_date,
       TRY_CAST(event_type AS INTEGER) AS malformed FROM events""")
def casts(t):
    return t.events.select("event_id", F.col("event_id").cast("int").alias("as_int"), F.col("value").cast(C.NUMERIC).alias("as_numeric"),
                           F.col("event_id").cast("string").alias("as_text"), F.col("ts").cast("date").alias("as_date"),
                           F.col("event_type").try_cast("int").alias("malformed"))


@query("f02_date_trunc", """SELECT date_trunc('month', ts) AS month, date_trunc('hour', ts) AS hour, count(*) AS n
       FROM events GROUP BY 1, 2""")
def date_trunc(t):
    return t.events.groupBy(C.trunc_ts("month", "ts").alias("month"), C.trunc_ts("hour", "ts").alias("hour")).agg(F.count("*").alias("n"))


@query("f03_to_date", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def to_date(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query("f04_minute_diff", f"SELECT date_diff('minute', {UP}, {DOWN}) AS minutes, count(*) AS n FROM trips GROUP BY 1", "trips")
def minute_diff(t):
    return t.trips.groupBy(C.minute_diff(UP, DOWN).alias("minutes")).agg(F.count("*").alias("n"))


@query("f05_second_diff", f"SELECT date_diff('second', {UP}, {DOWN}) AS seconds, count(*) AS n FROM trips GROUP BY 1", "trips")
def second_diff(t):
    return t.trips.groupBy(C.second_diff(UP, DOWN).alias("seconds")).agg(F.count("*").alias("n"))


@query("f06_durations", f"""SELECT date_diff('second', {UP}, {DOWN}) / 60.0::DOUBLE AS minutes,
       date_diff('second', {UP}, {DOWN}) / 3600.0::DOUBLE AS hours, count(*) AS n FROM trips GROUP BY 1, 2""", "trips")
def durations(t):
    return t.trips.groupBy(C.duration_minutes(UP, DOWN).cast("double").alias("minutes"),
                           C.duration_hours(UP, DOWN).cast("double").alias("hours")).agg(F.count("*").alias("n"))


@query("f07_calendar_parts", """SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, month(o_orderdate) AS month,
       year(o_orderdate) || '/Q' || quarter(o_orderdate) AS label, count(*) AS n FROM orders GROUP BY ALL""")
def calendar_parts(t):
    ts = "o_orderdate"
    return t.orders.groupBy(F.year(ts).cast("long").alias("year"), F.quarter(ts).cast("long").alias("quarter"),
                            F.month(ts).cast("long").alias("month"), C.quarter_label(ts).alias("label")).agg(F.count("*").alias("n"))


@query("f08_days_before", """SELECT CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY AS DATE) AS month_ago,
       count(*) AS n FROM orders GROUP BY 1, 2""")
def days_before(t):
    day = F.to_date("o_orderdate")
    return t.orders.groupBy(day.alias("day"), F.date_sub(day, 30).alias("month_ago")).agg(F.count("*").alias("n"))


@query("f09_current_timestamp", "SELECT event_type, true AS stamped, count(*) AS n FROM events GROUP BY 1")
def current_timestamp(t):
    stamped = t.events.withColumn("loaded_at", F.current_timestamp())
    return stamped.groupBy("event_type").agg(
        (F.max("loaded_at") > F.max(C.instant("ts"))).alias("stamped"), F.count("*").alias("n"))


@query("f10_parse_timestamp", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def parse_timestamp(t):
    text = t.events.select("event_id", C.ts_text("ts").alias("text"))
    return text.select("event_id", C.parse_ts("text").cast(C.NTZ).alias("parsed"))


@query("f11_from_millis", "SELECT event_id, date_trunc('millisecond', ts) AS event_time FROM events")
def from_millis(t):
    sent = t.events.select("event_id", F.unix_millis(C.instant("ts")).cast("double").alias("event_timestamp"))
    return sent.select("event_id", C.from_millis("event_timestamp").cast(C.NTZ).alias("event_time"))


@query("f12_hour_floor", "SELECT event_id, date_trunc('hour', ts) AS hour FROM events")
def hour_floor(t):
    return t.events.select("event_id", C.trunc_ts("hour", "ts").alias("hour"))


@query("f13_concat", """SELECT coalesce(nullif(n_name, 'NATION_3'), '') || ' | ' || r_name AS skipping,
       concat(coalesce(nullif(n_name, 'NATION_3'), 'Unknown'), ' / ', r_name) AS filled
       FROM nation JOIN region ON n_regionkey = r_regionkey""")
def concat(t):
    name = F.expr("nullif(n_name, 'NATION_3')")
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        C.label(" | ", name, "r_name", missing="").alias("skipping"), C.label(" / ", name, "r_name", missing="Unknown").alias("filled"))


@query("f14_concat_ws", """SELECT concat_ws(', ', CAST(user_id AS VARCHAR), event_type, nullif(event_type, 'click')) AS message,
       count(*) AS n FROM events GROUP BY 1""")
def concat_ws(t):
    return t.events.groupBy(F.concat_ws(", ", F.col("user_id").cast("string"), "event_type", F.expr("nullif(event_type, 'click')"))
                            .alias("message")).agg(F.count("*").alias("n"))


@query("f15_split", """SELECT split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS second, count(*) AS n
       FROM part GROUP BY 1, 2""")
def split(t):
    words = F.split("p_name", " ")
    return t.part.groupBy(words.getItem(0).alias("first"), words.getItem(1).alias("second")).agg(F.count("*").alias("n"))


@query("f16_coalesce", "SELECT coalesce(payment_type, 0) AS payment_type, count(*) AS n FROM trips GROUP BY 1", "trips")
def coalesce(t):
    return t.trips.groupBy(F.coalesce("payment_type", F.lit(0)).alias("payment_type")).agg(F.count("*").alias("n"))


HASHED = ("coalesce(CAST(VendorID AS VARCHAR), '') || strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') || "
          "strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') || CAST(PULocationID AS VARCHAR) || "
          "CAST(DOLocationID AS VARCHAR)")


HASHED_ALL = (HASHED + " || coalesce(CAST(CAST(round(fare_amount * 100) AS BIGINT) AS VARCHAR), '') || "
              "coalesce(CAST(CAST(round(trip_distance * 100) AS BIGINT) AS VARCHAR), '')")


def hash_parts():
    return ["VendorID", C.ts_text(UP), C.ts_text(DOWN), "PULocationID", "DOLocationID"]


def all_hash_parts():
    """The landing form: fare and distance too, so a corrected trip is a new one."""
    return [*hash_parts(), *[F.round(F.col(c) * 100).cast("long") for c in ("fare_amount", "trip_distance")]]


@query("f17_row_hash", f"SELECT md5({HASHED_ALL}) AS unique_row_id FROM trips", "trips")
def row_hash(t):
    return t.trips.select(C.row_hash(*all_hash_parts()).alias("unique_row_id"))


@query("f18_row_hash_bytes", f"SELECT unhex(md5({HASHED})) AS unique_row_id FROM trips", "trips")
def row_hash_bytes(t):
    return t.trips.select(C.row_hash_bytes(*hash_parts()).alias("unique_row_id"))


@query("f19_surrogate_key", """SELECT md5(concat_ws('-', coalesce(CAST(VendorID AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
       strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S'), CAST(PULocationID AS VARCHAR),
       coalesce(CAST(payment_type AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS trip_id FROM trips""", "trips")
def surrogate_key(t):
    return t.trips.select(C.surrogate_key("VendorID", C.ts_text(UP), "PULocationID", "payment_type").alias("trip_id"))


@query("f20_round", "SELECT event_type, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_value FROM events GROUP BY 1")
def rounded(t):
    return t.events.groupBy("event_type").agg(F.round(C.exact_avg("value"), 2).alias("avg_value"))


@query("f21_abs_duration", f"SELECT abs(date_diff('second', {DOWN}, {UP})) AS apart, count(*) AS n FROM trips GROUP BY 1", "trips")
def abs_duration(t):
    return t.trips.groupBy(F.abs(C.second_diff(DOWN, UP)).alias("apart")).agg(F.count("*").alias("n"))


BASE_SQL = """SELECT dispatching_base_num, CASE WHEN num % 7 = 0 THEN 's/' WHEN num % 3 = 0 THEN 'a/' ELSE 'e/' END ||
    CASE WHEN length(to_hex(num)) < 3 THEN lpad(lower(to_hex(num)), 3, '0') ELSE lower(to_hex(num)) END AS base_id, n
    FROM (SELECT dispatching_base_num, CAST(substr(dispatching_base_num, 2) AS BIGINT) AS num, count(*) AS n
    FROM fhv WHERE dispatching_base_num IS NOT NULL GROUP BY 1)"""


@query("f22_base_code", BASE_SQL, "fhv")
def base_code(t):
    bases = t.fhv.filter("dispatching_base_num is not null").groupBy("dispatching_base_num").agg(F.count("*").alias("n"))
    return bases.select("dispatching_base_num", C.base_code("dispatching_base_num").alias("base_id"), "n")


@query("x01_base_code_udf", BASE_SQL, "fhv")
def base_code_udf(t):
    """The vectorised function, applied once per distinct base."""
    bases = t.fhv.filter("dispatching_base_num is not null").groupBy("dispatching_base_num").agg(F.count("*").alias("n"))
    return bases.select("dispatching_base_num", C.base_code_udf("dispatching_base_num").alias("base_id"), "n")


@query("f23_substring_number", "SELECT CAST(substr(affiliated_base_number, 2) AS BIGINT) AS number, count(*) AS n FROM fhv GROUP BY 1", "fhv")
def substring_number(t):
    return t.fhv.groupBy(F.substring("affiliated_base_number", 2, 64).cast("long").alias("number")).agg(F.count("*").alias("n"))


@query("f24_square_roots", "SELECT l_quantity, sqrt(l_quantity) AS root, count(*) AS n FROM lineitem GROUP BY 1, 2")
def square_roots(t):
    return t.lineitem.groupBy("l_quantity").agg(F.count("*").alias("n")).select("l_quantity", F.sqrt("l_quantity").alias("root"), "n")


@query("f25_from_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def from_json(t):
    return t.events.select("event_id", F.from_json("props", "k long").alias("data")).select("event_id", "data.*")


@query("f26_to_json", """SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS message FROM events""")
def to_json(t):
    return t.events.select("event_id", F.to_json(F.struct("user_id", "event_type")).alias("message"))


@query("f27_binary_to_text", "SELECT event_id, props AS value FROM events")
def binary_to_text(t):
    raw = t.events.select("event_id", F.col("props").cast("binary").alias("value"))
    return raw.select("event_id", F.col("value").cast("string").alias("value"))


@query("f28_flatten", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS time__pickup, o_orderstatus AS payment__status,
       o_totalprice AS payment__amount__total FROM orders""")
def flatten(t):
    docs = t.orders.select(
        "o_orderkey", F.struct(F.to_date("o_orderdate").alias("pickup")).alias("time"),
        F.struct(F.col("o_orderstatus").alias("status"),
                 F.struct(F.col("o_totalprice").alias("total")).alias("amount")).alias("payment"))
    return nested.flatten(docs)


@query("f29_list_to_rows", """SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS list_idx,
       unnest(embedding) AS value FROM embeddings""")
def list_to_rows(t):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("list_idx", "value"))


@query("f30_linear_formula", "SELECT trip_distance, trip_distance * 5 AS predicted_duration, count(*) AS n FROM trips GROUP BY 1, 2", "trips")
def linear_formula(t):
    return t.trips.groupBy("trip_distance", (F.col("trip_distance") * 5).alias("predicted_duration")).agg(F.count("*").alias("n"))


@query("f31_case_bucket", """SELECT CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS bucket,
       count(*) AS n FROM part GROUP BY 1""")
def case_bucket(t):
    return t.part.groupBy(C.bucket("p_size", [10, 30], ["small", "medium", "large"]).alias("bucket")).agg(F.count("*").alias("n"))


@query("f32_source_file", "SELECT 'events.parquet' AS filename, count(*) AS n FROM events")
def source_file(t):
    """The table's name in the path; a table of many files has one folder of that name."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.parquet)(/|$)", 1)
    return t.events.select(folder.alias("filename")).groupBy("filename").agg(F.count("*").alias("n"))


@query("f33_file_month", "SELECT concat('yellow_tripdata_', strftime(tpep_pickup_datetime, '%Y-%m'), '.csv') AS file, count(*) AS n FROM trips GROUP BY 1", "trips")
def file_month(t):
    return t.trips.groupBy(F.concat(F.lit("yellow_tripdata_"), F.date_format(UP, "yyyy-MM"), F.lit(".csv")).alias("file")
                           ).agg(F.count("*").alias("n"))


@query("x02_batch_scoring", "SELECT VendorID, PULocationID, DOLocationID, trip_distance, trip_distance * 5 AS predicted_duration FROM trips", "trips")
def batch_scoring(t):
    """A model applied to Arrow batches of each partition."""
    def score(batches):
        for pdf in batches:
            yield pdf.assign(predicted_duration=pdf["trip_distance"] * 5)

    rows = t.trips.select("VendorID", "PULocationID", "DOLocationID", "trip_distance")
    return rows.mapInPandas(score, "VendorID int, PULocationID int, DOLocationID int, trip_distance double, predicted_duration double")


@query("x05_duration_function", f"SELECT VendorID, sum(date_diff('minute', {UP}, {DOWN}))::BIGINT AS minutes FROM trips GROUP BY 1", "trips")
def duration_function(t):
    return t.trips.groupBy("VendorID").agg(F.sum(C.minute_diff(UP, DOWN)).alias("minutes"))


@query("x06_table_function", """SELECT payment_type_description, count(*) AS n FROM trips JOIN payments
       ON coalesce(payment_type, 0) = payment_type_code GROUP BY 1""", "trips payments")
def table_function(t):
    counts = t.trips.groupBy(F.coalesce("payment_type", F.lit(0)).alias("code")).agg(F.count("*").alias("n"))
    names = staging.payment_types(t.spark)
    return counts.join(names, F.col("code") == F.col("payment_type_code")).groupBy("payment_type_description").agg(F.sum("n").alias("n"))
