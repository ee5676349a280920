"""T (and the streaming forms of J, K, L, P, U, W): the events table replayed as a stream.

A replay runs until the input is used up. Results that only complete mode can show are
compared with the batch answer; append-mode results leave out the windows still open at the
end, so those queries close the input with the watermark and compare what was emitted.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators.dedup import top_k
from ..operators.joins import hot_keys
from ..schemas import ddl
from ..sources import messages
from ..streaming import joins, replay, sinks, windows
from .joins import NEAR, ride_streams
from .registry import query


def zone_free(df):
    return df.withColumns({f.name: F.col(f.name).cast(C.NTZ) for f in df.schema if f.dataType.typeName() == "timestamp"})


def complete(t, df):
    return zone_free(sinks.newest_result(df, t.scratch("complete")))


def topic(t, columns, key=None, rows=None):
    """The events as JSON messages in files, read as a stream of (key, value)."""
    path = t.scratch("topic")
    messages.as_json(rows if rows is not None else t.events, columns, key).write.parquet(path)
    return messages.file_stream(t.spark, path, ddl("key binary, value binary"))


def buckets(width: str, keys: str, source: str = "events") -> str:
    return (f"SELECT time_bucket(INTERVAL '{width}', ts) AS window_start, time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}'"
            f" AS window_end, {keys}, count(*) AS count FROM {source} GROUP BY ALL")


def until_watermark(sql: str, delay: str) -> str:
    """The windows that are closed once the watermark has seen all events."""
    return f"SELECT * FROM ({sql}) WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '{delay}' FROM events)"


def closed(t, df):
    """Append mode: each window is written once, when the watermark has passed its end, and its state goes."""
    return zone_free(sinks.to_table(df, t.scratch("closed")))


@query("t01_watermarked", "SELECT event_type, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1")
def watermarked(t):
    timed = windows.event_time(t.stream("events"), "ts", "15 seconds")
    stored = sinks.to_table(timed.select("event_type", "ts"), t.scratch("out"))
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("ts").cast(C.NTZ).alias("last_ts"))


@query("t02_tumbling_minute", until_watermark(buckets("1 minute", "event_type"), "1 second"))
def tumbling_minute(t):
    return closed(t, windows.tumbling(t.stream("events"), "ts", "1 minute", ["event_type"], "1 second"))


@query("t03_tumbling_update", buckets("10 seconds", "user_id"))
def tumbling_update(t):
    out = windows.tumbling(t.stream("events"), "ts", "10 seconds", ["user_id"], "5 seconds")
    return zone_free(sinks.upserted(out, t.scratch("out"), ["window_start", "user_id"], F.to_date("window_start")))


@query("t04_tumbling_expiry", until_watermark(buckets("1 minute", "user_id"), "1 hour"))
def tumbling_expiry(t):
    return closed(t, windows.tumbling(t.stream("events"), "ts", "1 minute", ["user_id"], "1 hour"))


@query("t05_sliding", """SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, user_id, count(*) AS count FROM (
       SELECT user_id, unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE])
       AS window_start FROM events) GROUP BY ALL""")
def sliding(t):
    return complete(t, windows.sliding(t.stream("events"), "ts", "10 minutes", "5 minutes", ["user_id"], "10 minutes"))


def islands(key: str, gap: str) -> str:
    return f"""WITH gaps AS (SELECT {key}, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL {gap} OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END
        AS fresh FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts)),
        runs AS (SELECT *, sum(fresh) OVER (PARTITION BY {key} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM gaps)
        SELECT min(ts) AS window_start, max(ts) + INTERVAL {gap} AS window_end, {key}, count(*) AS count
        FROM runs GROUP BY {key}, run"""


@query("t06_session_minute", until_watermark(islands("event_type", "60 SECOND"), "60 seconds"))
def session_minute(t):
    return closed(t, windows.sessions(t.stream("events"), "ts", "60 seconds", ["event_type"], "60 seconds"))


@query("t07_longest_session", f"SELECT * FROM ({until_watermark(islands('user_id', '5 MINUTE'), '5 seconds')}) ORDER BY count DESC, window_start, user_id LIMIT 3")
def longest_session(t):
    out = closed(t, windows.sessions(t.stream("events"), "ts", "5 minutes", ["user_id"], "5 seconds"))
    return top_k(out, ["-count", "window_start", "user_id"], 3)


@query("t08_arrival_popularity", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def arrival_popularity(t):
    """Windows depend on the clock; their counts per key add up to the table's."""
    out = complete(t, windows.arrival_windows(t.stream("events"), "5 minutes", ["event_type"]))
    return out.groupBy("event_type").agg(F.sum("count").alias("count"))


@query("t09_running_count", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def running_count(t):
    return sinks.upserted(windows.running_count(t.stream("events"), ["event_type"]), t.scratch("out"), ["event_type"])


@query("t10_filtered_count", "SELECT event_type, count(*) AS count FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1")
def filtered_count(t):
    out = windows.running_count(t.stream("events"), ["event_type"], F.col("event_type").isin("click", "purchase"))
    return sinks.upserted(out, t.scratch("out"), ["event_type"])


@query("t11_rekeyed", "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1")
def rekeyed(t):
    stored = sinks.to_table(joins.rekey(t.stream("events"), "key", "user_id").select("key"), t.scratch("out"))
    return stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


#: Parts that the state of a hot key's time bucket is split into; each of its pickups is kept as many times.
SALTS = 4


def near_stream(t):
    """Keys that are hot among the rides known so far are split."""
    rides, pickups = ride_streams(t.stream("events"))
    hot = hot_keys(ride_streams(t.events)[0], "key")
    return zone_free(sinks.to_table(joins.dropoffs_near_pickups(rides, pickups, salts=SALTS, hot=hot), t.scratch("out")))


@query("j14_stream_join", NEAR)
def stream_join(t):
    return near_stream(t)


@query("t12_join_filter_map", f"SELECT location_id, count(*) AS n, max(pickup_time) AS last_pickup FROM ({NEAR}) GROUP BY 1")
def join_filter_map(t):
    return near_stream(t).groupBy("location_id").agg(F.count(F.lit(1)).alias("n"), F.max("pickup_time").alias("last_pickup"))


@query("t13_branches", "SELECT CASE WHEN value >= 40 THEN 'high' ELSE 'low' END AS branch, count(*) AS n FROM events GROUP BY 1")
def branches(t):
    high, low = sinks.branched(t.stream("events").select("event_id", "value"), F.col("value") >= 40, t.scratch("out"))
    tag = lambda df, name: df.groupBy(F.lit(name).alias("branch")).agg(F.count(F.lit(1)).alias("n"))
    return tag(high, "high").unionAll(tag(low, "low"))


@query("t14_text_messages", """SELECT event_id, date_trunc('second', ts) AS ts, event_type, CAST(value AS FLOAT) AS value FROM events""")
def text_messages(t):
    path = t.scratch("topic")
    messages.as_text(t.events, ["event_id", "ts", "event_type", "value"], "user_id").write.parquet(path)
    stream = messages.file_stream(t.spark, path, ddl("key binary, value binary"))
    parsed = messages.parse_text(stream, ddl("event_id long, ts timestamp, event_type string, value float"))
    return zone_free(sinks.to_table(parsed, t.scratch("out")))


@query("t15_json_messages", "SELECT event_id, user_id, event_type, value FROM events")
def json_messages(t):
    columns = ["event_id", "user_id", "event_type", "value"]
    parsed = messages.parse_json(topic(t, columns), t.events.select(*columns).schema)
    return sinks.to_table(parsed, t.scratch("out"))


@query("t16_output_modes", """SELECT mode, event_type, count(*) AS count FROM events, (VALUES ('complete'), ('update')) m(mode) GROUP BY 1, 2""")
def output_modes(t):
    counts = lambda: windows.running_count(t.stream("events"), ["event_type"])
    full = sinks.newest_result(counts(), t.scratch("complete")).withColumn("mode", F.lit("complete"))
    changed = sinks.upserted(counts(), t.scratch("update"), ["event_type"]).withColumn("mode", F.lit("update"))
    return full.unionByName(changed)


@query("t16_append_closed_windows", """WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS count FROM events GROUP BY 1)
       SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count FROM w
       WHERE window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events)""")
def append_closed(t):
    """Append mode emits a window once the watermark has passed its end."""
    return zone_free(sinks.to_table(windows.tumbling(t.stream("events"), "ts", "1 hour", [], "0 seconds"), t.scratch("out")))


@query("t17_checkpointed", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def checkpointed(t):
    """A restart from the checkpoint reads nothing twice."""
    out, checkpoint = t.scratch("out"), t.scratch("checkpoint")
    for _ in range(2):
        sinks.finish(sinks.start(t.stream("events").select("event_id"), "parquet", path=out, checkpoint=checkpoint))
    return t.spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("t18_grace", until_watermark(buckets("5 minutes", "event_type"), "5 minutes"))
def grace(t):
    """Grace is the watermark's delay: the window's state stays that long for late rows."""
    return closed(t,windows.tumbling(t.stream("events"), "ts", "5 minutes", ["event_type"], "5 minutes"))


#: The events in so many batches by time; every so-manieth row comes so many batches late.
BATCHES, LATE_EVERY, LATE_BY = 6, 11, 2


def replayed(t):
    rows = replay.by_time(t.events, "ts", BATCHES, F.col("event_id") % LATE_EVERY == 0, LATE_BY)
    return replay.in_batches(rows, BATCHES, t.scratch("replay"), "event_id")


def in_time(window_end: str, delay: str) -> str:
    """Tables ``r`` (events with their batch) and ``kept``: rows whose window was open by the watermark.

    A batch drops what is older than the watermark that the batch before it worked with, and this one knew
    the times of the batches before.
    """
    return f"""r AS (SELECT *, CASE WHEN event_id % {LATE_EVERY} = 0 THEN least(span + {LATE_BY}, {BATCHES - 1}) ELSE span END AS batch FROM (
       SELECT e.*, (epoch_ms(ts) - lo) * {BATCHES} // (hi - lo + 1) AS span
       FROM events e, (SELECT min(epoch_ms(ts)) AS lo, max(epoch_ms(ts)) AS hi FROM events))),
       marks AS (SELECT n, date_trunc('millisecond', max(ts)) - INTERVAL '{delay}' AS mark FROM r, range({BATCHES}) b(n) WHERE batch <= n - 2 GROUP BY n),
       kept AS (SELECT r.* FROM r LEFT JOIN marks ON n = batch WHERE mark IS NULL OR {window_end} > mark)"""


def late_windows(width: str, keys: str, delay: str) -> str:
    rows = in_time(f"time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}'", delay)
    return f"WITH {rows} {until_watermark(buckets(width, keys, 'kept'), delay)}"


@query("t01_late_rows", late_windows("10 seconds", "event_type", "15 seconds"))
def late_after_watermark(t):
    """Rows that come after their window's end has passed the watermark are dropped."""
    return closed(t, windows.tumbling(replayed(t), "ts", "10 seconds", ["event_type"], "15 seconds"))


@query("t02_late_rows", late_windows("1 minute", "event_type", "1 second"))
def late_minutes(t):
    return closed(t, windows.tumbling(replayed(t), "ts", "1 minute", ["event_type"], "1 second"))


@query("t04_late_rows", late_windows("1 minute", "user_id", "1 hour"))
def late_within_expiry(t):
    return closed(t, windows.tumbling(replayed(t), "ts", "1 minute", ["user_id"], "1 hour"))


@query("t06_late_rows", f"""WITH {in_time("ts + INTERVAL '60 seconds'", '60 seconds')}
       {until_watermark(islands('event_type', '60 SECOND').replace('FROM events', 'FROM kept'), '60 seconds')}""")
def late_for_session(t):
    return closed(t, windows.sessions(replayed(t), "ts", "60 seconds", ["event_type"], "60 seconds"))


@query("t18_late_rows", late_windows("5 minutes", "event_type", "5 minutes"))
def late_beyond_grace(t):
    """Within the grace a late row still counts, beyond it the row is dropped."""
    return closed(t, windows.tumbling(replayed(t), "ts", "5 minutes", ["event_type"], "5 minutes"))


POPULAR = "SELECT user_id, count(*) AS count FROM (SELECT user_id FROM events UNION ALL SELECT user_id FROM events WHERE event_type = 'view') GROUP BY 1"


@query("t19_merged_popularity", POPULAR)
def merged_popularity(t):
    first = t.stream("events").select("user_id")
    second = t.stream("events").filter("event_type = 'view'").select("user_id")
    return complete(t, windows.most_popular(first.unionByName(second), ["user_id"]))


@query("u05_stream_union", "SELECT event_type, count(*) AS n FROM (SELECT event_type FROM events UNION ALL SELECT event_type FROM events) GROUP BY 1")
def stream_union(t):
    one = t.stream("events").select("event_id", "event_type")
    stored = sinks.to_table(one.unionByName(t.stream("events").select("event_id", "event_type")), t.scratch("out"))
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("t20_validated_records", """SELECT event_type <> 'error' AS valid, count(*) AS n FROM events GROUP BY 1""")
def validated_records(t):
    """Errors carry text where a number belongs; they go to quarantine."""
    body = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    rows = t.events.select(F.col("user_id").cast("string").alias("vendorId"), body.alias("total_amount"))
    parsed = messages.parse_json_strings(topic(t, ["vendorId", "total_amount"], rows=rows), ddl("vendorId string, total_amount float"))
    good, bad = sinks.branched(parsed, F.col("total_amount").isNotNull(), t.scratch("out"))
    tag = lambda df, flag: df.groupBy(F.lit(flag).alias("valid")).agg(F.count(F.lit(1)).alias("n"))
    return tag(good, True).unionAll(tag(bad, False))


@query("t21_latest_rows", "SELECT event_id, ts, event_type FROM events WHERE ts = (SELECT max(ts) FROM events)")
def latest_rows(t):
    return zone_free(sinks.latest_rows(t.stream("events").select("event_id", "ts", "event_type"), "ts", t.scratch("out")))


@query("t22_query_handle", "SELECT event_type, false AS active, count(*) AS n FROM events GROUP BY 1")
def query_handle(t):
    out = t.scratch("out")
    handle = sinks.start(t.stream("events").select("event_type"), "parquet", path=out, trigger={"processingTime": "1 second"})
    handle.processAllAvailable()
    sinks.status(handle)
    handle.stop()
    return t.spark.read.parquet(out).groupBy("event_type", F.lit(handle.isActive).alias("active")).agg(F.count(F.lit(1)).alias("n"))


@query("p27_stream_projection", "SELECT event_id, user_id, value * 2 AS doubled FROM events WHERE event_type = 'click'")
def stream_projection(t):
    out = t.stream("events").filter("event_type = 'click'").select("event_id", "user_id", (F.col("value") * 2).alias("doubled"))
    return sinks.to_table(out, t.scratch("out"))


@query("l08_sorted_stream", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def sorted_stream(t):
    return complete(t, windows.most_popular(t.stream("events"), ["event_type"]))


@query("s18_topic_source", "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1")
def topic_source(t):
    """The (key, value) rows of a topic from files; the Kafka reader gives the same columns."""
    raw = topic(t, ["event_id", "value"], "user_id")
    stored = sinks.to_table(raw.select(F.col("key").cast("string").alias("key")), t.scratch("out"))
    return stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("s20_event_time_table", "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS count FROM events GROUP BY ALL")
def event_time_table(t):
    rows = t.events.select(F.col("user_id").alias("test_data"), F.unix_millis(C.instant("ts")).cast("double").alias("event_timestamp"))
    parsed = messages.parse_json(topic(t, ["test_data", "event_timestamp"], rows=rows), ddl("test_data long, event_timestamp double"))
    timed = parsed.withColumn("event_watermark", C.from_millis("event_timestamp"))
    return complete(t, windows.tumbling(timed, "event_watermark", "1 hour", [], "1 second"))


@query("k13_console", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def console_sink(t):
    """The console sink runs until the events are printed; the same counts come back as a table."""
    printed = sinks.console(windows.running_count(t.stream("events"), ["event_type"]), interval="1 second")
    printed.processAllAvailable()
    printed.stop()
    return sinks.newest_result(windows.running_count(t.stream("events"), ["event_type"]), t.scratch("out"))


@query("k14_memory", "SELECT event_type, count FROM (SELECT event_type, count(*) AS count FROM events GROUP BY 1)")
def memory_sink(t):
    """One row per event type reaches the driver."""
    name = "fareflow_" + t.scratch("m").rsplit("-", 1)[1]
    sinks.to_memory(windows.running_count(t.stream("events"), ["event_type"]), name)
    return t.spark.sql(f"SELECT event_type, count FROM {name}")


@query("k16_topic_sink", "SELECT event_type AS key, count(*) AS n FROM events GROUP BY 1")
def topic_sink(t):
    """Messages stream to files in the sink's layout, with a checkpoint."""
    out = messages.as_text(t.stream("events"), ["event_id", "ts", "value"], "event_type")
    stored = sinks.to_table(out, t.scratch("out"))
    return stored.groupBy(F.col("key").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("k17_batch_function", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def batch_function(t):
    return sinks.append_batches(t.stream("events").select("event_id", "event_type"), t.scratch("out")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("x07_micro_batch", "SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1")
def micro_batch(t):
    """A function sees each micro-batch as a table: partial sums per batch, added up at the end."""
    table = sinks.Batches(t.spark, t.scratch("out"), T.StructType([
        T.StructField("event_type", T.StringType()), T.StructField("part", T.DecimalType(28, 2))]))

    def totals(batch, number):
        table.write(batch.groupBy("event_type").agg(F.sum(F.col("value").cast(C.MONEY)).alias("part")), number)

    sinks.finish(sinks.for_each_batch(t.stream("events").select("event_type", "value"), totals))
    return table.read().groupBy("event_type").agg(F.sum("part").cast("double").alias("total"))


@query("k18_append_stream", "SELECT user_id AS test_data, date_trunc('millisecond', ts) AS event_timestamp FROM events")
def append_stream(t):
    rows = t.events.select(F.col("user_id").alias("test_data"), F.unix_millis(C.instant("ts")).cast("double").alias("event_timestamp"))
    parsed = messages.parse_json(topic(t, ["test_data", "event_timestamp"], rows=rows), ddl("test_data long, event_timestamp double"))
    timed = parsed.select("test_data", C.from_millis("event_timestamp").alias("event_timestamp"))
    return zone_free(sinks.append_batches(timed, t.scratch("out")))


@query("k19_upsert_stream", "SELECT date_trunc('minute', ts) AS event_hour, user_id AS test_data, count(*) AS num_hits FROM events GROUP BY 1, 2")
def upsert_stream(t):
    out = windows.tumbling(t.stream("events"), "ts", "1 minute", ["user_id"], "1 second")
    out = out.select(F.col("window_start").alias("event_hour"), F.col("user_id").alias("test_data"), F.col("count").alias("num_hits"))
    return zone_free(sinks.upserted(out, t.scratch("out"), ["event_hour", "test_data"], F.to_date("event_hour")))


@query("k21_maintained_view", "SELECT event_type, max(ts) AS latest, count(*) AS n FROM events GROUP BY 1")
def maintained_view(t):
    view = t.stream("events").groupBy("event_type").agg(F.max("ts").alias("latest"), F.count(F.lit(1)).alias("n"))
    return sinks.upserted(view, t.scratch("out"), ["event_type"])


@query("x03_row_functions", "SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM events WHERE value >= 5 GROUP BY 1")
def row_functions(t):
    """Filter, map to pairs, reduce by key, as column expressions."""
    pairs = t.events.filter(F.col("value") >= 5).select("event_type", F.struct(F.col("value").cast(C.MONEY).alias("amount"), F.lit(1).cast("long").alias("one")).alias("pair"))
    return pairs.groupBy("event_type").agg(F.sum("pair.amount").cast("double").alias("total"), F.sum("pair.one").alias("n"))


@query("x04_optional_joiner", f"SELECT vendor_id, location_id, count(*) AS n FROM ({NEAR}) GROUP BY 1, 2")
def optional_joiner(t):
    """The joined value is a struct or NULL; NULLs are filtered out and the struct is unpacked."""
    from ..operators.joins import near_in_time
    rides, pickups = ride_streams(t.events)
    pairs = near_in_time(rides, pickups, "key", "dropoff_datetime", "pickup_datetime", 20 * 60)
    micros = lambda c: F.unix_micros(C.instant(c))
    apart = F.floor(F.abs(micros("pickup_datetime") - micros("dropoff_datetime")) / 60_000_000)
    found = F.when(apart <= 10, F.struct("vendor_id", "location_id"))
    return pairs.select(found.alias("info")).filter("info is not null").select("info.*").groupBy("vendor_id", "location_id").agg(F.count(F.lit(1)).alias("n"))
