"""Streaming behaviour over several micro-batches: changelogs, late rows, joins, sinks, messages."""

import datetime

import pytest
from pyspark.sql import functions as F

from fareflow.operators.joins import hot_keys
from fareflow.schemas import RIDE_TEXT, ddl
from fareflow.session import fresh_path
from fareflow.sources import messages, readers, writers
from fareflow.streaming import joins, replay as sinks_replay, sinks, state, windows

T0 = datetime.datetime(2024, 1, 1, 12, 0, 0)


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


def replay(spark, batches, schema):
    """A stream that gets one file, and so one micro-batch, per list of rows."""
    path = fresh_path(spark, "replay")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return messages.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)


def test_changelog_same_key_counts_one_then_two(spark):
    stream = replay(spark, [[("75",)], [("75",)]], "key string")
    log = sinks.changelog(windows.running_count(stream, ["key"]), fresh_path(spark, "log"))
    assert [r["count"] for r in log.orderBy("batch").collect()] == [1, 2]


def test_changelog_different_keys(spark):
    stream = replay(spark, [[("75",)], [("100",)]], "key string")
    log = sinks.changelog(windows.running_count(stream, ["key"]), fresh_path(spark, "log"))
    assert sorted((r["key"], r["count"]) for r in log.collect()) == [("100", 1), ("75", 1)]


def test_upsert_keeps_newest(spark):
    stream = replay(spark, [[("a",), ("b",)], [("a",)], [("a",)]], "key string")
    out = sinks.upserted(windows.running_count(stream, ["key"]), fresh_path(spark, "t"), ["key"])
    assert {(r["key"], r["count"]) for r in out.collect()} == {("a", 3), ("b", 1)}


def test_upserts_rewrite_touched_partitions_only(spark):
    """Batches that change recent windows leave the files of earlier days as they are."""
    day = 86400
    stream = replay(spark, [[(at(0), "a"), (at(60), "b")], [(at(day), "a")], [(at(day + 1), "a"), (at(2 * day), "b")]], "ts timestamp, k string")
    path = fresh_path(spark, "t")
    counts = windows.tumbling(stream, "ts", "1 minute", ["k"], "3 days")
    out = sinks.upserted(counts, path, ["window_start", "k"], F.to_date("window_start"))
    names = out.select("*", "_metadata.file_path", "_metadata.file_modification_time").collect()
    first = {r["file_modification_time"] for r in names if r["window_start"] < at(day) - datetime.timedelta(hours=12)}
    last = {r["file_modification_time"] for r in names if r["window_start"] >= at(day) - datetime.timedelta(hours=12)}
    assert max(first) < min(last)
    assert {(r["window_start"], r["k"]): r["count"] for r in names} == {(at(0), "a"): 1, (at(60), "b"): 1, (at(day), "a"): 2, (at(2 * day), "b"): 1}


def test_many_small_upserts_give_the_newest_rows(spark):
    stream = replay(spark, [[(k,), ("a",)] for k in "abcabcd"], "key string")
    out = sinks.upserted(windows.running_count(stream, ["key"]), fresh_path(spark, "t"), ["key"])
    assert {(r["key"], r["count"]) for r in out.collect()} == {("a", 9), ("b", 2), ("c", 2), ("d", 1)}


def test_batches_are_written_without_a_look_at_others(spark, monkeypatch):
    stream = replay(spark, [[(i,)] for i in range(6)], "n int")
    with monkeypatch.context() as m:
        m.setattr(sinks.loads.Target, "read", lambda *a: pytest.fail("a batch read the table"))
        with pytest.raises(pytest.fail.Exception):  # only the caller reads, at the end
            sinks.append_batches(stream, path := fresh_path(spark, "b"))
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == list(range(6))


def test_a_retried_batch_is_written_once(spark):
    table = sinks.Batches(spark, fresh_path(spark, "b"), spark.range(1).schema)
    for n, rows in ((0, 3), (1, 5), (1, 5)):
        table.write(spark.range(rows), n)
    assert table.read().groupBy("batch").count().orderBy("batch").collect() == [(0, 3), (1, 5)]


def test_running_maximum_is_state_and_goes_after_its_time(spark, monkeypatch):
    """No batch reads an earlier result; each part of the stream keeps one number, which expires."""
    batches = [[(i, at(i)) for i in range(40)], [(100, at(39)), (101, at(3))], [(102, at(50))]]
    stream = replay(spark, batches, "id int, ts timestamp")
    query = sinks.start(state.newest(stream, "ts"), "parquet", "append", path=(path := fresh_path(spark, "n")))
    sinks.finish(query)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 1 < max(kept) <= state.PARTS
    given = spark.read.parquet(path)
    assert given.filter("id = 102").count() == 1 and given.count() < 40
    later = replay(spark, [*batches, [(103, at(4000))], [(104, at(4001))], [(105, at(60))]], "id int, ts timestamp")
    query = sinks.start(state.newest(later, "ts"), "parquet", "append", path=(path := fresh_path(spark, "n")))
    sinks.finish(query)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept[-1] <= 2 < max(kept)  # the parts an hour behind are gone
    assert {r["id"] for r in spark.read.parquet(path).filter("id > 102").collect()} <= {103, 104}


def test_closed_windows_leave_no_state(spark):
    """In append mode a late row is left out, and state rows go once the watermark has passed."""
    batches = [[(at(i), "k%d" % i) for i in range(10)], [(at(1000), "k")], [(at(1001), "k")], [(at(3), "late")]]
    stream = replay(spark, batches, "ts timestamp, k string")
    path = fresh_path(spark, "closed")
    query = sinks.start(windows.tumbling(stream, "ts", "10 seconds", ["k"], "5 seconds"), "parquet", "append", path=path)
    sinks.finish(query)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) >= 10 and kept[-1] == 1
    got = spark.read.parquet(path).collect()
    assert {r["k"] for r in got} == {"k%d" % i for i in range(10)} and all(r["count"] == 1 for r in got)
    assert sinks.await_any(spark, 60)


def test_late_rows_are_dropped_after_grace(spark):
    batches = [[(at(0), "k")], [(at(100), "k")], [(at(101), "k")], [(at(1), "k")], [(at(99), "k")]]
    stream = replay(spark, batches, "ts timestamp, k string")
    out = sinks.upserted(windows.tumbling(stream, "ts", "10 seconds", ["k"], "5 seconds"),
                         fresh_path(spark, "late"), ["window_start", "k"])
    counts = {r["window_start"]: r["count"] for r in out.collect()}
    assert counts[at(0)] == 1      # the row at second 1 came after its window was closed
    assert counts[at(100)] == 2
    assert counts[at(90)] == 1     # second 99 is late, but its window was still within grace


def test_replay_keeps_batches_apart_and_drops_what_is_late(spark):
    rows = spark.createDataFrame([(i, at(100 * i)) for i in range(120)], "event_id int, ts timestamp")
    timed = sinks_replay.by_time(rows, "ts", 6, F.col("event_id") % 11 == 0, 2)
    batches = {r["event_id"]: r["_batch"] for r in timed.collect()}
    assert batches == {i: min(i // 20 + 2, 5) if i % 11 == 0 else i // 20 for i in range(120)}
    stream = sinks_replay.in_batches(timed, 6, fresh_path(spark, "replay"), "event_id")
    query = sinks.start(windows.tumbling(stream, "ts", "100 seconds", [], "10 seconds"), "parquet", path=(path := fresh_path(spark, "late")))
    sinks.finish(query)
    counts = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert counts == [sum(b == n for b in batches.values()) for n in range(6)]
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
    late = {i for i, b in batches.items() if b >= 2 and 100 * i + 100 <= 100 * max(j for j, c in batches.items() if c <= b - 2) - 10}
    kept = {int((r["window_start"] - T0).total_seconds()) // 100 for r in spark.read.parquet(path).collect()}
    assert dropped == len(late) > 3 and not kept & late


@pytest.mark.parametrize("salts, hot", [(1, None), (3, None), (3, []), (3, ["75"]), (3, ["76"])])
def test_join_matches_one_pair(spark, salts, hot):
    rides = replay(spark, [[("75", "1", at(0))]], "key string, vendor_id string, dropoff_datetime timestamp")
    pickups = replay(spark, [[("75", 75, at(120)), ("76", 76, at(0)), ("75", 75, at(11 * 60)), ("75", 75, at(10 * 60 + 59))]],
                     "key string, location_id long, pickup_datetime timestamp")
    out = sinks.to_table(joins.dropoffs_near_pickups(rides, pickups, salts=salts, hot=hot), fresh_path(spark, "join"))
    assert sorted((r["vendor_id"], r["location_id"], r["pickup_time"]) for r in out.collect()) == [
        ("1", 75, at(120)), ("1", 75, at(10 * 60 + 59))]  # 11:00 apart is more than ten whole minutes


def test_only_hot_keys_are_copied(spark):
    rows = spark.createDataFrame([("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i}", i) for i in range(300)], "key string, i int")
    assert hot_keys(rows, "key", 0.05) == ["hot"] and hot_keys(rows.limit(0), "key") == []
    times = rows.select("key", F.lit("v").alias("vendor_id"), F.lit(1).cast("long").alias("location_id"), F.lit(at(0)).alias("dropoff_datetime"),
                        F.lit(at(0)).alias("pickup_datetime"))
    plan = lambda hot: joins.dropoffs_near_pickups(times, times, salts=4, hot=hot)
    assert sorted(map(tuple, plan(["hot"]).collect())) == sorted(map(tuple, plan(None).collect())) == sorted(map(tuple, plan([]).collect()))


def test_stream_equals_batch_over_many_batches(spark):
    rows = [[(at(37 * i * (j + 1) % 5000), "k%d" % (i % 3)) for i in range(40)] for j in range(4)]
    stream = replay(spark, rows, "ts timestamp, k string")
    got = sinks.newest_result(windows.sliding(stream, "ts", "10 minutes", "5 minutes", ["k"], "2 hours"), fresh_path(spark, "s"))
    flat = spark.createDataFrame([r for b in rows for r in b], "ts timestamp, k string")
    want = windows.sliding(flat, "ts", "10 minutes", "5 minutes", ["k"], "2 hours")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_latest_rows_across_batches(spark):
    stream = replay(spark, [[(1, at(5)), (2, at(9))], [(3, at(9))], [(4, at(2))]], "id int, ts timestamp")
    assert {r["id"] for r in sinks.latest_rows(stream, "ts", fresh_path(spark, "l")).collect()} == {2, 3}


def test_branches(spark):
    stream = replay(spark, [[(39.0,), (40.0,)], [(None,), (55.0,)]], "amount double")
    high, low = sinks.branched(stream, F.col("amount") >= 40, fresh_path(spark, "b"))
    assert high.count() == 2 and low.count() == 2


def test_console_memory_and_handles(spark):
    stream = replay(spark, [[("a",)]], "key string")
    query = sinks.console(windows.running_count(stream, ["key"]), interval="1 second")
    query.processAllAvailable()
    assert sinks.status(query)["active"]
    assert len(sinks.stop_all(spark)) == 1 and not query.isActive
    assert sinks.to_memory(windows.running_count(stream, ["key"]), "test_counts").collect()[0]["count"] == 1


def test_text_message_round_trip(spark):
    rows = spark.createDataFrame([(1, at(0), at(60), 2, 1.5, None, 9.3)], RIDE_TEXT)
    sent = messages.as_text(rows, rows.columns, "vendor_id")
    assert sent.select(F.col("value").cast("string")).first()[0].startswith("1, 2024-01-01 12:00:00, ")
    back = messages.parse_text(sent, RIDE_TEXT).first()
    assert back["vendor_id"] == 1 and back["tpep_dropoff_datetime"] == at(60) and back["payment_type"] is None


def test_window_column_keeps_its_start_and_key_may_be_missing(spark):
    df = spark.createDataFrame([(at(0), 1)], "ts timestamp, v int").groupBy(F.window("ts", "1 minute"), "v").count()
    out = messages.as_text(df, ["window", "v", "count"]).select("key", F.col("value").cast("string").alias("value")).first()
    assert out["key"] is None and out["value"] == "2024-01-01 12:00:00, 1, 1"


def test_json_forms(spark):
    schema = ddl("pickup timestamp, amount float, name string")
    docs = ['{"pickup":["2024-01-01 12:00:00"],"amount":"9.5","name":"x"}', '{"pickup":"2024-01-01 12:00:00","amount":"oops"}']
    df = spark.createDataFrame([(d.encode(),) for d in docs], "value binary")
    out = messages.parse_json_strings(df, schema).collect()
    assert [r["pickup"] for r in out] == [T0, T0] and [r["amount"] for r in out] == [9.5, None]
    good, bad = messages.valid_records(messages.parse_json_strings(df, schema), ["amount"])
    assert good.count() == 1 and bad.count() == 1


def test_missing_connectors_are_named(spark):
    with pytest.raises(writers.MissingConnector):
        messages.topic_stream(spark, messages.topic_options("localhost:1", "rides"))
    with pytest.raises(writers.MissingConnector):
        writers.save_external(spark.range(1), "no_such_warehouse", table="x.y")
    options = messages.topic_options("b:9092", ["a", "b"], username="u", password="p", fail_on_data_loss=False)
    assert options["subscribe"] == "a,b" and options["failOnDataLoss"] == "false" and "PLAIN" in options["kafka.sasl.mechanism"]


def test_format_detection():
    assert readers.detect_format("x/yellow_2021-01.csv.gz") == "csv" == readers.detect_format("a.CSV")
    assert readers.detect_format("https://host/t.parquet") == "parquet"
    with pytest.raises(readers.UnknownFormat):
        readers.detect_format("trips.xlsx")


def test_month_paths():
    paths = readers.month_paths("r/", "green", [2019, 2020], [12])
    assert paths == ["r/green/year=2019/month=12/*.csv.gz", "r/green/year=2020/month=12/*.csv.gz"]


def test_json_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"brand": "A", "price": 1.5},\n{"brand": "B", "price": 2}\n]')
    assert readers.json_array(spark, str(tmp_path / "a.json")).count() == 2
    (tmp_path / "p.json").write_text('{"products": [{"brand": "A"},\n {"brand": "B"}, {"brand": "C"}]}')
    assert readers.json_array(spark, str(tmp_path / "p.json"), "products").count() == 3


def test_pages_stop_at_the_first_empty_one(spark):
    path = fresh_path(spark, "pages")
    rows = [(i, 1 + i // 2) for i in range(6)] + [(99, 5)]  # pages 1..3, then a gap, then 5
    spark.createDataFrame(rows, "id long, page long").write.json(path)
    out = readers.read_pages(spark, path, ddl("id long"))
    assert sorted(r["id"] for r in out.collect()) == list(range(6))
    empty = fresh_path(spark, "pages")
    spark.createDataFrame([(9, 2)], "id long, page long").write.json(empty)
    assert readers.read_pages(spark, empty, ddl("id long")).count() == 0


def test_partition_pruning_and_clustering(spark):
    path = fresh_path(spark, "clustered")
    df = spark.range(5000).select("id", F.timestamp_seconds(F.col("id") * 100).alias("ts"), (F.col("id") % 7).alias("vendor"))
    writers.write_by_date(df, path, "ts", ["vendor"])
    plan = writers.read_by_date(spark, path, "1970-01-02", "1970-01-03")
    assert "PartitionFilters: [isnotnull(day" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 1728


def test_stream_without_rows(spark, tmp_path):
    stream = messages.file_stream(spark, str(tmp_path), ddl("key string, ts timestamp"))
    counts = sinks.upserted(windows.running_count(stream, ["key"]), fresh_path(spark, "none"), ["key"])
    assert counts.columns == ["key", "count"] and counts.count() == 0
    assert sinks.latest_rows(stream, "ts", fresh_path(spark, "none")).count() == 0
