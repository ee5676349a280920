"""Distributed windows and percentiles against plain windows and pandas, hot groups included."""

import datetime

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.operators import dedup, ordered, percentiles


@pytest.fixture(scope="module")
def rows(spark):
    """2,000 rows; one group holds half of them, one value of it a third; some keys and values NULL."""
    rng = np.random.default_rng(5)
    data = []
    for i in range(2000):
        key = "hot" if i % 2 else [None, "a", "b", "c"][int(rng.integers(4))]
        value = 7.0 if key == "hot" and i % 3 == 0 else None if i % 50 == 0 else float(rng.integers(40))
        data.append((i, key, value))
    return spark.createDataFrame(data, "id long, key string, value double").repartition(6).cache()


def same(a, b, columns):
    key = lambda r: tuple(str(r[c]) for c in columns)
    assert sorted(map(key, a.select(columns).collect())) == sorted(map(key, b.select(columns).collect()))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_number_rows(rows, keys):
    w = Window.partitionBy(*keys).orderBy(F.col("value").desc_nulls_last(), "id")
    same(ordered.number_rows(rows, keys, ["-value", "id"]), rows.withColumn("rn", F.row_number().over(w)), ["id", "rn"])


@pytest.mark.parametrize("row_number", [None, "row_number"])
def test_ranks(rows, row_number):
    w = Window.partitionBy("key").orderBy(F.col("value").desc_nulls_last())
    plain = rows.select("*", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"))
    same(ordered.ranked(rows, ["key"], "-value", ["id"], row_number), plain, ["id", "rank", "dense_rank"])


def test_rank_table_of_the_lesson(spark):
    scores = spark.createDataFrame([(i, s) for i, s in enumerate([95, 90, 90, 85])], "id int, score int")
    out = ordered.ranked(scores, [], "-score", ["id"]).orderBy("row_number").collect()
    assert [r["row_number"] for r in out] == [1, 2, 3, 4]
    assert [r["rank"] for r in out] == [1, 2, 2, 4]
    assert [r["dense_rank"] for r in out] == [1, 2, 2, 3]


@pytest.mark.parametrize("chunk,offset", [(5, 1), (5, 3), (10_000, 2)])
def test_lag_lead(rows, chunk, offset):
    w = Window.partitionBy("key").orderBy("id")
    plain = rows.select("*", F.lag("value", offset).over(w).alias("p"), F.lead("value", offset).over(w).alias("n"))
    out = ordered.lag_lead(rows, ["key"], ["id"], "value", "p", "n", offset, chunk_rows=chunk)
    same(out, plain, ["id", "p", "n"])


@pytest.mark.parametrize("chunk", [9, 10_000])
def test_running_and_moving(rows, chunk):
    w = Window.partitionBy("key").orderBy("id")
    plain = rows.select("*", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                        F.max("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                        F.avg("value").over(w.rowsBetween(-6, 2)).alias("a"))
    out = ordered.number_rows(rows, ["key"], ["id"])
    out = ordered.framed(out, ["key"], {"a": lambda w: F.avg("value").over(w.rowsBetween(-6, 2))}, 6, 2, chunk_rows=chunk)
    out = ordered.running(out, ["key"], {"s": "value"}, {"m": "value"}, chunk_rows=chunk)
    same(out, plain, ["id", "s", "m", "a"])


def payload_exchanges(df, column):
    """Exchanges of the plan that carry ``column``."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return sum(f"{column}#" in part for part in text.split("\n\n") if ") Exchange\n" in part + "\n")


@pytest.mark.parametrize("chunk", [9, 10_000])
def test_frames_and_prefixes_share_one_exchange(rows, chunk):
    w = Window.partitionBy("key").orderBy("id")
    plain = rows.select("*", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                        F.max("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                        F.avg("value").over(w.rowsBetween(-6, 2)).alias("a"), F.lag("value", 6).over(w).alias("p"),
                        F.count(F.lit(1)).over(w.rowsBetween(-6, 2)).alias("c"))
    last = lambda w: w.rowsBetween(-6, 2)
    out = ordered.chunked(ordered.number_rows(rows, ["key"], ["id"]), ["key"], {
        "a": lambda w: F.avg("value").over(last(w)), "p": lambda w: F.lag("value", 6).over(w),
        "c": lambda w: F.count(F.lit(1)).over(last(w))}, {"s": "value"}, {"m": "value"}, 6, 2, chunk_rows=chunk)
    same(out, plain, ["id", "s", "m", "a", "p", "c"])
    assert payload_exchanges(out, "id") == 1


def test_frame_longer_than_chunk_is_refused(rows):
    with pytest.raises(ValueError):
        ordered.framed(ordered.number_rows(rows, [], ["id"]), [], {}, before=10, chunk_rows=5)


def test_percentiles(rows):
    shares = {"p0": 0.0, "p25": 0.25, "p90": 0.9, "p97": 0.97, "p100": 1.0}
    out = {r["key"]: r for r in percentiles.percentiles(rows, ["key"], "value", shares).collect()}
    pdf = rows.toPandas()
    groups = {k if isinstance(k, str) else None: g["value"].dropna() for k, g in pdf.groupby("key", dropna=False)}
    assert set(out) == set(groups)
    for key, values in groups.items():
        for name, p in shares.items():
            assert out[key][name] == pytest.approx(np.percentile(values, p * 100))


def test_percentile_over_keeps_rows(rows):
    out = percentiles.percentile_over(rows, ["key"], "value", 0.5, "median")
    assert out.count() == rows.count()
    assert out.filter("key is null and median is null").count() == 0


@pytest.mark.parametrize("chunk", [4, 10_000])
def test_sessions(spark, chunk):
    rng = np.random.default_rng(3)
    data = [(int(i), ["x", "y"][int(k)], datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=int(s)))
            for i, (k, s) in enumerate(zip(rng.integers(0, 2, 400), rng.integers(0, 20_000, 400)))]
    df = spark.createDataFrame(data, "id long, k string, ts timestamp")
    plain = df.groupBy(F.session_window("ts", "60 seconds").alias("w"), "k").agg(F.count("*").alias("count")).select(
        "k", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "count")
    same(ordered.sessions(df, ["k"], "ts", 60, ["id"], chunk_rows=chunk), plain, ["k", "session_start", "session_end", "count"])


def test_keep_first_and_top_per_group(rows):
    w = Window.partitionBy("key").orderBy("id")
    same(dedup.keep_first(rows, ["key"], ["id"]), rows.withColumn("r", F.row_number().over(w)).filter("r = 1"), ["id"])
    assert dedup.top_per_group(rows, ["key"], ["id"], 3).count() == 15


def test_keep_first_prunes_before_the_shuffle(rows):
    plan = dedup.keep_first(rows, ["key"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_nth_value(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 9.0), (3, 9.0), (4, 8.0)], "id int, v double")
    assert {r["id"] for r in dedup.nth_value_rows(df, "-v", 2).collect()} == {2, 3}
    assert dedup.nth_value_rows(df, "-v", 3).count() == 0  # skipped by the tie
    assert {r["id"] for r in dedup.nth_value_rows(df, "-v", 4).collect()} == {4}
