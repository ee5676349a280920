"""Stored sketches: united ones keep the bound that a direct one has."""

import pytest
from pyspark.sql import functions as F

from fareflow.operators import sketches


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 40).cast("int").alias("day"),
                                    (F.xxhash64("id") % 20_000).alias("v"), (F.abs(F.xxhash64("id", F.lit(1))) % 100_000 / 7).alias("x"))
    return df.withColumn("v", F.when(F.col("day") != 7, F.col("v"))).withColumn("x", F.when(F.col("day") != 9, F.col("x"))).cache()


def test_united_distinct_counts(rows):
    stored = sketches.distinct_by(rows, ["k"], F.col("day"), "v")
    assert stored.count() == 120
    got = {r["k"]: r for r in sketches.united_distinct(stored, ["k"]).collect()}
    direct = {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.hll_sketch_estimate(F.hll_sketch_agg("v", F.lit(sketches.DISTINCT_BITS))).alias("n")).collect()}
    for r in rows.groupBy("k").agg(F.count_distinct("v").alias("n")).collect():
        assert got[r["k"]]["periods"] == 40
        assert abs(got[r["k"]]["estimate"] - r["n"]) <= sketches.DISTINCT_ERROR * r["n"]
        assert abs(direct[r["k"]] - r["n"]) <= sketches.DISTINCT_ERROR * r["n"]
    assert sketches.united_distinct(sketches.distinct_by(rows.limit(0), ["k"], F.col("day"), "v"), ["k"]).count() == 0


def test_united_quantiles(rows):
    shares = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    stored = sketches.quantiles_by(rows, ["k"], F.col("day"), "x")
    found = sketches.united_quantiles(stored, ["k"], shares)
    sizes = {r["k"]: r["n"] for r in found.collect()}
    assert sizes == {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.count("x").alias("n")).collect()}
    errors = sketches.rank_errors(rows, found.drop("n"), ["k"], "x", shares).collect()
    assert len(errors) == 3 and all(r[p] <= sketches.RANK_ERROR for r in errors for p in shares)


def test_rank_errors_of_wrong_values(rows):
    wrong = rows.select("k").distinct().withColumn("p50", F.lit(0.0))
    assert all(abs(r["p50"] - 0.5) < 0.01 for r in sketches.rank_errors(rows, wrong, ["k"], "x", {"p50": 0.5}).collect())
