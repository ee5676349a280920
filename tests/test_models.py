"""Regression invariants and retrieval against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.plans import regression, retrieval


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    data = []
    for i in range(800):
        zone, pay = str(int(rng.integers(4))), str(int(rng.integers(1, 3)))
        fare, dist, tolls = float(rng.uniform(3, 50)), float(rng.uniform(0, 20)), float(rng.integers(3))
        tip = 0.2 * fare + 0.05 * dist + (2.0 if pay == "1" else 0.0) + float(zone) * 0.3 + float(rng.normal(0, 0.1))
        data.append((int(rng.integers(1, 6)), dist, zone, "9", pay, fare, tolls, tip))
    return spark.createDataFrame(
        data, "passenger_count long, trip_distance double, PULocationID string, DOLocationID string, "
              "payment_type string, fare_amount double, tolls_amount double, tip_amount double").cache()


def test_split_is_stable_and_complete(rows):
    train, held = regression.split(rows)
    assert train.count() + held.count() == rows.count() and 80 < held.count() < 240
    assert train.exceptAll(rows).count() == 0


def test_error_is_below_label_spread(rows):
    train, held = regression.split(rows)
    m = regression.evaluate(regression.train(train), held).first()
    assert math.sqrt(m["mean_squared_error"]) < 0.2 and m["r2_score"] > 0.99 and m["explained_variance"] > 0.99


def test_attributions_and_baseline_add_up(rows):
    model = regression.train(rows)
    out = regression.explain(model, rows, rows, top=len(regression.NUMBERS) + len(regression.CATEGORIES))
    gap = F.abs(F.col("baseline_prediction_value") + F.aggregate(
        "top_feature_attributions", F.lit(0.0), lambda a, p: a + p["attribution"]) - F.col("predicted_tip_amount"))
    assert out.agg(F.max(gap)).first()[0] < 1e-9
    top = regression.explain(model, rows, rows, top=3).first()["top_feature_attributions"]
    sizes = [abs(p["attribution"]) for p in top]
    assert len(top) == 3 and sizes == sorted(sizes, reverse=True)


def test_no_row_is_lost_for_a_null(rows):
    """Numbers, categories and labels may be NULL in training, prediction, explanation and search."""
    gap = lambda n, c: F.when(F.xxhash64("fare_amount", F.lit(n)) % n != 0, F.col(c)).alias(c)
    holes = rows.select(gap(3, "passenger_count"), gap(5, "trip_distance"), "PULocationID", gap(7, "DOLocationID"), "payment_type",
                        "fare_amount", gap(11, "tolls_amount"), gap(4, "tip_amount"))
    model = regression.train(holes)
    scored = regression.predict(model, holes)
    assert scored.filter("predicted_tip_amount is not null").count() == rows.count()
    assert regression.evaluate(model, holes).first()["rows"] == holes.filter("tip_amount is not null").count()
    names = len(regression.NUMBERS) + len(regression.CATEGORIES)
    told = regression.explain(model, holes, holes, top=names)
    gap = F.abs(F.col("baseline_prediction_value") + F.aggregate(
        "top_feature_attributions", F.lit(0.0), lambda a, p: a + p["attribution"]) - F.col("predicted_tip_amount"))
    assert told.count() == rows.count() and told.agg(F.max(gap)).first()[0] < 1e-6
    assert len(regression.search(holes, [(0.0, 0.0), (0.1, 0.1)])[1]) == 2


@pytest.mark.parametrize("l1, l2", [(0.05, 0.1), (0.3, 0.0), (0.0, 1.0), (20.0, 0.1), (0.0, 0.0)])
def test_moments_give_the_fitted_model(rows, l1, l2):
    """Weights and held-out error from the moments are those of a fit and an evaluation over the rows, with NULLs as well."""
    gap = lambda n, c: F.when(F.xxhash64("fare_amount", F.lit(n)) % n != 0, F.col(c)).alias(c)
    holes = rows.select(gap(3, "passenger_count"), gap(5, "trip_distance"), "PULocationID", gap(7, "DOLocationID"), "payment_type",
                        "fare_amount", "tolls_amount", "tip_amount").cache()
    slots, parts = regression.moments(holes)
    weights, intercept = regression.solve(parts[True], l1, l2)
    train, held = regression.split(holes)
    assert (parts[True].n, parts[False].n) == (train.count(), held.count())
    filled = holes.agg(*[F.avg(n).alias(n) for n in regression.NUMBERS]).first()  # the moments' means are those of all rows
    fill = lambda df: df.withColumns({n: F.coalesce(F.col(n).cast("double"), F.lit(filled[n])) for n in regression.NUMBERS})
    model = regression.train(fill(train), l1, l2)
    error = regression.evaluate(model, fill(held)).first()["mean_squared_error"]
    assert abs(parts[False].mean_squared_error(weights, intercept) - error) < 1e-3 * max(1, error)
    if l2:  # without it, categories that add up to one leave the weights open, and only predictions agree
        want = {(r["input"], r["category"]): r["weight"] for r in regression.weights(model, rows).collect()}
        assert abs(want.pop(("intercept", None)) - intercept) < 5e-3
        assert set(want) == set(slots) and all(abs(w - want[s]) < 2e-3 for s, w in zip(slots, weights))


def test_search_reads_the_rows_once_for_all_trials(rows, monkeypatch):
    """Trials are solved from the moments; only the best one is fitted to the rows."""
    fitted = []
    fit = regression.train
    monkeypatch.setattr(regression, "train", lambda *a: fitted.append(a[1:]) or fit(*a))
    pairs = [(5.0, 1.0), (0.001, 0.0), (20.0, 10.0)]
    _, report = regression.search(rows, pairs)
    assert fitted == [pairs[1]] and min(report, key=lambda r: r["mean_squared_error"])["trial"] == 2


def test_search_reports_every_trial(rows):
    model, report = regression.search(rows)
    assert len(report) == regression.TRIALS
    assert all(0 <= r["l1_reg"] <= 20 and r["l2_reg"] in regression.L2_CANDIDATES for r in report)
    assert regression.predict(model, rows).count() == rows.count()


@pytest.mark.parametrize("pass_bytes", [1 << 20, 3 * 8 * 8])
def test_nearest_matches_brute_force(spark, pass_bytes):
    rng = np.random.default_rng(1)
    corpus, queries = rng.normal(size=(300, 8)), rng.normal(size=(7, 8))
    corpus[17] = corpus[3]  # an exact tie
    c = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(corpus)], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)], "query_id long, embedding array<double>")
    out = retrieval.nearest(c.repartition(5), q, 4, pass_bytes=pass_bytes).collect()
    sims = (queries / np.linalg.norm(queries, axis=1)[:, None]) @ (corpus / np.linalg.norm(corpus, axis=1)[:, None]).T
    assert len(out) == 28
    for r in out:
        order = sorted(range(300), key=lambda i: (-round(sims[r["query_id"], i], 12), i))
        assert order[r["rank"] - 1] == r["vec_id"]


def test_many_queries_in_one_scan(spark, monkeypatch):
    """5,000 queries need no second scan, and no task gives out more than k rows for each."""
    rng = np.random.default_rng(2)
    corpus, queries = rng.normal(size=(400, 6)), rng.normal(size=(5000, 6))
    c = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(corpus)], "vec_id long, embedding array<double>").repartition(4)
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)], "query_id long, embedding array<double>")
    monkeypatch.setattr(retrieval, "materialise", lambda *a: pytest.fail("a second scan"))
    out = retrieval.nearest(c, q, 3).toPandas().sort_values(["query_id", "rank"])
    sims = (queries / np.linalg.norm(queries, axis=1)[:, None]) @ (corpus / np.linalg.norm(corpus, axis=1)[:, None]).T
    assert (out["vec_id"].to_numpy().reshape(-1, 3) == np.argsort(-sims, axis=1)[:, :3]).all()
    assert retrieval._scan(c, q.toPandas(), 3, "vec_id", "embedding").count() == 4 * 5000 * 3
    assert retrieval.nearest(c, q.limit(0), 3).count() == 0 == retrieval.nearest(c.limit(0), q, 3).count()


def test_chunks_cover_whole_text(spark):
    text = " ".join(f"w{i}" for i in range(23))
    df = spark.createDataFrame([(1, text), (2, "one"), (3, "  ")], "doc_id long, text string")
    out = retrieval.chunks(df, 10).orderBy("doc_id", "chunk").collect()
    assert [len(r["chunk_text"].split()) for r in out] == [10, 10, 3, 1]
    assert " ".join(r["chunk_text"] for r in out if r["doc_id"] == 1) == text
    lapped = retrieval.chunks(df.filter("doc_id = 1"), 10, overlap=4).orderBy("chunk").collect()
    assert lapped[1]["chunk_text"].split()[0] == "w6" and lapped[-1]["chunk_text"].split()[-1] == "w22"
