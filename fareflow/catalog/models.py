"""G and R: regression and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import regression, retrieval
from ..session import materialise
from .registry import query

FEATURES = """SELECT CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance, CAST(PULocationID AS VARCHAR) AS PULocationID,
    CAST(DOLocationID AS VARCHAR) AS DOLocationID, CAST(payment_type AS VARCHAR) AS payment_type, fare_amount, tolls_amount,
    tip_amount FROM trips WHERE fare_amount <> 0"""


def features(t):
    """Fitting passes over its input several times, so the feature table is written first."""
    return materialise(regression.feature_table(t.trips), "features")


@query("g01_feature_table", FEATURES, "trips")
def feature_table(t):
    return regression.feature_table(t.trips)


@query("g02_linear_regression")
def linear_regression(t):
    """All weights of the model: the intercept, each number, each known category."""
    rows = features(t)
    return regression.weights(regression.train(regression.split(rows)[0]), rows)


# The weights, errors and predictions have no SQL; what must hold for them has.
@query("g02_weights_per_input", f"WITH f AS ({FEATURES}) SELECT 'intercept' AS input, CAST(1 AS BIGINT) AS weights UNION ALL " + " UNION ALL ".join(
    [f"SELECT '{c}', 1" for c in regression.NUMBERS] + [f"SELECT '{c}', count(DISTINCT {c}) FROM f" for c in regression.CATEGORIES]), "trips")
def weights_per_input(t):
    """One weight for each number and for each category of each category input."""
    rows = features(t)
    return regression.weights(regression.train(rows), rows).groupBy("input").agg(F.count("weight").alias("weights"))


def info(column: str, number: bool) -> str:
    stats = (f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, round(avg(CAST({column} AS DOUBLE)), 6) AS mean, "
             f"round(stddev({column}), 6) AS stddev, NULL::BIGINT AS category_count" if number else
             f"NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, count(DISTINCT {column}) AS category_count")
    return f"SELECT '{column}' AS input, {stats}, count(*) FILTER ({column} IS NULL) AS null_count FROM f"


@query("g03_feature_info", f"WITH f AS ({FEATURES}) " + " UNION ALL ".join(
    [info(c, True) for c in regression.NUMBERS] + [info(c, False) for c in regression.CATEGORIES]), "trips")
def feature_info(t):
    return regression.feature_info(features(t)).withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


def with_gaps(rows):
    """The features with NULL numbers, categories and labels, as real feeds have them."""
    gap = lambda n: F.xxhash64(*rows.columns) % n == 0
    return rows.withColumns({"passenger_count": F.when(~gap(11), F.col("passenger_count")), "payment_type": F.when(~gap(13), F.col("payment_type"))})


@query("g04_evaluation")
def evaluation(t):
    """Errors over the whole labelled table."""
    rows = features(t)
    return regression.evaluate(regression.train(regression.split(rows)[0]), rows)


@query("g04_evaluated_rows", f"SELECT count(tip_amount) AS rows, true AS consistent FROM ({FEATURES})", "trips")
def evaluated_rows(t):
    """All labelled rows are scored; the error measures agree with each other."""
    rows = with_gaps(features(t))
    errors = regression.evaluate(regression.train(regression.split(rows)[0]), rows)
    return errors.select("rows", (
        (F.col("mean_absolute_error") * F.col("mean_absolute_error") <= F.col("mean_squared_error"))
        & (F.col("r2_score") <= F.col("explained_variance") + 1e-9) & (F.col("explained_variance") <= 1)).alias("consistent"))


@query("g05_predictions")
def predictions(t):
    rows = features(t)
    return regression.predict(regression.train(regression.split(rows)[0]), rows)


@query("g05_predicted_rows", f"SELECT count(*) AS rows, count(*) AS predicted FROM ({FEATURES})", "trips")
def predicted_rows(t):
    """Every row gets a prediction, also those with a NULL number or category."""
    rows = with_gaps(features(t))
    scored = regression.predict(regression.train(regression.split(rows)[0]), rows)
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count("predicted_" + regression.LABEL).alias("predicted"))


@query("g06_explained_predictions")
def explained(t):
    rows = features(t)
    train, _ = regression.split(rows)
    return regression.explain(regression.train(train), train, rows, 3)


@query("g06_attributions_add_up", f"SELECT count(*) AS rows, count(*) AS exact FROM ({FEATURES})", "trips")
def attributions_add_up(t):
    """Baseline plus all attributions is the prediction, for every row."""
    rows = with_gaps(features(t))
    train, _ = regression.split(rows)
    inputs = len(regression.NUMBERS) + len(regression.CATEGORIES)
    told = regression.explain(regression.train(train), train, rows, inputs)
    total = F.aggregate("top_feature_attributions", F.col("baseline_prediction_value"), lambda s, p: s + p["attribution"])
    off = F.abs(total - F.col("predicted_" + regression.LABEL))
    return told.agg(F.count(F.lit(1)).alias("rows"), F.count_if(off < 1e-6).alias("exact"))


@query("g07_parameter_search")
def parameter_search(t):
    _, report = regression.search(features(t))
    return t.spark.createDataFrame(report, "trial int, l1_reg double, l2_reg double, mean_squared_error double")


@query("g07_search_space", f"""SELECT CAST({regression.TRIALS} AS BIGINT) AS trials, true AS in_range, true AS best_kept
       FROM ({FEATURES}) HAVING count(tip_amount) > 0""", "trips")
def search_space(t):
    """The trials lie in the space, rows without a label do no harm, and the kept model is the best trial's."""
    rows = features(t)
    rows = rows.withColumn(regression.LABEL, F.when(F.xxhash64(*rows.columns) % 7 != 0, F.col(regression.LABEL)))
    model, report = regression.search(rows)
    best = min(report, key=lambda r: r["mean_squared_error"])
    line = model.stages[-1]
    table = t.spark.createDataFrame(report, "trial int, l1_reg double, l2_reg double, mean_squared_error double")
    low, high = regression.L1_RANGE
    return table.agg(F.count(F.lit(1)).alias("trials"),
                     F.every(F.col("l1_reg").between(low, high) & F.col("l2_reg").isin(*regression.L2_CANDIDATES)).alias("in_range"),
                     F.lit(abs(line.getRegParam() - best["l1_reg"] - best["l2_reg"]) < 1e-9).alias("best_kept"))


CHUNK_WORDS = 200
WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"


@query("r01_document_chunks", f"""SELECT doc_id, CAST(i AS INTEGER) AS chunk, array_to_string(list_slice(w, i * {CHUNK_WORDS} + 1, (i + 1) * {CHUNK_WORDS}), ' ')
       AS chunk_text FROM (SELECT doc_id, w, unnest(range(0, CAST(ceil(len(w) / {CHUNK_WORDS}.0) AS BIGINT))) AS i
       FROM (SELECT doc_id, {WORDS} AS w FROM documents))""")
def document_chunks(t):
    return retrieval.chunks(t.documents, CHUNK_WORDS)


@query("r01_nearest_vectors", """WITH cells AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings),
       means AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM cells GROUP BY 1, 2),
       sims AS (SELECT means.label AS query_id, vec_id, sum(CAST(x AS DOUBLE) * m) / (sqrt(sum(CAST(x AS DOUBLE) * x)) * sqrt(sum(m * m))) AS s
       FROM cells JOIN means USING (pos) GROUP BY 1, 2)
       SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(s, 6) AS similarity, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id)
       AS r FROM sims) WHERE r <= 5""")
def nearest_vectors(t):
    """The mean vector of each label asks for its five nearest vectors."""
    queries = retrieval.centroids(t.embeddings, "label", "embedding").withColumn("query_id", F.col("query_id").cast("long"))
    return retrieval.nearest(t.embeddings, queries, 5).withColumn("similarity", F.round("similarity", 6))
