"""Linear regression of tips on Spark ML: features, training, evaluation, explanation, search.

No row is lost on the way: a NULL number counts as the training rows' mean, a NULL or unknown
category as a category of weight zero. Only rows without a label are left out of fitting and errors.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_side

# --- fixed values: features and search space of the tip model ---
NUMBERS = ("passenger_count", "trip_distance", "fare_amount", "tolls_amount")
CATEGORIES = ("PULocationID", "DOLocationID", "payment_type")
LABEL = "tip_amount"
L1_RANGE = (0.0, 20.0)
L2_CANDIDATES = (0.0, 0.1, 1.0, 10.0)
TRIALS, PARALLEL_TRIALS = 5, 2
# --- end of fixed values ---

#: Share of the rows that train, at every size.
TRAIN_SHARE = 0.8


def feature_table(trips: DataFrame) -> DataFrame:
    """Typed training table: ids as text, paid trips only."""
    return trips.filter(F.col("fare_amount") != 0).select(
        F.col("passenger_count").cast("long"), F.col("trip_distance").cast("double"),
        *[F.col(c).cast("string") for c in CATEGORIES],
        *[F.col(c).cast("double") for c in ("fare_amount", "tolls_amount", LABEL)])


def training_draw(features: DataFrame) -> Column:
    """A number from 0 to 1 by a hash of the row."""
    return F.pmod(F.xxhash64(*features.columns), F.lit(1_000_000)) / 1_000_000


def split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``TRAIN_SHARE`` of the rows and the rest, by a hash of the row; equal rows land on one side."""
    draw = training_draw(features)
    return features.filter(draw < TRAIN_SHARE), features.filter(draw >= TRAIN_SHARE)


def labelled(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(LABEL).isNotNull())


def _stages(l1: float, l2: float) -> list:
    mix = l1 / (l1 + l2) if l1 + l2 else 0.0
    return [
        StringIndexer(inputCols=list(CATEGORIES), outputCols=[c + "_ix" for c in CATEGORIES], handleInvalid="keep"),
        OneHotEncoder(inputCols=[c + "_ix" for c in CATEGORIES], outputCols=[c + "_hot" for c in CATEGORIES]),
        # The imputer would cut a mean to the type of a whole number.
        SQLTransformer(statement=f"SELECT *, {', '.join(f'CAST({n} AS DOUBLE) AS {n}_real' for n in NUMBERS)} FROM __THIS__"),
        Imputer(inputCols=[n + "_real" for n in NUMBERS], outputCols=[n + "_in" for n in NUMBERS], strategy="mean"),
        VectorAssembler(inputCols=[*[n + "_in" for n in NUMBERS], *[c + "_hot" for c in CATEGORIES]], outputCol="features"),
        LinearRegression(labelCol=LABEL, regParam=l1 + l2, elasticNetParam=mix, maxIter=50),
    ]


def train(rows: DataFrame, l1: float = 0.0, l2: float = 0.0) -> PipelineModel:
    return Pipeline(stages=_stages(l1, l2)).fit(labelled(rows))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = model.transform(rows)
    return scored.select(*rows.columns, F.col("prediction").alias("predicted_" + LABEL))


def evaluate(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Error measures over all labelled rows, and their number, in one pass."""
    scored = predict(model, labelled(rows))
    err = F.col("predicted_" + LABEL) - F.col(LABEL)
    return scored.agg(
        F.count(LABEL).alias("rows"),
        F.avg(F.abs(err)).alias("mean_absolute_error"),
        F.avg(err * err).alias("mean_squared_error"),
        F.avg(F.pow(F.log1p(F.greatest("predicted_" + LABEL, F.lit(0.0))) - F.log1p(LABEL), 2)
              ).alias("mean_squared_log_error"),
        F.percentile_approx(F.abs(err), 0.5).alias("median_absolute_error"),
        (1 - F.sum(err * err) / (F.var_pop(LABEL) * F.count(LABEL))).alias("r2_score"),
        (1 - F.var_pop(err) / F.var_pop(LABEL)).alias("explained_variance"))


def feature_info(rows: DataFrame) -> DataFrame:
    """min, max, mean, stddev, categories and nulls per input; numbers in one pass, each category grouped first."""
    aggs, out = [], []
    for i, c in enumerate(NUMBERS):
        aggs += [F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}"),
                 F.avg(c).alias(f"mean{i}"), F.stddev(c).alias(f"sd{i}"), F.count_if(F.col(c).isNull()).alias(f"null{i}")]
        out.append(F.struct(
            F.lit(c).alias("input"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"), F.col(f"mean{i}").alias("mean"),
            F.col(f"sd{i}").alias("stddev"), F.lit(None).cast("long").alias("category_count"), F.col(f"null{i}").alias("null_count")))
    info = rows.agg(*aggs).select(F.inline(F.array(*out)))
    nothing = F.lit(None).cast("double")
    for c in CATEGORIES:
        values = rows.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        info = info.unionByName(values.agg(
            F.lit(c).alias("input"), *[nothing.alias(n) for n in ("min", "max", "mean", "stddev")], F.count(c).alias("category_count"),
            F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("n"))), F.lit(0)).alias("null_count")))
    return info


def weights(model: PipelineModel, like: DataFrame) -> DataFrame:
    """(input, category, weight) of the whole model: the intercept, each number, each known category.

    The coefficient vector holds the numbers, then per category input one slot for each known
    value; what was never seen in training has no slot and contributes nothing.
    """
    coefficients = [float(c) for c in model.stages[-1].coefficients.toArray()]
    rows = [("intercept", None, float(model.stages[-1].intercept)), *[(n, None, coefficients[i]) for i, n in enumerate(NUMBERS)]]
    at = len(NUMBERS)
    for name, values in zip(CATEGORIES, model.stages[0].labelsArray):
        rows += [(name, value, coefficients[at + i]) for i, value in enumerate(values)]
        at += len(values)
    return like.sparkSession.createDataFrame(rows, "input string, category string, weight double")


def _contributions(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``_of_<input>``, what each input adds to the prediction.

    Category weights are joined as a table, so the plan does not grow with the categories.
    """
    means = model.stages[3].surrogateDF.first().asDict()
    coefficients = model.stages[-1].coefficients.toArray()
    table = weights(model, rows)
    for c in CATEGORIES:
        own = table.filter(F.col("input") == c).select(F.col("category").alias(f"_key_{c}"), F.col("weight").alias(f"_weight_{c}"))
        rows = (rows.join(small_side(own), F.col(c) == F.col(f"_key_{c}"), "left")
                .withColumn(f"_of_{c}", F.coalesce(f"_weight_{c}", F.lit(0.0))).drop(f"_key_{c}", f"_weight_{c}"))
    return rows.withColumns({f"_of_{n}": F.coalesce(F.col(n).cast("double"), F.lit(float(means[n + "_real"]))) * float(coefficients[i])
                             for i, n in enumerate(NUMBERS)})


def explain(model: PipelineModel, train_rows: DataFrame, rows: DataFrame, top: int = 3) -> DataFrame:
    """Prediction, baseline and the ``top`` largest attributions per row (all of them for ``top`` of the inputs' number).

    A feature's attribution is its contribution less its mean contribution over the training
    rows; baseline plus all attributions is the prediction.
    """
    names = (*NUMBERS, *CATEGORIES)
    base = _contributions(model, labelled(train_rows)).agg(*[F.avg(f"_of_{n}").alias(n) for n in names]).first().asDict()
    baseline = float(model.stages[-1].intercept) + sum(base.values())
    parts = [F.struct(F.abs(F.col(f"_of_{n}") - base[n]).alias("size"), F.lit(n).alias("feature"),
                      (F.col(f"_of_{n}") - base[n]).alias("attribution")) for n in names]
    largest = F.slice(F.sort_array(F.array(*parts), asc=False), 1, top)
    return _contributions(model, predict(model, rows)).select(
        *rows.columns, "predicted_" + LABEL,
        F.lit(baseline).alias("baseline_prediction_value"),
        F.transform(largest, lambda p: F.struct(p["feature"].alias("feature"), p["attribution"].alias("attribution"))
                    ).alias("top_feature_attributions"))


def trials(seed: int = 7, count: int = TRIALS) -> list[tuple[float, float]]:
    """Sampled (l1, l2) pairs."""
    draw = random.Random(seed)
    return [(draw.uniform(*L1_RANGE), draw.choice(L2_CANDIDATES)) for _ in range(count)]


@dataclass
class Moments:
    """Sums over one part of the rows: all that a linear fit and its squared error need to know of them."""
    n: float
    x: np.ndarray   # of the inputs
    xx: np.ndarray  # of their products
    xy: np.ndarray  # of their products with the label
    y: float
    yy: float

    def mean_squared_error(self, weights: np.ndarray, intercept: float) -> float:
        off = (self.yy - 2 * (weights @ self.xy + intercept * self.y) + weights @ self.xx @ weights
               + 2 * intercept * (weights @ self.x) + self.n * intercept ** 2)
        return max(float(off) / self.n, 0.0) if self.n else float("nan")


def moments(rows: DataFrame) -> tuple[list[tuple[str, str | None]], dict[bool, Moments]]:
    """(input, category) of each slot, and the moments of the training rows and of the rest (see ``split``).

    One pass over the rows after that for the means: sums by each category and each pair of categories, as grouping
    sets, so what reaches the driver grows with the categories and not with the rows.
    """
    means = rows.agg(*[F.avg(n).alias(n) for n in NUMBERS]).first().asDict()
    filled = {n: F.coalesce(F.col(n).cast("double"), F.lit(means[n] or 0.0)) for n in NUMBERS}
    plain = rows.select((training_draw(rows) < TRAIN_SHARE).alias("_train"), F.col(LABEL).cast("double").alias("_y"),
                        *[v.alias(f"_n{i}") for i, v in enumerate(filled.values())], *CATEGORIES)
    x = [f"_n{i}" for i in range(len(NUMBERS))]
    sums = [F.sum(c).alias(f"s{c}") for c in (*x, "_y")] + [F.sum(F.col(a) * F.col(b)).alias(f"s{a}{b}")
                                                            for i, a in enumerate(x) for b in (*x[i:], "_y")]
    known = plain.withColumns({c: F.struct(c) for c in CATEGORIES})  # a NULL category is no absent grouping column
    sets = [["_train"], *[["_train", c] for c in CATEGORIES], *[["_train", *p] for p in itertools.combinations(CATEGORIES, 2)]]
    cells = known.groupingSets([[F.col(c) for c in s] for s in sets], "_train", *CATEGORIES).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_y") * F.col("_y")).alias("syy"), *sums).collect()

    value = lambda cell, c: None if cell[c] is None else cell[c][0]
    found = sorted({(c, value(r, c)) for r in cells for c in CATEGORIES if value(r, c) is not None},
                   key=lambda s: (CATEGORIES.index(s[0]), s[1]))
    slots = [*[(n, None) for n in NUMBERS], *found]
    at, d = {s: i for i, s in enumerate(slots)}, len(slots)
    out = {part: Moments(0, np.zeros(d), np.zeros((d, d)), np.zeros(d), 0.0, 0.0) for part in (True, False)}
    for r in cells:
        m, own = out[r["_train"]], [c for c in CATEGORIES if r[c] is not None]
        where = [at.get((c, value(r, c))) for c in own]
        if None in where:
            continue
        if not own:
            m.n, m.y, m.yy = r["n"], r["s_y"], r["syy"]
            for i, a in enumerate(x):
                m.x[i], m.xy[i] = r[f"s{a}"], r[f"s{a}_y"]
                for j, b in enumerate(x[i:], i):
                    m.xx[i, j] = m.xx[j, i] = r[f"s{a}{b}"]
        elif len(own) == 1:
            (k,) = where
            m.x[k] = m.xx[k, k] = r["n"]
            m.xy[k] = r["s_y"]
            m.xx[k, :len(x)] = m.xx[:len(x), k] = [r[f"s{a}"] for a in x]
        else:
            j, k = where
            m.xx[j, k] = m.xx[k, j] = r["n"]
    return slots, out


def solve(m: Moments, l1: float, l2: float, tolerance: float = 1e-10, rounds: int = 20_000) -> tuple[np.ndarray, float]:
    """Weights and intercept of the elastic net on standardised inputs and label, by coordinate descent.

    Without penalties the least-squares weights of the smallest norm.
    """
    mean, target = m.x / m.n, m.y / m.n
    sd = np.sqrt(np.maximum(np.diag(m.xx) / m.n - mean ** 2, 0.0))
    spread = np.sqrt(max(m.yy / m.n - target ** 2, 0.0))
    used = sd > 1e-12
    weights = np.zeros(len(sd))
    if spread > 0 and used.any():
        scale = sd[used]
        gram = (m.xx[np.ix_(used, used)] / m.n - np.outer(mean[used], mean[used])) / np.outer(scale, scale)
        right = (m.xy[used] / m.n - mean[used] * target) / (scale * spread)
        if l1 == l2 == 0:
            w = np.linalg.lstsq(gram, right, rcond=1e-10)[0]
        else:
            w, pull = np.zeros(len(scale)), right.copy()  # pull: what is left to explain for each input
            for _ in range(rounds):
                most = 0.0
                for j in range(len(w)):
                    part = pull[j] + gram[j, j] * w[j]
                    new = np.sign(part) * max(abs(part) - l1 / spread, 0.0) / (gram[j, j] + l2 / spread)
                    if new != w[j]:
                        pull -= gram[:, j] * (new - w[j])
                        most, w[j] = max(most, abs(new - w[j])), new
                if most < tolerance:
                    break
        weights[used] = w * spread / scale
    return weights, target - weights @ mean


def search(rows: DataFrame, pairs: Sequence[tuple[float, float]] | None = None) -> tuple[PipelineModel, list[dict]]:
    """Best model by held-out error over the trials, fitted anew to all rows.

    All trials are solved and judged from one set of moments. Rows without a label take no part.
    """
    pairs, rows = list(pairs or trials()), labelled(rows)
    _, parts = moments(rows)
    judged = parts[False] if parts[False].n else parts[True]
    with ThreadPoolExecutor(PARALLEL_TRIALS) as pool:
        errors = list(pool.map(lambda p: judged.mean_squared_error(*solve(parts[True], *p)), pairs))
    report = [{"trial": i + 1, "l1_reg": l1, "l2_reg": l2, "mean_squared_error": e} for i, ((l1, l2), e) in enumerate(zip(pairs, errors))]
    best = min(report, key=lambda r: r["mean_squared_error"])
    return train(rows, best["l1_reg"], best["l2_reg"]), report
