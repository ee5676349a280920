"""Quality rules: counts over each text, and robust outliers among their transforms.

The counts become four numbers: log of the mean word length, log of symbols per 100 words, and the
arcsine roots of the shares of repeated lines and of repeated words. For each language and source
the minimum-covariance-determinant estimate is taken over the rows that pass the fixed rules:
from each of four deterministic starts (quartiles with diagonal scatters), ``STEPS`` concentration
steps each keep the three quarters of rows that are nearest by Mahalanobis distance and estimate mean
and covariance anew; the start that ends at the smallest determinant gives the estimate. All starts
share each step's passes. Sums are those of whole numbers, so that an estimate does not depend on how
the rows are partitioned. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareflow.llm.columns import only, renamed
from fareflow.operators.joins import small_side
from fareflow.session import materialise

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words in repeated windows
#: Share of rows in the subset of the smallest determinant, and the factor that makes the scatter
#: of that subset an estimate for all rows of a normal sample in four dimensions.
SUBSET, CONSISTENCY = 0.75, 1.485
STEPS = 6
#: Rejected beyond this squared distance: chance 1e-6 for four dimensions (chi square).
CUTOFF = 33.4
#: Least standard deviations of the four numbers; most texts have no symbol and no repeated line,
#: and a covariance of zeros would reject all others.
FLOORS = (0.04, 0.3, 0.15, 0.15)
#: A source with fewer rows is judged by its language, a language with fewer by the whole corpus.
MIN_ROWS = 40
#: Distances are ranked in bins of 1/64 of a unit of their logarithm.
BINS = 64
#: The numbers are summed up in units of 2^-20; quartiles are taken on a grid of 1/256, which bounds their memory.
UNIT_BITS, GRID = 20, 256
#: Starts: which quartile is the centre, and whether the scatter follows the quartiles (else it is four floors wide).
STARTS = ((1, False), (1, True), (0, True), (2, True))

_WORD = r"[^\x20\x09-\x0D]+"
_SYMBOL = r"[#*$%&|<>]"
_P = range(len(FLOORS))
_PAIRS = [(i, j) for i in _P for j in range(i + 1)]
_X, _Q = [f"_x{i}" for i in _P], [f"_q{i}" for i in _P]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Number of words in three-word windows that occur twice or more."""
    hashes = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
        return F.sort_array(F.transform(F.filter(s, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]))

    def covered(r: Column) -> Column:
        return F.aggregate(r, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                           lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end")),
                           lambda a: a["n"])

    return F.coalesce(_let(F.sort_array(hashes), lambda s: covered(positions(s))), F.lit(0)).cast("long")


def counts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_n_words``, ``_word_chars``, ``_n_symbols``, ``_n_dup_lines``, ``_n_repeat_words``,
    ``_base_failed`` and the transforms ``_x0`` to ``_x3``. A null text has no words.
    """
    t = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(_WORD))
    out = docs.withColumn("_words", F.regexp_extract_all(t, F.lit(_WORD), F.lit(0)))
    out = out.withColumn("_lines", lines)
    out = out.select(
        *docs.columns,
        F.size("_words").cast("long").alias("_n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("_word_chars"),
        F.regexp_count(t, F.lit(_SYMBOL)).cast("long").alias("_n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_n_dup_lines"),
        F.size("_lines").alias("_n_lines"),
        _repeated_words(F.col("_words")).alias("_n_repeat_words"))
    n = F.greatest(F.col("_n_words"), F.lit(1))
    return out.withColumns({
        "_base_failed": (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEATED * F.col("_n_words")),
        "_x0": F.log((F.col("_word_chars") + 1) / n),
        "_x1": F.log1p(100 * F.col("_n_symbols") / n),
        "_x2": F.asin(F.sqrt(F.col("_n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)))),
        "_x3": F.asin(F.sqrt(F.col("_n_repeat_words") / n))}).drop("_n_lines")


def _keys() -> list[Column]:
    """Names of a row's source, language and corpus group; a null is a value of its own."""
    return [F.concat(F.lit("s"), F.to_json(F.struct("lang", "source"))), F.concat(F.lit("l"), F.to_json(F.struct("lang"))), F.lit("c")]


def _factor(moments: DataFrame, scale: float) -> DataFrame:
    """Mean, Cholesky factor of the covariance with the floors added, and half the logarithm of its determinant.

    ``moments`` has the count ``n``, sums ``s{i}`` and sums of products ``s{i}{j}`` by key and start.
    """
    out = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in _P})
    out = out.withColumns({f"c{i}{j}": scale * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
                           + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in _PAIRS})
    for j in _P:
        inner = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - inner, F.lit(FLOORS[j] ** 2))))
        for i in range(j + 1, len(FLOORS)):
            inner = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - inner) / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{i}{i}") for i in _P), F.lit(0.0))
    return out.select("key", "start", *_ESTIMATE, det.alias("det"))


_ESTIMATE = [f"m{i}" for i in _P] + [f"l{i}{j}" for i, j in _PAIRS]


def _starts(vectors: DataFrame) -> DataFrame:
    """The estimates that the steps begin with, for keys with enough rows."""
    grid = lambda x: F.floor(F.col(x) * GRID + 0.5) / GRID
    quartiles = vectors.groupBy("key").agg(F.count("*").alias("n"), *[
        F.percentile(grid(x), F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias(f"p{i}") for i, x in enumerate(_X)]).where(F.col("n") >= MIN_ROWS)

    def start(number: int, centre: int, by_quartiles: bool) -> Column:
        p = [F.col(f"p{i}") for i in _P]
        width = [F.greatest((p[i][2] - p[i][0]) / 1.349, F.lit(FLOORS[i])) if by_quartiles else F.lit(4 * FLOORS[i]) for i in _P]
        return F.struct(F.lit(number).alias("start"), *[p[i][centre].alias(f"m{i}") for i in _P],
                        *[(width[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in _PAIRS])

    return quartiles.select("key", F.inline(F.array(*[start(k, *of) for k, of in enumerate(STARTS)])))


def _step(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step of every start: the bin that completes the subset, then the subset's moments."""
    def placed(e: DataFrame) -> DataFrame:
        return _distance(vectors.join(small_side(e), "key")).withColumn("bin", F.floor(BINS * F.log(F.col("_d2") + 1e-6)).cast("int"))

    sizes = placed(estimate).groupBy("key", "start", "bin").agg(F.count("*").alias("n"))
    below = Window.partitionBy("key", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    last = (sizes.withColumns({"before": F.coalesce(F.sum("n").over(below), F.lit(0)),
                               "all": F.sum("n").over(Window.partitionBy("key", "start"))})
            .where(F.col("before") < SUBSET * F.col("all")).groupBy("key", "start").agg(F.max("bin").alias("last")))
    bounded = materialise(estimate.join(last, ["key", "start"]), "quality-bound")
    # A product has up to 48 bits: its halves are summed apart, which stays exact for any number of rows.
    low = (1 << UNIT_BITS) - 1
    product = {f"{i}{j}": F.col(_Q[i]) * F.col(_Q[j]) for i, j in _PAIRS}
    sums = placed(bounded).where("bin <= last").groupBy("key", "start").agg(
        F.count("*").alias("n"), *[F.sum(_Q[i]).alias(f"s{i}") for i in _P],
        *[F.sum(F.shiftright(p, UNIT_BITS)).alias(f"high{k}") for k, p in product.items()],
        *[F.sum(p.bitwiseAND(low)).alias(f"low{k}") for k, p in product.items()])
    unit = float(1 << UNIT_BITS)
    return sums.withColumns({f"s{i}": F.col(f"s{i}") / unit for i in _P}
                            | {f"s{k}": F.col(f"high{k}") / unit + F.col(f"low{k}") / unit / unit for k in product})


def _distance(rows: DataFrame) -> DataFrame:
    """``_d2``, the squared Mahalanobis distance, by forward substitution."""
    for i in _P:
        inner = sum((F.col(f"l{i}{k}") * F.col(f"_z{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"_z{i}", (F.col(_X[i]) - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    return rows.withColumn("_d2", sum((F.col(f"_z{i}") * F.col(f"_z{i}") for i in _P), F.lit(0.0)))


def fit(rows: DataFrame) -> DataFrame:
    """(lang, source, start, det, mean, factor): the estimate by which each language and source is judged.

    ``rows`` are the output of ``counts``. Groups below ``MIN_ROWS`` rows that pass the fixed rules
    use the language's or the corpus's estimate; a corpus below it has none.
    """
    whole = [F.floor(F.col(x) * (1 << UNIT_BITS) + 0.5).cast("long").alias(q) for x, q in zip(_X, _Q)]
    passed = materialise(rows.where("NOT _base_failed").select("lang", "source", *whole), "quality-vectors")
    by_source, by_lang, corpus = _keys()
    sources = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    langs = sources.groupBy("lang").agg(F.sum("n").alias("of_lang")).withColumnRenamed("lang", "_lang")
    known = sources.join(small_side(langs), F.col("lang").eqNullSafe(F.col("_lang")))
    judged = materialise(known.select("lang", "source", F.when(F.col("n") >= MIN_ROWS, by_source)
                                      .when(F.col("of_lang") >= MIN_ROWS, by_lang).otherwise(corpus).alias("key")), "quality-keys")

    needed = judged.select("key").distinct()
    vectors = passed.select(F.explode(F.array(by_source, by_lang, corpus)).alias("key"), *_Q).join(small_side(needed), "key")
    vectors = vectors.withColumns({x: F.col(q) / float(1 << UNIT_BITS) for x, q in zip(_X, _Q)})
    estimate = materialise(_starts(vectors), "quality-start")
    for _ in range(STEPS):
        estimate = materialise(_factor(_step(vectors, estimate.select("key", "start", *_ESTIMATE)), CONSISTENCY), "quality-step")
    best = estimate.groupBy("key").agg(F.min_by(F.struct("start", "det", *_ESTIMATE), F.struct("det", "start")).alias("e")).select("key", "e.*")
    return judged.join(best, "key", "left").drop("key")


def verdicts(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The output of ``counts`` with ``_kept``; rows without an estimate are kept if they pass the fixed rules."""
    e = small_side(estimates.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source"))
    joined = rows.join(e, rows["lang"].eqNullSafe(e["_lang"]) & rows["source"].eqNullSafe(e["_source"]), "left")
    return _distance(joined).withColumn(
        "_kept", ~F.col("_base_failed") & F.coalesce(F.col("_d2") <= CUTOFF, F.lit(True))).select(*rows.columns, "_kept")


_NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs``."""
    rows = materialise(counts(only(docs, "doc_id", "lang", "source", "text")).drop("text"), "quality-counts")
    return verdicts(rows, fit(rows)).select("doc_id", *[F.col(f"_{c}").alias(c) for c in _NUMBERS], F.col("_kept").alias("kept"))


def clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the fixed rules and are no outliers, with their columns as they were."""
    plain = renamed(docs, "lang", "source", "text")
    # Written with their counts: a filter on lazy counts would be pushed below and work them out many times.
    rows = materialise(counts(plain), "quality-counts")
    return verdicts(rows, fit(rows)).where("_kept").select(*plain.columns).toDF(*docs.columns)
