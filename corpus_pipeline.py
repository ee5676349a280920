"""Documents to training pieces: quality, near-duplicates, repeated passages, benchmarks, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the
shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareflow.llm import decontamination, quality, simhash, substring_dedup, unigram
from fareflow.llm.queries import pieces
from fareflow.llm.workers import send_package
from fareflow.session import materialise

#: The verdicts of the first stages rest on hashes and iterated estimates that SQL does not have.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and are no outliers of their language and source."""
    send_package(spark)
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of linked fingerprints."""
    send_package(spark)
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of repeated windows; others keep their text as it is.

    What is left of a shortened text is joined by spaces and may be empty; ``n_chars`` follows it.
    """
    send_package(spark)
    cut = substring_dedup.cut_repeats(docs)
    shortened = F.col("_n_removed") > 0
    return cut.withColumns({"text": F.when(shortened, F.col("_kept")).otherwise(F.col("text")),
                            "n_chars": F.when(shortened, F.length("_kept").cast("long")).otherwise(F.col("n_chars"))}).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    send_package(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces and the text that these give back."""
    send_package(spark)
    return unigram.round_trip(docs, pieces())


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages),
          ("benchmark leaks", benchmark_leaks), ("piece ids", piece_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
