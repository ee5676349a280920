"""Batch sinks: Parquet layouts, partitioned and clustered tables, connectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingConnector(RuntimeError):
    """The data source needs a package that is not on the classpath."""


def write_parts(df: DataFrame, path: str, parts: int, mode: str = "errorifexists") -> None:
    """Evenly spread files, independent of any key."""
    df.repartition(parts).write.mode(mode).parquet(path)


def write_single(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One file, for small results. The exchange keeps the work above it parallel."""
    df.repartition(1).write.mode(mode).parquet(path)


def csv_to_parquet(spark: SparkSession, source: Sequence[str], path: str, schema: T.StructType) -> None:
    spark.read.schema(schema).option("header", True).csv(source).write.parquet(path)


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT."""
    w = df.write.mode("overwrite").format("parquet")
    (w.option("path", path) if path else w).saveAsTable(name)


def create_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed table, made only if absent."""
    if not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
            spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def write_by_date(df: DataFrame, path: str, ts: str, cluster: Sequence[str] = (), mode: str = "overwrite",
                  partition: str = "day") -> None:
    """Partitioned by the date of ``ts``, rows sorted by ``cluster`` inside each file.

    With cluster columns, tasks take ranges of (date, cluster columns), so that each file covers
    a narrow range and readers can skip the others; without, adaptive execution groups rows
    by date into evenly sized tasks. Either way a date with many rows is split.
    """
    dated = df.withColumn(partition, F.to_date(ts))
    if cluster:
        dated = dated.withColumn("_spread", F.xxhash64(*df.columns))
        dated = dated.repartitionByRange(partition, *cluster, "_spread").drop("_spread")
        dated = dated.sortWithinPartitions(partition, *cluster)
    else:
        dated = by_size(dated, partition)
    dated.write.mode(mode).partitionBy(partition).parquet(path)


def by_size(df: DataFrame, *columns: str) -> DataFrame:
    """Rows grouped by columns for a partitioned write; large groups are split, small ones merged."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def read_by_date(spark: SparkSession, path: str, first: str, last: str, partition: str = "day") -> DataFrame:
    """Dates first..last, both included, by partition pruning."""
    day = F.col(partition)
    return spark.read.parquet(path).filter((day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date")))


def save_external(df: DataFrame, fmt: str, mode: str = "append", **options: str) -> None:
    """Any Spark data source, such as a warehouse or JDBC connector."""
    try:
        df.write.format(fmt).mode(mode).options(**options).save()
    except Exception as e:  # the JVM reports an absent source as a generic analysis error
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "ClassNotFound" in str(e) or "No suitable driver" in str(e):
            raise MissingConnector(f"{fmt} is not on the classpath: add its package to spark.jars.packages") from e
        raise


def to_sql_table(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a table in an SQL database: one insert stream per partition."""
    save_external(df, "jdbc", "overwrite", url=url, dbtable=table, **options)
