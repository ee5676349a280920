"""Batch sources: CSV, Parquet, JSON, external tables, paged records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ordered
from ..schemas import FEEDS


class UnknownFormat(ValueError):
    pass


def csv_typed(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(paths)


def csv_strings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header only: every column is text."""
    return spark.read.option("header", True).csv(paths)


def csv_sampled(spark: SparkSession, paths: str | Sequence[str], share: float = 0.01) -> DataFrame:
    """Types inferred from a sample of the rows, then all rows read with them.

    A value outside of its column's sampled type fails the read; it never turns into NULL.
    """
    sampled = (spark.read.option("header", True).option("inferSchema", True)
               .option("samplingRatio", share).option("preferDate", False).csv(paths))
    return spark.read.schema(sampled.schema).option("header", True).option("mode", "FAILFAST").csv(paths)


#: Types from narrow to wide, with the texts that count as one of their values.
_WHOLE, _NUMBER = r"^\s*[+-]?\d+\s*$", r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_TIME = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
LATTICE = {"boolean": r"^\s*(?i:true|false)\s*$", "int": _WHOLE, "bigint": _WHOLE, "double": _NUMBER, "timestamp": _TIME}


def widest_types(df: DataFrame) -> T.StructType:
    """For each text column the first type of ``LATTICE`` that holds every value of it, else string.

    One aggregate over all rows: each task says which types still fit, and the answers are joined.
    A column without any value stays text.
    """
    fits = [F.struct(F.count(c).alias("n"), *[
        F.bool_and(F.coalesce(F.col(c).rlike(shape) & F.col(c).try_cast(t).isNotNull(), F.lit(False)) | F.col(c).isNull()).alias(t)
        for t, shape in LATTICE.items()]).alias(f"_{i}") for i, c in enumerate(f"`{n}`" for n in df.columns)]
    found = df.agg(*fits).first() if fits else ()
    return T.StructType([
        T.StructField(name, T._parse_datatype_string(next((t for t in LATTICE if fit["n"] and fit[t]), "string")))
        for name, fit in zip(df.columns, found)])


def csv_widened(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Types that hold the values of all rows; no read fails and no value turns into NULL."""
    rows = csv_strings(spark, paths)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in widest_types(rows)])


def month_paths(root: str, feed: str, years: Iterable[int], months: Iterable[int] = range(1, 13),
                suffix: str = "csv.gz") -> list[str]:
    """``root/feed/year=yyyy/month=MM/*.suffix`` for every month, in order."""
    months = list(months)
    return [f"{root.rstrip('/')}/{feed}/year={y:04d}/month={m:02d}/*.{suffix}" for y in years for m in months]


def csv_months(spark: SparkSession, root: str, feed: str, years: Iterable[int],
               months: Iterable[int] = range(1, 13)) -> DataFrame:
    """All months in one job; the codec follows from the suffix."""
    return csv_typed(spark, month_paths(root, feed, years, months), FEEDS[feed])


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Folders or multi-level globs such as ``pq/green/*/*``."""
    return spark.read.parquet(*paths)


def detect_format(path: str) -> str:
    name = path.lower().split("?")[0].rstrip("/*")
    for suffix, fmt in ((".parquet", "parquet"), (".csv", "csv"), (".csv.gz", "csv")):
        if name.endswith(suffix):
            return fmt
    raise UnknownFormat(f"cannot tell the format of {path!r}: expected .parquet, .csv or .csv.gz")


def read_any(spark: SparkSession, path: str, fmt: str | None = None, feed: str | None = None) -> DataFrame:
    """Reader chosen by suffix. Feed types apply to CSV only; Parquet carries its own."""
    fmt = fmt or detect_format(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        return csv_typed(spark, path, FEEDS[feed]) if feed else csv_strings(spark, path)
    raise UnknownFormat(fmt)


def union_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files whose columns differ; absent columns are NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def external_csv(spark: SparkSession, view: str, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Named table over CSV globs; with a schema, extra trailing values are ignored and
    malformed ones become NULL."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    df = (reader.schema(schema) if schema else reader).csv(list(paths))
    df.createOrReplaceTempView(view)
    return df


def external_parquet(spark: SparkSession, view: str, *paths: str) -> DataFrame:
    df = spark.read.parquet(*paths)
    df.createOrReplaceTempView(view)
    return df


def json_array(spark: SparkSession, path: str, field: str | None = None, whole_files: bool = True) -> DataFrame:
    """A top-level array, or the array under ``field``, as rows.

    With ``whole_files`` each file is one document, which one task parses: a table should be
    many files. Otherwise each line is a document.
    """
    df = spark.read.option("multiLine", whole_files).json(path)
    return df.select(F.inline(field)) if field else df


def json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


PAGE_ROWS = 1000


def write_pages(df: DataFrame, path: str, order: Sequence[str], page_rows: int = PAGE_ROWS) -> None:
    """Records as JSON lines with their page number, pages kept together in files."""
    rows = ordered.number_rows(df, [], order)
    pages = rows.withColumn("page", F.floor((F.col(ordered.RN) - 1) / page_rows) + 1).drop(ordered.RN)
    pages.write.json(path)


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Pages 1, 2, ... up to the first empty one, as a client that asks page by page sees them."""
    records = spark.read.schema(T.StructType([*schema, T.StructField("page", T.LongType())])).json(path)
    pages = records.select("page").distinct()
    following = pages.select((F.col("page") + 1).alias("page")).unionByName(
        spark.range(1).select(F.lit(1).cast("long").alias("page")))
    # A page that follows a present one and is absent itself; the lowest is where reading stops.
    stop = following.join(pages, "page", "left_anti").agg(F.min("page"))
    return records.filter(F.col("page") < stop.scalar())


def generated(spark: SparkSession, rows: int, **columns) -> DataFrame:
    """Rows made by Spark itself: ``id`` plus the given expressions over it."""
    return spark.range(rows).select("id", *[c.alias(n) for n, c in columns.items()])


def object_store(spark: SparkSession, path: str, fmt: str, options: dict[str, str] | None = None) -> DataFrame:
    """Any path with a Hadoop file system: ``options`` carry its settings for this read."""
    return spark.read.format(fmt).options(**(options or {})).load(path)


def table_scan(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    out = df.select(*columns)
    return out.limit(limit) if limit is not None else out


def describe(df: DataFrame) -> DataFrame:
    """Schema as rows: position, column, type, nullable; plus the row count."""
    fields = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(f.nullable).alias("is_nullable"))
        for i, f in enumerate(df.schema)])
    return df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.inline(fields), "table_rows")


def partition_listing(df: DataFrame, partition: str) -> DataFrame:
    """Partitions with their row totals, the largest first."""
    return (df.groupBy(F.col(partition).alias("partition_id")).agg(F.count(F.lit(1)).alias("total_rows"))
            .orderBy(F.desc("total_rows"), "partition_id"))
