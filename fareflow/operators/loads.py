"""Load patterns over plain Parquet folders.

A target is a folder, the schema it is read by and, for merges, the column it is partitioned by.
Replacing overwrites the folder, appending adds files, merging overwrites the partitions it touches
(``partitionOverwriteMode=dynamic``) and leaves the files of all others as they are. Spark shows the
files of a write only once all of its tasks are committed, so a failed one never shows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from ..sources.writers import by_size
from .dedup import keep_first


class SchemaChanged(ValueError):
    """The incoming columns differ from the target's and the policy is to fail."""


@dataclasses.dataclass(frozen=True)
class Target:
    path: str
    schema: T.StructType
    by: str | None = None  # partition column

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def _write(df: DataFrame, target: Target, mode: str, **options: str) -> None:
    writer = (by_size(df, target.by) if target.by else df).write.mode(mode).options(**options)
    (writer.partitionBy(target.by) if target.by else writer).parquet(target.path)


def create(spark: SparkSession, path: str, schema: T.StructType | str, by: str | None = None) -> Target:
    """A target that exists: an empty one is made only if nothing is there."""
    empty = spark.createDataFrame([], schema)
    target = Target(path, empty.schema, by)
    writer = empty.write.mode("ignore")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return target


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, then those that only ``new`` has; all may be NULL, as rows from before lack the new ones."""
    fields = {f.name: f for f in [*old, *[f for f in new if f.name not in old.names]]}
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def replace(target: Target, df: DataFrame) -> Target:
    """The rows of ``df``, under its schema, instead of what is there."""
    out = dataclasses.replace(target, schema=widened(T.StructType(), df.schema))
    _write(df, out, "overwrite")
    return out


def append(target: Target, df: DataFrame) -> Target:
    """Adds files without a look at earlier ones. Columns that only one load has are NULL in the others."""
    _write(df, target, "append")
    return dataclasses.replace(target, schema=widened(target.schema, df.schema))


def _in(column: str, values: Sequence) -> Column:
    """Whether a partition column has one of a few values, NULL among them; Spark prunes the folders by it."""
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


def merge(target: Target, source: DataFrame, keys: Sequence[str], order: Sequence[str] = (), moves: bool = True) -> Target:
    """Whole-row replacement by key that rewrites only partitions in which a row changes.

    Source rows win, the first by ``order`` (then by all columns) where a key repeats. A row whose
    partition changes leaves its old one. With ``moves=False`` a key always has the same partition,
    so only the source's own partitions are read. One partition's rewrite is committed at a time: a run that
    fails between two of them is repeated, and gives the same table. The driver sees partition values only.
    """
    if not keys or not target.by:
        raise ValueError("merge needs key columns and a partition column")
    spark, by = source.sparkSession, target.by
    source = materialise(keep_first(source, keys, order), "staged")
    incoming = {r[0] for r in source.select(by).distinct().collect()}
    if not incoming:
        return target
    old, known = target.read(spark), source.select(*keys)
    left: dict = {}
    if moves and by not in keys:
        counts = old.join(known, list(keys), "left_semi").groupBy(by).count().collect()
        left = {r[0]: r[1] for r in counts if r[0] not in incoming}
    inside = _in(by, [*incoming, *left])
    schema = widened(target.schema, source.schema)
    rows = old.where(inside).join(known, list(keys), "left_anti").unionByName(source, allowMissingColumns=True).select(*schema.names)
    emptied = []
    if left:
        sizes = {r[0]: r[1] for r in old.where(_in(by, list(left))).groupBy(by).count().collect()}
        emptied = [v for v, n in left.items() if sizes[v] == n]
    folders = [old.where(_in(by, [v])).select("_metadata.file_path").first()[0].rsplit("/", 1)[0] for v in emptied]
    _write(rows, target, "overwrite", partitionOverwriteMode="dynamic")
    for folder in folders:  # all of its rows went to other partitions, so the write had none for it
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return dataclasses.replace(target, schema=schema)


def append_missing(target: Target, source: DataFrame, key: str) -> None:
    """``insert_only`` into a stored table: only the new rows are written.

    The partition column must follow from the key, as a month does from an id that hashes the time:
    the target is then read in the source's partitions only. The source is written once, as a staging
    table. Each side is exchanged once and directly below the join, where adaptive execution can split a
    hot key of the source; an anti join needs no distinct keys on its right.
    """
    spark = source.sparkSession
    if not hasattr(source, "written_to"):  # a table that is written already serves as its own staging table
        source = materialise(source, "staged")
    known = target.read(spark)
    if target.by:
        values = [r[0] for r in source.select(target.by).distinct().collect()]
        known = known.where(_in(target.by, values))
    known = known.select(key).where(F.col(key).isNotNull())
    _write(source.join(known, key, "left_anti").select(*source.columns), target, "append")


def unseen(source: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Source rows whose key ``known`` lacks.

    Copies of one row may be many on either side. Keys are made distinct first, and the shared
    ones are written out: the last join then has a plain table of single keys on its right, so
    adaptive execution can split a hot key of the source.
    """
    shared = source.select(key).distinct().join(known.select(key).distinct(), key, "left_semi")
    return source.join(materialise(shared, "shared-keys"), key, "left_anti").select(*source.columns)


def insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target plus the source rows whose key it lacks. Duplicates inside the source all go in."""
    return target.unionByName(unseen(source, target, key), allowMissingColumns=True)


def delete_by_key(target: DataFrame, key: str, values: Sequence) -> DataFrame:
    """All rows but those with a listed key; rows with a NULL key stay."""
    return target.filter(~F.coalesce(F.col(key).isin(list(values)), F.lit(False)))


def newer_than_target(source: DataFrame, target: DataFrame, cursor: str, lookback: str | None = None) -> DataFrame:
    """Source rows past the target's highest cursor.

    Without ``lookback`` the test is strict, so rows that arrive late or equal the maximum
    are left out; ``lookback='3 days'`` reads that much again for the merge to sort out.
    """
    high = F.max(cursor)
    if lookback:
        high = high - F.expr(f"INTERVAL {lookback}")
    limit = target.agg(high.alias("limit")).scalar()
    return source.filter(limit.isNull() | (F.col(cursor) > limit))


def incremental(target: Target, source: DataFrame, key: str, cursor: str,
                order: Sequence[str] = (), lookback: str | None = None) -> Target:
    """Incremental model: new rows by cursor, unique key, fail on any schema change; untouched partitions stay."""
    if [(f.name, f.dataType) for f in target.schema] != [(f.name, f.dataType) for f in source.schema]:
        raise SchemaChanged(f"target {target.schema.simpleString()}, source {source.schema.simpleString()}")
    new = newer_than_target(source, target.read(source.sparkSession), cursor, lookback)
    return merge(target, new, [key], order)


def load(target: Target, df: DataFrame, disposition: str, keys: Sequence[str] = (), order: Sequence[str] = ()) -> Target:
    """``replace``, ``append`` or ``merge`` (by ``keys``)."""
    if disposition == "replace":
        return replace(target, df)
    if disposition == "append":
        return append(target, df)
    if disposition == "merge":
        return merge(target, df, keys, order)
    raise ValueError(f"unknown disposition {disposition!r}")


class Cursor:
    """Highest loaded cursor value, kept as a one-row table beside the data."""

    def __init__(self, spark: SparkSession, path: str, initial: str):
        self.spark, self.initial = spark, initial
        self.state = create(spark, path, "cursor string")

    def stored(self) -> str | None:
        row = self.state.read(self.spark).first()
        return row["cursor"] if row else None

    def value(self) -> str:
        return self.stored() or self.initial

    def extract(self, source: DataFrame, column: str, loaded: DataFrame | None = None, key: str | None = None) -> DataFrame:
        """Rows at or past the initial value on the first run, past the cursor later.

        Rows that equal the cursor may arrive late. With ``loaded`` and ``key`` those of them that
        were not loaded yet are extracted too; without, the test is strict.
        """
        last = self.stored()
        limit = F.lit(last or self.initial).cast(source.schema[column].dataType)
        if last is None:
            return source.filter(F.col(column) >= limit)
        past = source.filter(F.col(column) > limit)
        if loaded is None or key is None:
            return past
        return past.unionByName(unseen(source.filter(F.col(column) == limit), loaded.filter(F.col(column) == limit), key))

    def advance(self, loaded: DataFrame, column: str) -> None:
        high = loaded.agg(F.max(column).cast("string")).first()[0]
        replace(self.state, self.spark.createDataFrame([(high or self.value(),)], "cursor string"))


def history(df: DataFrame, keys: Sequence[str], valid_from: str, order: Sequence[str] = ()) -> DataFrame:
    """Versions of each key with the time the next one starts (NULL for the current one)."""
    from . import ordered

    rows = ordered.number_rows(df, keys, [valid_from, *order])
    rows = ordered.framed(rows, keys, {"valid_to": lambda w: F.lead(valid_from).over(w)}, ahead=1)
    return (rows.withColumnRenamed(ordered.RN, "version")
            .withColumn("is_current", F.col("valid_to").isNull()))


def schema_changes(old: T.StructType, new: T.StructType) -> list[tuple[str, str]]:
    """(column, change): 'added', 'added_required', 'removed' or 'retyped'."""
    before, after = {f.name: f for f in old}, {f.name: f for f in new}
    out = []
    for name, f in after.items():
        if name not in before:
            out.append((name, "added" if f.nullable else "added_required"))
        elif before[name].dataType != f.dataType:
            out.append((name, "retyped"))
    return out + [(name, "removed") for name in before if name not in after]


def compatible(old: T.StructType, new: T.StructType) -> bool:
    """New readers can read old rows: only nullable additions and removals."""
    return all(change in ("added", "removed") for _, change in schema_changes(old, new))
