"""Streams into tables.

All runs process what is available and stop; pass ``trigger`` for a standing query. Each
query has a checkpoint folder of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import loads
from ..session import fresh_path
from . import state

AVAILABLE = {"availableNow": True}


def start(df: DataFrame, fmt: str, mode: str = "append", trigger: dict | None = None,
          checkpoint: str | None = None, name: str | None = None, **options):
    w = (df.writeStream.format(fmt).outputMode(mode).trigger(**(trigger or AVAILABLE))
         .option("checkpointLocation", checkpoint or fresh_path(df.sparkSession, "checkpoint")).options(**options))
    return (w.queryName(name) if name else w).start()


def console(df: DataFrame, mode: str = "complete", interval: str = "5 seconds"):
    return start(df, "console", mode, {"processingTime": interval}, truncate="false")


def for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], mode: str = "append",
                   trigger: dict | None = None, checkpoint: str | None = None):
    return (df.writeStream.foreachBatch(fn).outputMode(mode).trigger(**(trigger or AVAILABLE))
            .option("checkpointLocation", checkpoint or fresh_path(df.sparkSession, "checkpoint")).start())


def finish(query) -> None:
    """Wait for the end; a failure in the stream is raised here."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def to_table(df: DataFrame, path: str) -> DataFrame:
    """Append-mode rows into a Parquet folder, exactly once."""
    finish(start(df, "parquet", "append", path=path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def to_memory(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Named in-memory view on the driver, for results that are small by nature."""
    finish(start(df, "memory", mode, name=name))
    return df.sparkSession.table(name)


#: Partitions of a keyed table whose keys hold no date; each batch rewrites those that its keys fall into.
KEY_PARTITIONS = 16


class Batches:
    """A stream's rows, one folder ``batch=<n>`` for each batch under one root.

    Writing a batch looks at no other one, and a retry overwrites its own folder. All are read at
    once, by the known schema, with the batch's number as a column.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.target = loads.create(spark, path, T.StructType([*schema, T.StructField("batch", T.LongType())]), "batch")

    def write(self, batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.target.path}/batch={n}")

    def read(self) -> DataFrame:
        return self.target.read(self.spark)


def append_batches(df: DataFrame, path: str) -> DataFrame:
    """Append through a batch function. A retried batch replaces its own files only."""
    table = Batches(df.sparkSession, path, df.schema)
    finish(for_each_batch(df, table.write))
    return table.read().drop("batch")


def newest_result(df: DataFrame, path: str) -> DataFrame:
    """Complete-mode result: the table is what the last batch gave. Such a result is small by nature, as each batch gives all of it."""
    target = loads.create(df.sparkSession, path, df.schema)
    finish(for_each_batch(df, lambda batch, n: batch.write.mode("overwrite").parquet(path), "complete"))
    return target.read(df.sparkSession)


def changelog(df: DataFrame, path: str) -> DataFrame:
    """Update-mode rows with the batch that emitted them."""
    table = Batches(df.sparkSession, path, df.schema)
    finish(for_each_batch(df, table.write, "update"))
    return table.read()


def upserted(df: DataFrame, path: str, keys: Sequence[str], by: Column | None = None) -> DataFrame:
    """Update-mode rows as a table keyed by ``keys``: the newest row of each key.

    Each batch is merged into the partitions its keys fall into; the files of all others stay. ``by`` is
    the partition as a function of the keys, such as the day of a window's start, which fits best where a
    batch changes recent windows only; without, it is a part of their hash. A retried batch gives the same table.
    """
    spark, part = df.sparkSession, "_partition"
    by = by if by is not None else F.pmod(F.xxhash64(*keys), F.lit(KEY_PARTITIONS)).cast("int")
    keyed = df.withColumn(part, by)
    target = loads.create(spark, path, keyed.schema, part)
    finish(for_each_batch(keyed, lambda batch, n: loads.merge(target, batch, keys, moves=False), "update"))
    return target.read(spark).drop(part)


def branched(df: DataFrame, predicate: Column, path: str) -> tuple[DataFrame, DataFrame]:
    """Split by a predicate into two tables, reading the stream once."""
    spark = df.sparkSession
    yes, no = Batches(spark, f"{path}/matching", df.schema), Batches(spark, f"{path}/other", df.schema)
    hit = F.coalesce(predicate, F.lit(False))

    def write(batch: DataFrame, n: int) -> None:
        yes.write(batch.filter(hit), n)
        no.write(batch.filter(~hit), n)

    finish(for_each_batch(df, write))
    return yes.read().drop("batch"), no.read().drop("batch")


def latest_rows(df: DataFrame, ts: str, path: str, keep: str = "1 hour") -> DataFrame:
    """The rows at the highest time seen so far.

    The highest time is kept as state (see ``state.newest``); a batch only adds the rows that reach it. The
    filter at the end is over those few.
    """
    rows = append_batches(state.newest(df, ts, keep), path)
    return rows.filter(F.col(ts) == rows.agg(F.max(ts)).scalar())


def await_any(spark: SparkSession, seconds: float | None = None) -> bool:
    """Wait until any stream of the session ends, at most ``seconds``; a failure of it is raised here."""
    return bool(spark.streams.awaitAnyTermination(seconds)) if seconds is not None else spark.streams.awaitAnyTermination() is None


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every running query of the session; returns their names or ids."""
    stopped = []
    for query in spark.streams.active:
        query.stop()
        stopped.append(query.name or str(query.id))
    return stopped


def status(query) -> dict:
    s = query.status
    return {"message": s["message"], "data_available": s["isDataAvailable"], "active": query.isActive}
