"""Tables replayed as streams of several micro-batches, with rows that come late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import messages

BATCH = "_batch"


def by_time(df: DataFrame, ts: str, batches: int, late: Column, by: int) -> DataFrame:
    """``df`` with the batch of each row: one of ``batches`` equal spans of time, ``by`` batches later where ``late``.

    Rows of the last batches come late by as many batches as are left.
    """
    at = F.unix_millis(F.col(ts).cast("timestamp"))
    low, high = df.agg(F.min(at), F.max(at)).first()
    span = F.floor((at - F.lit(low)) * batches / F.lit((high or 0) - (low or 0) + 1)).cast("int")
    return df.withColumn(BATCH, F.when(late, F.least(span + by, F.lit(batches - 1))).otherwise(span))


def in_batches(df: DataFrame, batches: int, path: str, spread: str, files: int = 4) -> DataFrame:
    """A stream whose micro-batches are the batches of ``by_time``, in order.

    Each batch is written after the one before, as ``files`` files with ranges of ``spread``, a column of which
    every batch has at least as many values; a trigger takes as many files.
    """
    schema = df.drop(BATCH).schema
    for n in range(batches):
        part = df.filter(F.col(BATCH) == n).drop(BATCH)
        part.repartitionByRange(files, spread).write.mode("append").parquet(path)
    return messages.file_stream(df.sparkSession, path, schema, max_files=files)
