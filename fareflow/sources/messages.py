"""Keyed messages: topics as sources and sinks, and the message formats.

A message table has ``key`` and ``value`` (binary) and, when read from a topic, its
position. The same functions work on a topic and on files that hold such rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import label, ts_text
from ..schemas import ENVELOPE
from .writers import MissingConnector

TEXT_SEPARATOR = ", "


def topic_options(servers: str, topics: str | Sequence[str], start: str = "earliest",
                  username: str | None = None, password: str | None = None,
                  fail_on_data_loss: bool = True, max_offsets: int | None = None) -> dict[str, str]:
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if username is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
        }
    return options


def _gated(what: str, action):
    try:
        return action()
    except Exception as e:
        if any(t in str(e) for t in ("DATA_SOURCE_NOT_FOUND", "Failed to find data source", "AVRO_NOT_LOADED",
                                     "ClassNotFound", "JavaPackage", "deployment section", "NOT_LOADED")):
            raise MissingConnector(f"{what} is not on the classpath: add its package to spark.jars.packages") from e
        raise


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _gated("the Kafka source", lambda: spark.readStream.format("kafka").options(**options).load())


def topic_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _gated("the Kafka source", lambda: spark.read.format("kafka").options(**options).load())


def file_stream(spark: SparkSession, path: str, schema: T.StructType = ENVELOPE, fmt: str = "parquet",
                max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """Files that arrive in a folder; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    _gated("the Kafka sink", lambda: df.write.format("kafka").option(
        "kafka.bootstrap.servers", servers).option("topic", topic).save())


def stream_to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append"):
    return _gated("the Kafka sink", lambda: df.writeStream.format("kafka").outputMode(mode).option(
        "kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start())


# ---- encode --------------------------------------------------------------
def _message(df: DataFrame, key: str | Column | None, value: Column) -> DataFrame:
    k = F.lit(None).cast("string") if key is None else (F.col(key) if isinstance(key, str) else key).cast("string")
    return df.select(k.cast("binary").alias("key"), value.cast("binary").alias("value"))


def as_text(df: DataFrame, columns: Sequence[str], key: str | Column | None = None) -> DataFrame:
    """Fields joined by ', '; a window column contributes its start."""
    texts = []
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StructType):
            texts.append(ts_text(f"{c}.start"))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            texts.append(ts_text(c))
        else:
            texts.append(F.col(c).cast("string"))
    return _message(df, key, label(TEXT_SEPARATOR, *texts, missing=""))


def as_json(df: DataFrame, columns: Sequence[str], key: str | Column | None = None) -> DataFrame:
    return _message(df, key, F.to_json(F.struct(*columns)))


def as_avro(df: DataFrame, columns: Sequence[str], avro_schema: str, key: str | None = None) -> DataFrame:
    from pyspark.sql.avro.functions import to_avro

    return _gated("Avro", lambda: _message(df, key, to_avro(F.struct(*columns), avro_schema)))


# ---- decode --------------------------------------------------------------
def _try_cast(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))
    return c.try_cast(kind)


def parse_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields by position; text that does not fit the type becomes NULL."""
    parts = F.split(F.col("value").cast("string"), TEXT_SEPARATOR)
    return df.select(*[_try_cast(F.get(parts, F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(schema)])


def parse_json(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    data = F.from_json(F.col("value").cast("string"), schema).alias("_data")
    return df.select(*keep, data).select(*keep, "_data.*")


def parse_json_strings(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Senders that quote every value, or wrap one in a one-element list: read as text, then cast."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    df = parse_json(df, texts, keep)

    def plain(name: str) -> Column:
        first = F.get(F.from_json(F.col(name), T.ArrayType(T.StringType())), F.lit(0))
        return F.when(F.col(name).startswith("["), first).otherwise(F.col(name))

    return df.select(*keep, *[_try_cast(plain(f.name), f.dataType).alias(f.name) for f in schema])


def parse_avro(df: DataFrame, avro_schema: str) -> DataFrame:
    from pyspark.sql.avro.functions import from_avro

    return _gated("Avro", lambda: df.select(from_avro("value", avro_schema).alias("_data")).select("_data.*"))


def valid_records(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required field, and the rest for quarantine."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok)
