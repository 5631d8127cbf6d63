"""From framed lines or a message log to the common envelope, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ripplelake.functions import wire
from ripplelake.schema import ENVELOPE, TOPIC


def read_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Landed lines as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream
    return reader.text(folder)


def frames(lines: DataFrame, column: str = "value") -> DataFrame:
    """Payloads of the lines that carry one, as ``raw_message``; other lines are not counted anywhere."""
    return lines.where(F.col(column).startswith(wire.FRAME_PREFIX)).select(
        *[c for c in lines.columns if c != column],
        wire.frame_payload(column).alias("raw_message"),
    )


def outgoing(lines: DataFrame, observe: Observation | str | None = None) -> tuple[DataFrame, DataFrame]:
    """Framed lines as (messages with their key, rejected payloads with the reason).

    With ``observe`` the totals ``sent`` and ``skipped`` are collected while the data passes by.
    """
    checked = wire.with_error(frames(lines))
    if observe is not None:
        checked = checked.observe(observe, *ingest_totals())
    good = wire.with_message_key(checked.where("_error = ''").drop("_error"))
    return good, checked.where("_error != ''").withColumnRenamed("_error", "error_message")


def ingest_totals() -> list:
    ok = F.col("_error") == ""
    return [F.count_if(ok).alias("sent"), F.count_if(~ok).alias("skipped")]


def ingest_counters(lines: DataFrame) -> DataFrame:
    """One row: payloads sent and skipped."""
    return wire.with_error(frames(lines)).agg(*ingest_totals())


def key_bytes(key: str = "kafka_key") -> Column:
    """UTF-8 bytes of the key; an empty one is null."""
    return F.nullif(F.col(key), F.lit("")).cast("binary")


def value_bytes(text: str = "raw_message") -> Column:
    """UTF-8 bytes of the JSON text, unchanged."""
    return F.col(text).cast("binary")


def kafka_records(messages: DataFrame, topic: str = TOPIC) -> DataFrame:
    return messages.select(key_bytes().alias("key"), value_bytes().alias("value"), F.lit(topic).alias("topic"))


def write_files(records: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Records as Parquet files, each written exactly once; stands in for a topic where there is none."""
    return (
        records.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    )


def from_kafka(records: DataFrame) -> DataFrame:
    """Records of a topic in the common envelope."""
    return records.select(
        F.col("value").cast("string").alias("raw_message"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("bigint").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("kafka_key"),
    )


def stamped(messages: DataFrame) -> DataFrame:
    """Envelope plus ``ingested_at``; in a stream the time is fixed per micro-batch, also when it is retried."""
    if "ingested_at" in messages.columns:
        return messages.select(*ENVELOPE.fieldNames(), "ingested_at")
    return messages.select(*ENVELOPE.fieldNames(), F.current_timestamp().alias("ingested_at"))


def peek(messages: DataFrame, n: int = 5) -> DataFrame:
    """A few messages, oldest offsets first; reading them moves nobody's position."""
    return messages.orderBy("kafka_partition", "kafka_offset").limit(n)
