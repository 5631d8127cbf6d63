"""Kafka reader and writer.  Both only set options; the connector jar comes with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ripplelake.schema import TOPIC
from ripplelake.sources import messages

# Delivery settings of the producing side.
WRITE_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.retries": "5",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.linger.ms": "100",
    "kafka.compression.type": "gzip",
    "kafka.max.block.ms": "30000",
    "kafka.request.timeout.ms": "30000",
}


def read_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    min_per_trigger: int | None = None,
    max_delay: str | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the reader.

    Positions live in the checkpoint of the query: ``starting`` only counts where there is none yet.
    One task reads one topic partition; ``min_partitions`` splits them further.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    optional = {
        "maxOffsetsPerTrigger": max_per_trigger,
        "minOffsetsPerTrigger": min_per_trigger,
        "maxTriggerDelay": max_delay,
        "minPartitions": min_partitions,
    }
    return options | {k: str(v) for k, v in optional.items() if v is not None}


def read_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**read_options(servers, **options))
    return messages.from_kafka(reader.load())


def peek(spark: SparkSession, servers: str, topic: str = TOPIC, n: int = 5) -> DataFrame:
    """A batch read with its own positions, so no running query is disturbed.

    The topic is dealt into reads of ``n`` records; a limit without an order runs the first of them only.
    """
    reader = spark.read.format("kafka").options(**read_options(servers, topic), maxRecordsPerPartition=str(n))
    return messages.from_kafka(reader.load()).limit(n)


def write_stream(outgoing: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC) -> DataStreamWriter:
    return (
        messages.kafka_records(outgoing, topic)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .options(**WRITE_OPTIONS)
        .option("checkpointLocation", checkpoint)
    )
