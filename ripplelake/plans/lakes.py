"""Lakes filled from a source folder through the live path, for the queries that report on stored tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelake.functions import wire
from ripplelake.operators import route
from ripplelake.plans import maintain
from ripplelake.plans import medallion as m
from ripplelake.operators.route import BrokenMessages
from ripplelake.schema import BRONZE, ERRORS, SILVER, SILVER_LOG, TYPED_EVENTS
from ripplelake.session import CLUSTER, scratch, use_utc
from ripplelake.sources import messages, recent_changes, typed
from ripplelake.sources.lake import Lake, with_day, with_hour, with_ingest
from ripplelake.streaming import monitor
from ripplelake.streaming.native import heartbeat, live_hourly_stats
from ripplelake.streaming.pipeline import Pipeline, TypedPipeline

BATCHES = 3
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

_built: dict[tuple[str, str, str], object] = {}


def once(build):
    """Build a lake a single time per application and source folder."""

    def lookup(spark: SparkSession, sf_dir: str):
        key = (build.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _built:
            _built[key] = build(use_utc(spark), sf_dir)
        return _built[key]

    return lookup


#: Messages of a landed file, up to twice as many where a batch has few: more messages make more files, not longer tasks.
FILE_MESSAGES = 100_000


def inbox(spark: SparkSession, delivered: DataFrame, folder: str, batches: int = BATCHES) -> DataFrame:
    """Land messages as files and read them as a stream of ``batches`` micro-batches.

    The files hold messages of all times in no order, so every batch after the first brings late rows and
    second deliveries for hours that are already stored.  Messages are dealt by a hash: dealt in turn, Spark would
    sort all their texts first, so that a task tried again deals them alike.
    """
    cores = spark.sparkContext.defaultParallelism
    rounds = -(-delivered.count() // (batches * FILE_MESSAGES * cores))
    per_batch = max(2, cores // 2) if rounds < 2 else rounds * cores
    delivered.repartition(batches * per_batch, "kafka_offset", "ingested_at", "raw_message").write.parquet(folder)
    landed = len(spark.read.schema(delivered.schema).parquet(folder).inputFiles())
    per_batch = -(-landed // batches)
    return spark.readStream.schema(delivered.schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


@dataclass
class Live:
    lake: Lake
    reports: list[str] = field(default_factory=list)


def _run(writer) -> list[str]:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return monitor.reports_of(query)


def _stored(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Rows that are read several times, made once."""
    path = scratch(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@once
def live(spark: SparkSession, sf_dir: str) -> Live:
    """Messages through the live path; silver and gold are refreshed after every batch."""
    root = scratch(spark, "live")
    lake = Lake(spark, f"{root}/lake", grain="day")
    stream = inbox(spark, recent_changes.recent_changes(spark, sf_dir), f"{root}/inbox")
    return Live(lake, _run(Pipeline(lake).start(stream, f"{root}/checkpoint")))


@once
def live_hours(spark: SparkSession, sf_dir: str) -> Lake:
    """The same in hours: the second batch comes into days that are full, and only its hours are read again."""
    root = scratch(spark, "hours")
    lake = Lake(spark, f"{root}/lake", grain="hour")
    stream = inbox(spark, recent_changes.recent_changes(spark, sf_dir), f"{root}/inbox", 2)
    _run(Pipeline(lake).start(stream, f"{root}/checkpoint"))
    return lake


@once
def with_dead_letters(spark: SparkSession, sf_dir: str) -> Lake:
    """Broken messages go to a table of their own."""
    root = scratch(spark, "dead")
    lake = Lake(spark, f"{root}/lake", grain="day")
    stream = inbox(spark, recent_changes.recent_changes(spark, sf_dir), f"{root}/inbox", 2)
    _run(Pipeline(lake, policy="dead_letters", refresh=False).start(stream, f"{root}/checkpoint"))
    return lake


@once
def failing(spark: SparkSession, sf_dir: str) -> Lake:
    """Broken messages end the stream; its one batch fails as a whole, twice."""
    root = scratch(spark, "failing")
    lake = Lake(spark, f"{root}/lake", grain="day")
    stream = inbox(spark, recent_changes.recent_changes(spark, sf_dir), f"{root}/inbox", 1)
    for _ in range(2):
        query = Pipeline(lake, policy="fail").start(stream, f"{root}/checkpoint").trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except StreamingQueryException as e:
            if BrokenMessages.__name__ not in str(e):
                raise
    return lake


@once
def deleted(spark: SparkSession, sf_dir: str) -> Lake:
    """Bots are deleted from silver and, with all their deliveries, from what it is made of; the log was compacted before."""
    lake = Lake(spark, scratch(spark, "deleted"), grain="day")
    bronze = m.bronze_of(recent_changes.recent_changes(spark, sf_dir))
    lake.replace(BRONZE, with_ingest(bronze, "landed"))
    maintain.replay(lake)
    maintain.replay(lake, dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    maintain.compact(lake, SILVER_LOG)
    maintain.delete_where(lake, SILVER, F.col("user").like("Bot%"))
    maintain.replay(lake)
    events = typed.typed_events(typed.typed_messages(recent_changes.typed_changes(spark, sf_dir)))
    lake.replace(TYPED_EVENTS, with_day(events.withColumn("batch", F.lit("landed")), "timestamp"))
    maintain.delete_where(lake, TYPED_EVENTS, F.col("title") == "")
    maintain.delete_where(lake, TYPED_EVENTS, F.col("user").like("~%"))
    return lake


@once
def compacted_bronze(spark: SparkSession, sf_dir: str) -> Lake:
    """Bronze and errors in many small files, some rows of which are deleted, then merged by their bytes."""
    lake = Lake(spark, scratch(spark, "merged"), grain="day")
    checked = _stored(spark, wire.with_error(recent_changes.recent_changes(spark, sf_dir)), "checked")
    for table, rows in ((BRONZE, route.healthy(checked)), (ERRORS, route.broken(checked))):
        batch = F.format_string("q-%010d", F.col("kafka_offset") % 4)
        lake.replace(table, with_ingest(rows, "").withColumn("batch", batch))
        lake.delete(table, lambda df: df.where("kafka_partition = 1"))
        maintain.compact(lake, table)
    return lake


@once
def live_typed(spark: SparkSession, sf_dir: str) -> Live:
    root = scratch(spark, "typed")
    lake = Lake(spark, f"{root}/lake", grain="day")
    stream = inbox(spark, recent_changes.typed_changes(spark, sf_dir), f"{root}/inbox", 2)
    return Live(lake, _run(TypedPipeline(lake).start(stream, f"{root}/checkpoint")))


@once
def replayed(spark: SparkSession, sf_dir: str) -> Lake:
    """Only bronze is given; silver and gold come from a replay, and from a second one that changes nothing."""
    lake = Lake(spark, scratch(spark, "replayed"), grain="day")
    bronze = m.bronze_of(recent_changes.recent_changes(spark, sf_dir))
    lake.replace(BRONZE, with_ingest(bronze, "landed"))
    maintain.replay(lake)
    maintain.replay(lake, dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    return lake


@once
def compacted(spark: SparkSession, sf_dir: str) -> Lake:
    """The log in three batches and all of it once more in a fourth, then every day of it merged."""
    lake = Lake(spark, scratch(spark, "compacted"), grain="day")
    rows = m.silver_rows(m.bronze_of(recent_changes.recent_changes(spark, sf_dir)))
    # One pass over the messages: a union would make and parse each of them twice.
    batches = F.array(F.concat(F.lit("part-"), F.col("event_id") % 3), F.lit("part-again"))
    lake.replace(SILVER_LOG, with_day(rows.withColumn("batch", F.explode(batches)), "event_timestamp"))
    maintain.compact(lake, SILVER_LOG)
    return lake


@once
def expired(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver kept for 14 days, errors ingested in the last 7 days, at noon of the last day."""
    lake = Lake(spark, scratch(spark, "expired"), grain="day")
    now = dt.datetime(2024, 1, 30, 12, tzinfo=dt.timezone.utc)
    checked = _stored(spark, wire.with_error(recent_changes.recent_changes(spark, sf_dir)), "checked")
    bronze = route.healthy(checked)
    lake.replace(SILVER, with_hour(m.silver_of(bronze), "event_timestamp"))
    lake.replace(BRONZE, with_ingest(bronze, "landed"))
    events = typed.typed_events(typed.typed_messages(recent_changes.typed_changes(spark, sf_dir)))
    lake.replace(TYPED_EVENTS, with_day(events.withColumn("batch", F.lit("landed")), "timestamp"))
    maintain.set_retention(lake, TYPED_EVENTS, 10)
    maintain.expire(Lake(spark, lake.root, "day"), now, {SILVER.name: 14})
    maintain.delete_ingested_before(lake, BRONZE, now - dt.timedelta(days=7))
    lake.replace(ERRORS, with_ingest(route.broken(checked), "landed"))
    lake.truncate(ERRORS)
    lake.replace(ERRORS, with_ingest(route.broken(checked).where("kafka_partition = 0"), "after"))
    return lake


@once
def snapshot_path(spark: SparkSession, sf_dir: str) -> str:
    at = dt.datetime(2024, 1, 31)
    return maintain.snapshot(live(spark, sf_dir).lake, scratch(spark, "snapshots"), at)


@once
def resorted_path(spark: SparkSession, sf_dir: str) -> str:
    """The older table with user before time as its sort key."""
    path = scratch(spark, "resorted")
    events = live_typed(spark, sf_dir).lake.read(TYPED_EVENTS)
    maintain.resorted(events, path, ["user", "timestamp"], "event_date")
    return path


@once
def native_path(spark: SparkSession, sf_dir: str) -> str:
    """Results of the low-latency variant for silver rows that arrive together, so none is late; a heartbeat then closes the last hours."""
    root = scratch(spark, "native")
    rows = m.silver_rows(m.bronze_of(recent_changes.recent_changes(spark, sf_dir)))
    rows.write.parquet(f"{root}/rows")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/rows")
    stats = live_hourly_stats(stream)
    # All rows arrive at once, so every event is in the state until its hour closes: that must not need the executors' heaps.
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, CLUSTER[STATE_STORE])
    try:
        for at in (None, dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)):
            if at is not None:
                heartbeat(spark, rows.schema, at).write.mode("append").parquet(f"{root}/rows")
            writer = stats.writeStream.format("parquet").outputMode("append")
            _run(writer.option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint"))
    finally:
        spark.conf.set(STATE_STORE, before)
    return f"{root}/out"


@once
def topic_path(spark: SparkSession, sf_dir: str) -> str:
    """Landed lines through the sending side: records as they would go to the topic."""
    root = scratch(spark, "topic")
    lines = recent_changes.framed_lines(spark, sf_dir).select("value")
    lines.write.text(f"{root}/lines")
    sent, _ = messages.outgoing(messages.read_lines(spark, f"{root}/lines"), "ingest")
    _run(messages.write_files(messages.kafka_records(sent), f"{root}/records", f"{root}/checkpoint"))
    return f"{root}/records"
