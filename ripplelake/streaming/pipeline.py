"""The live path: micro-batches into bronze, errors and the silver log; silver and gold from the log."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.storagelevel import StorageLevel

from ripplelake.functions import wire
from ripplelake.operators import merge, route
from ripplelake.plans import medallion as m
from ripplelake.schema import (
    BRONZE, DEAD_LETTERS, ERRORS, GOLD, HOURLY_STATS, INGEST_FAILURES, INGEST_TOTALS, LANGUAGES, SILVER, SILVER_LOG, SKETCHES,
    TOP_PAGES, TOP_USERS, TOUCHED, TYPED_ERRORS, TYPED_EVENTS, USER_STATS, USER_TITLES, Table,
)
from ripplelake.sources import typed
from ripplelake.sources.lake import Lake, day_folder, with_day, with_hour, with_ingest
from ripplelake.sources.messages import stamped


#: Marks of hours from which rows were deleted begin like this: there may be nothing left to replace them with.
DELETION = "deletion-"


def batch_name(df: DataFrame, batch_id: int) -> str:
    """Same for every try of a batch, different after the positions of a query were thrown away."""
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or 'batch'}-{batch_id:010d}"


def query_of(name: str) -> str:
    return name.rpartition("-")[0]


def ingest_totals(lake: Lake) -> DataFrame:
    """Messages sent, skipped, too late and failed per query, over all batches of its life; from stored rows, one per batch."""
    taken = lake.read(INGEST_TOTALS).select("query", "sent", "skipped", "late", F.lit(0).cast("bigint").alias("failed"), F.lit(1).alias("n"))
    failed = lake.read(INGEST_FAILURES).select("query", *[F.lit(0).cast("bigint").alias(c) for c in ("sent", "skipped", "late")], "failed", F.lit(0).alias("n"))
    return taken.unionByName(failed).groupBy("query").agg(
        *[F.sum(c).alias(c) for c in ("sent", "skipped", "late", "failed")], F.sum("n").alias("batches")
    )


class Pipeline:
    """Ingests message batches into a lake.

    ``policy`` says what happens to broken messages: ``split`` keeps them in the errors table, ``dead_letters`` in
    the dead letter table, ``fail`` stops on the first.  ``budget`` additionally stops on a batch with more broken messages than that.  With
    ``refresh=False`` batches only append, and ``refresh_touched`` runs on its own schedule.
    """

    def __init__(self, lake: Lake, policy: str = "split", budget: int | None = None, refresh: bool = True):
        if policy not in route.POLICIES:
            raise ValueError(f"unknown policy {policy!r}, known: {', '.join(route.POLICIES)}")
        self.lake, self.policy, self.budget, self.refresh = lake, policy, budget, refresh
        self.errors = DEAD_LETTERS if policy == "dead_letters" else ERRORS

    def start(self, messages: DataFrame, checkpoint: str, name: str = "ingest") -> DataStreamWriter:
        """A writer ready to be given a trigger and started."""
        # Stamping happens inside the stream, where the time of a batch is part of its checkpoint.
        return (
            wire.with_error(stamped(messages))
            .observe("ingest", *_totals())
            .writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.ingest)
        )

    def ingest(self, checked: DataFrame, batch_id: int) -> None:
        """Write one batch.  Safe to repeat: every table write replaces the partitions of this batch."""
        try:
            self._ingest(checked, batch_id)
        except Exception as e:
            self._note_failure(checked, batch_id, e)
            raise
        if self.refresh:
            self.refresh_touched()

    def _note_failure(self, checked: DataFrame, batch_id: int, error: Exception) -> None:
        """Every try that ended with an error counts the messages it did not store.  Failing to note it must not hide the error."""
        name = batch_name(checked, batch_id)
        text = f"{type(error).__name__}: {error}"[:300]
        with suppress(Exception):
            row = checked.agg(F.count("*").alias("failed"), F.max("ingested_at").alias("ingested_at")).select(
                F.lit(query_of(name)).alias("query"), "failed", F.lit(text).alias("error"), "ingested_at"
            )
            self.lake.replace(INGEST_FAILURES, with_ingest(row.where("failed > 0"), f"{name}-{uuid.uuid4().hex}"))

    def _ingest(self, checked: DataFrame, batch_id: int) -> None:
        name = batch_name(checked, batch_id)
        parsed = wire.parse_wire(checked).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.policy == "fail":
                route.enforce_budget(parsed, 0)
            elif self.budget is not None:
                route.enforce_budget(parsed, self.budget)
            else:
                # Parsed and kept here: jobs that start side by side would each parse on their own what no executor holds yet.
                parsed.count()
            good = parsed.where("_error = ''")
            rows = m.accepted(good, ("kafka_topic", "kafka_partition", "kafka_offset", "raw_message"))
            in_time = m.in_time(self.lake.whole_days_from())
            late = rows.where(~in_time).withColumn("_error", F.lit("beyond retention"))
            errors = route.broken(parsed).unionByName(route.broken(late))
            fresh = rows.where(in_time).withColumn("batch", F.lit(name))
            bronze = good.select(*BRONZE.columns.fieldNames())
            totals = self.totals(parsed, late, name)
            side_by_side(
                self.lake.spark,
                # One day, or two around midnight: the raw texts are written where they were read.
                lambda: self.lake.replace(BRONZE, with_ingest(bronze, name), gather=False),
                lambda: self.lake.replace(self.errors, with_ingest(errors, name)),
                lambda: self.lake.replace(SILVER_LOG, with_day(fresh, "event_timestamp")),
                lambda: self.lake.replace(INGEST_TOTALS, with_ingest(totals, name)),
            )
            # Marked last: a refresh running elsewhere must not take up a mark before its rows are there.
            hours = with_hour(fresh.select("event_timestamp", "batch"), "event_timestamp")
            self.lake.replace(TOUCHED, hours.select(*TOUCHED.stored.fieldNames()).distinct())
        finally:
            parsed.unpersist()

    @staticmethod
    def totals(checked: DataFrame, late: DataFrame, name: str) -> DataFrame:
        """What a batch took in, as the row that is stored for it."""
        taken = checked.agg(*_totals(), F.max("ingested_at").alias("ingested_at")).where("sent + skipped > 0")
        return taken.select(
            F.lit(query_of(name)).alias("query"), "sent", "skipped", late.agg(F.count("*")).scalar().alias("late"), "ingested_at"
        )

    def refresh_touched(self) -> int:
        """Bring silver and gold up to date with the log; returns the number of hours rebuilt.

        Marks are removed after their hours are rebuilt.  A crash in between repeats the rebuild; a batch that
        arrives meanwhile leaves a mark of its own.
        """
        marks = self.lake.partitions(TOUCHED)
        if not marks:
            return 0
        found = self.lake.read_partitions(TOUCHED, marks).select("event_date", "event_hour").distinct()
        # At most one row per hour of the accepted period, whatever the amount of data.
        hours = found.collect()
        if any(mark.startswith(f"batch={DELETION}") for mark in marks):
            clear(self.lake, hours)
        rebuild(self.lake, hours)
        self.lake.drop(TOUCHED, marks)
        return len(hours)


def _totals() -> list:
    ok = F.col("_error") == ""
    return [F.count_if(ok).alias("sent"), F.count_if(~ok).alias("skipped")]


def log_of(lake: Lake, hours: Sequence[Row]) -> DataFrame:
    """Log rows of these hours, or of their whole days where the lake is refreshed by day.

    Only files of their days whose bounds meet the hours are opened.
    """
    starts = [start_of(h) for h in hours]
    days = {day_folder(h["event_date"]) for h in hours}
    if lake.grain == "day":
        return lake.read_partitions(SILVER_LOG, days)
    ts = F.col("event_timestamp")
    log = lake.read_partitions(SILVER_LOG, days)
    return log.where(
        (ts >= min(starts))
        & (ts < max(starts) + dt.timedelta(hours=1))
        & F.date_trunc("hour", ts).isin(starts)
    )


def start_of(hour: Row) -> dt.datetime:
    return dt.datetime.combine(hour["event_date"], dt.time(hour["event_hour"]), dt.timezone.utc)


def rebuild(lake: Lake, hours: Sequence[Row]) -> None:
    """Recompute silver and gold of these hours from the log.

    Events of one key share their timestamp, so duplicates never cross hours, and nothing but these hours is read of silver.  The daily
    table is merged from partial rows per hour, of which only those of these hours are made anew.  Tables that do not depend on each
    other are written side by side.

    Days whose log is no longer whole are left as they are: what is stored of them is all there is.  Gold keeps rows
    longer than silver, so where silver has given up a part of these days, gold is computed from the log.
    """
    whole = lake.whole_days_from()
    hours = [h for h in hours if start_of(h) >= whole]
    if not hours:
        return
    folders = sorted({lake.refresh_folder(h) for h in hours})
    days = sorted({day_folder(h["event_date"]) for h in hours})

    latest = merge.keep_latest(log_of(lake, hours))
    lake.replace(SILVER, with_hour(lake.unexpired(SILVER, latest), "event_timestamp"))

    first_day = min(start_of(h) for h in hours).replace(hour=0)
    touched = m.activity(lake.read_partitions(SILVER, folders) if lake.floor(SILVER) <= first_day else latest)

    def write(table: Table, rows: DataFrame) -> None:
        lake.replace(table, lake.unexpired(table, rows))

    side_by_side(
        lake.spark,
        lambda: write(HOURLY_STATS, with_hour(m.hourly_stats(touched), "hour")),
        lambda: write(TOP_PAGES, with_hour(m.pages_hourly(touched), "hour")),
        lambda: write(LANGUAGES, with_hour(m.languages_hourly(touched), "hour")),
        lambda: write(SKETCHES, with_hour(m.sketches_hourly(touched), "hour")),
        lambda: write(USER_TITLES, with_hour(m.user_titles_hourly(touched), "hour")),
    )
    parts = lake.read_partitions(USER_TITLES, days).withColumn("day", F.to_date("hour"))
    write(TOP_USERS, with_day(m.users_daily(parts), "day"))


def clear(lake: Lake, hours: Sequence[Row]) -> None:
    """Remove what is stored of these hours after all their rows went from the log; ``rebuild`` only replaces."""
    left = with_hour(lake.read_partitions(SILVER_LOG, {day_folder(h["event_date"]) for h in hours}), "event_timestamp")
    held = left.select("event_date", "event_hour").distinct().collect()  # hours of the accepted period at most
    held_days = {day_folder(h["event_date"]) for h in held}
    whole = lake.whole_days_from()
    gone = [h for h in hours if start_of(h) >= whole]
    folders = {lake.refresh_folder(h) for h in gone} - {lake.refresh_folder(h) for h in held}
    days = {day_folder(h["event_date"]) for h in gone} - held_days
    for table in (SILVER, *GOLD, SKETCHES, USER_TITLES):
        lake.drop(table, sorted(days if table is TOP_USERS else folders | days))


def side_by_side(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Run independent Spark jobs at the same time; small ones would leave most of a cluster idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


class TypedPipeline:
    """The live path of the older design: typed rows, their errors, and edits per user."""

    def __init__(self, lake: Lake):
        self.lake = lake

    def start(self, messages: DataFrame, checkpoint: str, name: str = "typed") -> DataStreamWriter:
        return (
            typed.typed_messages(stamped(messages))
            .writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.ingest)
        )

    def ingest(self, checked: DataFrame, batch_id: int) -> None:
        name = batch_name(checked, batch_id)
        checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = with_day(typed.typed_events(checked).withColumn("batch", F.lit(name)), "timestamp")
            edits = rows.groupBy("event_date", "batch", "user").agg(F.count("*").alias("edits"))
            side_by_side(
                self.lake.spark,
                lambda: self.lake.replace(TYPED_EVENTS, rows),
                lambda: self.lake.replace(USER_STATS, edits),
                lambda: self.lake.replace(TYPED_ERRORS, with_ingest(route.broken(checked), name)),
            )
        finally:
            checked.unpersist()
