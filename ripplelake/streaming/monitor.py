"""Ingestion status, lag and dataflow health, from the progress Spark reports for its queries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ripplelake.operators.report import AsOf, moment

PROGRESS = (
    "id string, name string, batchId bigint, timestamp timestamp, numInputRows bigint, "
    "inputRowsPerSecond double, processedRowsPerSecond double, "
    "sources array<struct<description: string, startOffset: string, endOffset: string, latestOffset: string, "
    "numInputRows: bigint, metrics: map<string, string>>>, "
    "observedMetrics map<string, struct<sent: bigint, skipped: bigint>>"
)


def progress(spark: SparkSession, reports: list[str]) -> DataFrame:
    """Progress reports (one JSON text per micro-batch) as rows."""
    texts = spark.createDataFrame([(r,) for r in reports], "report string")
    return texts.select(F.inline(F.array(F.from_json("report", PROGRESS))))


def reports_of(query: StreamingQuery) -> list[str]:
    return [p.json if hasattr(p, "json") else json.dumps(p) for p in query.recentProgress]


TOTALS = (
    "id string, name string, messages_read bigint, batches bigint, sent bigint, skipped bigint, failed bigint, "
    "last_batch bigint, last_poll_time timestamp"
)


class ProgressLog(StreamingQueryListener):
    """Folds the reports of all queries of a session into running totals, however many batches there are.

    A few numbers per query are kept, and the latest reports as Spark does.  A batch that is tried again counts once;
    ``failed`` counts the runs of a query that ended with an error.
    """

    def __init__(self, keep: int = 1000):
        self.keep, self.reports, self.failures, self.counts = keep, [], {}, {}

    def _of(self, id_: str) -> dict:
        empty = {"name": None, "messages": 0, "batches": 0, "sent": 0, "skipped": 0, "failed": 0, "last": -1, "polled": None}
        return self.counts.setdefault(id_, empty)

    def add(self, report: str) -> None:
        one = json.loads(report)
        mine = self._of(one["id"])
        mine["name"], mine["polled"] = one.get("name"), one["timestamp"]
        if one["batchId"] > mine["last"]:
            seen = (one.get("observedMetrics") or {}).get("ingest") or {}
            mine["last"] = one["batchId"]
            mine["batches"] += 1
            mine["messages"] += one.get("numInputRows") or 0
            mine["sent"] += seen.get("sent") or 0
            mine["skipped"] += seen.get("skipped") or 0

    def totals(self, spark: SparkSession) -> DataFrame:
        """One row per query."""
        rows = [
            (i, c["name"], c["messages"], c["batches"], c["sent"], c["skipped"], c["failed"], c["last"], c["polled"])
            for i, c in sorted(self.counts.items())
        ]
        texts = spark.createDataFrame(rows, TOTALS.replace("last_poll_time timestamp", "last_poll_time string"))
        return texts.withColumn("last_poll_time", F.col("last_poll_time").cast("timestamp"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.reports = [*self.reports, event.progress.json][-self.keep :]
        self.add(event.progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.id)] = event.exception
            self._of(str(event.id))["failed"] += 1


def ingestion_status(reports: DataFrame, failures: dict[str, str] | None = None) -> DataFrame:
    """Per query: messages read, batches, last poll, positions, last failure."""
    last = F.max_by(F.struct("timestamp", "sources"), "batchId")
    status = reports.groupBy("id", "name").agg(
        F.sum("numInputRows").alias("messages_read"),
        F.count_distinct("batchId").alias("batches"),
        F.try_sum(F.col("observedMetrics")["ingest"]["sent"]).alias("sent"),
        F.try_sum(F.col("observedMetrics")["ingest"]["skipped"]).alias("skipped"),
        last.alias("last"),
    )
    failure = F.lit(None).cast("string")
    for query, text in (failures or {}).items():
        failure = F.when(F.col("id") == query, F.lit(text)).otherwise(failure)
    return status.select(
        "id", "name", "messages_read", "batches", "sent", "skipped",
        F.col("last.timestamp").alias("last_poll_time"),
        F.col("last.sources.endOffset").alias("positions"),
        failure.alias("last_exception"),
    )


def consumer_lag(reports: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Per query: seconds since its last poll, and how far its sources are behind where they say so."""
    newest = reports.groupBy("id", "name").agg(F.max_by(F.struct("timestamp", "sources"), "batchId").alias("last"))
    behind = F.transform("last.sources", lambda s: s["metrics"]["maxOffsetsBehindLatest"].cast("bigint"))
    return newest.select(
        "id",
        "name",
        F.col("last.timestamp").alias("last_poll_time"),
        F.timestamp_diff("SECOND", F.col("last.timestamp"), moment(as_of)).alias("seconds_since_last_poll"),
        F.array_max(behind).alias("offsets_behind"),
    )


def dataflow_health(spark: SparkSession) -> DataFrame:
    """The running queries of the session and what they are doing."""
    rows = [
        (str(q.id), q.name, q.isActive, q.status["message"], bool(q.status["isDataAvailable"]), str(q.exception() or ""))
        for q in spark.streams.active
    ]
    return spark.createDataFrame(
        rows, "id string, name string, active boolean, message string, data_available boolean, failure string"
    )
