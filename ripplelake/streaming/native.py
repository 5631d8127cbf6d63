"""Low-latency variant: windowed counts kept in streaming state.

Unlike the recomputed gold tables it drops rows later than ``delay`` and estimates distinct counts.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelake.schema import SILVER_KEY, SILVER_NEWEST


#: Tasks that one site's events of an hour are dealt over before they are counted.
SHARES = 4

#: Type of the rows that only say how late it is.
HEARTBEAT = "heartbeat"


def heartbeat(spark: SparkSession, schema: T.StructType, at: dt.datetime) -> DataFrame:
    """A row that tells a quiet stream the time, so that hours before ``at`` less the delay are closed; it is not counted itself."""
    row = {"event_type": HEARTBEAT, "event_timestamp": at}
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields)], nullable)


def dropped_late(reports: list[str]) -> int:
    """Rows that came after their hour was closed, from the reports of a query's batches."""
    operators = [o for r in reports for o in json.loads(r).get("stateOperators", [])[-1:]]
    return sum(o.get("numRowsDroppedByWatermark", 0) for o in operators)


def live_hourly_stats(rows: DataFrame, delay: str = "2 hours") -> DataFrame:
    """``rows`` is a stream of accepted deliveries; results come out once an hour is closed.

    Deliveries of one event are merged by an aggregation, which combines them inside every map task before the
    shuffle; ``dropDuplicates`` would send each of a million copies to the same task.
    """
    kept = F.struct("language", "user", "title", "user_is_bot", "user_is_anonymous", "length_delta")
    latest = F.max_by(kept, F.struct(*SILVER_NEWEST)).alias("event")
    marked = rows.withWatermark("event_timestamp", delay)
    # A condition on the time itself stays above the watermark, which heartbeats are there to move.
    events = marked.where((F.col("event_type") != HEARTBEAT) | F.col("event_timestamp").isNull())
    once = events.groupBy(*SILVER_KEY).agg(latest)
    # Sketches are 13 KB each, and an hour's events stand in all tasks by now: gathered while they are small rows, a group makes a few
    # partial sketches instead of one per task, often one per event.  A share of the users per task keeps a busy site spread.
    hour, share = F.date_trunc("hour", "event_timestamp"), F.pmod(F.xxhash64("user"), F.lit(SHARES))
    flat = once.select("event_timestamp", "wiki", "event.*").repartition(hour, "wiki", "language", share)
    stats = flat.groupBy(F.window("event_timestamp", "1 hour"), "wiki", "language").agg(
        F.count("*").alias("total_edits"),
        F.count_if(F.expr("user_is_bot = 1")).alias("bot_edits"),
        F.count_if(F.expr("user_is_bot = 0 AND user_is_anonymous = 0")).alias("human_edits"),
        F.count_if(F.expr("user_is_anonymous = 1")).alias("anonymous_edits"),
        F.approx_count_distinct("user", 0.01).alias("approx_users"),
        F.approx_count_distinct("title", 0.01).alias("approx_pages"),
        F.try_sum("length_delta").alias("total_length_delta"),
    )
    return stats.withColumn("hour", F.col("window.start")).drop("window")
