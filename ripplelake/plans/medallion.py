"""Bronze -> silver -> gold, each step a pure function of DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelake.functions import wire
from ripplelake.functions.scalars import is_anonymous, language_of
from ripplelake.operators.merge import distinct_sketch, keep_latest, merge_sketches, sum_merge
from ripplelake.operators.route import healthy
from ripplelake.schema import COMMENT_CHARS, KEPT_TYPES, LATEST_ACCEPTED_DAYS, SILVER


def bronze_of(stamped: DataFrame) -> DataFrame:
    """Raw messages that are one JSON object each."""
    return healthy(wire.with_error(stamped))


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Typed, validated and enriched rows, one per accepted delivery."""
    return accepted(wire.parse_wire(bronze))


def accepted(parsed: DataFrame, carry: tuple[str, ...] = ("kafka_partition", "kafka_offset")) -> DataFrame:
    """The same from messages whose fields are already parsed."""
    columns: dict[str, Column] = {
        "event_id": wire.unsigned("id"),
        "event_uuid": wire.strict_text("meta.id"),
        "event_type": F.col("type"),
        "namespace": wire.integer("namespace"),
        "title": wire.strict_text("title"),
        "page_id": wire.unsigned("page_id"),
        "user": wire.strict_text("user"),
        "user_is_bot": wire.flag("bot"),
        "wiki": wire.strict_text("wiki"),
        "domain": wire.strict_text("meta.domain"),
        "comment": F.substring(wire.strict_text("comment"), 1, COMMENT_CHARS),
        "is_minor": wire.flag("minor"),
        "is_patrolled": wire.flag("patrolled"),
        "length_old": wire.integer("length.old"),
        "length_new": wire.integer("length.new"),
        "revision_old": wire.unsigned("revision.old"),
        "revision_new": wire.unsigned("revision.new"),
        "event_timestamp": wire.epoch_to_timestamp("timestamp"),
        "ingested_at": F.col("ingested_at"),
    }
    # No other JSON type reads as one of the kept types, so the type needs no closer look.
    kept = parsed.where(F.col("type").isin(*KEPT_TYPES))
    rows = kept.select(*[c.alias(n) for n, c in columns.items()], *carry)
    usable = rows.where("title != '' AND user != ''")
    derived = {
        "user_is_anonymous": is_anonymous("user").cast("int"),
        "language": language_of("wiki"),
        "length_delta": wire.difference("length_new", "length_old"),
    }
    return usable.withColumns(derived).select(*SILVER.columns.fieldNames(), *carry)


def in_time(floor: dt.datetime | None = None) -> Column:
    """The one rule for late rows, of ingestion and replay alike: a row must not be older than the accepted period when
    it is ingested, nor lie before ``floor``, where the log it would be merged into is no longer whole."""
    ts = F.col("event_timestamp")
    young = ts >= F.col("ingested_at") - F.expr(f"INTERVAL {LATEST_ACCEPTED_DAYS} DAYS")
    return young if floor is None else young & (ts >= F.lit(floor))


def silver_of(bronze: DataFrame) -> DataFrame:
    """The silver table: latest delivery of every event."""
    return keep_latest(silver_rows(bronze)).select(*SILVER.columns.fieldNames())


def activity(silver: DataFrame) -> DataFrame:
    """Silver rows in the shape all gold tables are computed from; no shuffle."""
    return silver.selectExpr(
        "date_trunc('hour', event_timestamp) AS hour",
        "to_date(event_timestamp) AS day",
        "wiki",
        "language",
        "user",
        "title",
        "user_is_bot",
        "user_is_anonymous",
        "1L AS edits",
        "CAST(user_is_bot AS BIGINT) AS bot_edits",
        "CAST(user_is_bot = 0 AND user_is_anonymous = 0 AS BIGINT) AS human_edits",
        "CAST(user_is_anonymous AS BIGINT) AS anonymous_edits",
        "CAST(is_minor AS BIGINT) AS minor_edits",
        "length_delta",
        "event_timestamp AS first_at",
        "event_timestamp AS last_at",
    )


def hourly_stats(rows: DataFrame) -> DataFrame:
    """How busy is each site in each hour?"""
    return rows.groupBy("hour", "wiki", "language").agg(
        F.sum("edits").alias("total_edits"),
        F.sum("bot_edits").alias("bot_edits"),
        F.sum("human_edits").alias("human_edits"),
        F.sum("anonymous_edits").alias("anonymous_edits"),
        F.sum("minor_edits").alias("minor_edits"),
        F.count_distinct("user").alias("unique_users"),
        F.count_distinct("title").alias("unique_pages"),
        F.try_sum("length_delta").alias("total_length_delta"),
    )


def user_titles_hourly(rows: DataFrame) -> DataFrame:
    """Partial rows of the daily table, in the shape of ``activity``: ``users_daily`` of them is that of the rows themselves."""
    return rows.groupBy("hour", "wiki", "user", "title").agg(
        F.max("user_is_bot").alias("user_is_bot"),
        F.max("user_is_anonymous").alias("user_is_anonymous"),
        F.sum("edits").alias("edits"),
        F.try_sum("length_delta").alias("length_delta"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


def users_daily(rows: DataFrame) -> DataFrame:
    """What does each user do on each site each day?"""
    return rows.groupBy("day", "wiki", "user").agg(
        F.max("user_is_bot").alias("user_is_bot"),
        F.max("user_is_anonymous").alias("user_is_anonymous"),
        F.sum("edits").alias("edits"),
        F.count_distinct("title").alias("pages_touched"),
        F.try_sum("length_delta").alias("total_length_delta"),
        F.min("first_at").alias("first_edit_at"),
        F.max("last_at").alias("last_edit_at"),
    )


def pages_hourly(rows: DataFrame) -> DataFrame:
    """Which pages are busy in each hour?"""
    return rows.groupBy("hour", "wiki", "title").agg(
        F.sum("edits").alias("edits"),
        F.count_distinct("user").alias("unique_users"),
        F.sum("bot_edits").alias("bot_edits"),
        F.try_sum("length_delta").alias("total_length_delta"),
        F.max("last_at").alias("last_event_at"),
    )


def languages_hourly(rows: DataFrame) -> DataFrame:
    """How are edits spread over languages in each hour?"""
    return rows.groupBy("hour", "language").agg(
        F.count_distinct("wiki").alias("wiki_count"),
        F.sum("edits").alias("total_edits"),
        F.count_distinct("user").alias("unique_users"),
        F.count_distinct("title").alias("unique_pages"),
    )


def sketches_hourly(rows: DataFrame) -> DataFrame:
    """Who edited what in each hour, as sets that merge: the only distinct counts that add up over hours and sites."""
    return distinct_sketch(rows, ["hour", "wiki"], {"users_sketch": "user", "pages_sketch": "title"})


def distinct_over(sketches: DataFrame, by: Sequence[str] = ("wiki",)) -> DataFrame:
    """Approximate users and pages over whatever hours are given."""
    return merge_sketches(sketches, by, {"approx_users": "users_sketch", "approx_pages": "pages_sketch"})


def user_totals(events: DataFrame) -> DataFrame:
    """The per-user rollup of the older design."""
    return events.groupBy("user").agg(F.count("*").alias("edits"))


def stored_user_totals(parts: DataFrame) -> DataFrame:
    """The same from the partial rows that every batch has left."""
    return sum_merge(parts, ["user"], ["edits"])
