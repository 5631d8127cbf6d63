"""Every query by name, computed from the source tables: messages -> bronze -> silver -> gold -> query."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelake.functions import scalars, wire
from ripplelake.operators import merge, report, route
from ripplelake.plans import catalogue as c
from ripplelake.plans import lakes, maintain
from ripplelake.plans import medallion as m
from ripplelake.plans.oracle import AS_OF, RATE_AS_OF
from ripplelake.schema import (
    BRONZE, DEAD_LETTERS, ERRORS, GOLD, HOURLY_STATS, LANGUAGES, SILVER, SILVER_LOG, SKETCH_BITS, SKETCHES, TOP_PAGES, TOP_USERS,
    TYPED_ERRORS, TYPED_EVENTS, USER_STATS, Table,
)
from ripplelake.session import use_utc
from ripplelake.sources import messages, recent_changes, typed
from ripplelake.sources.lake import Lake
from ripplelake.streaming.pipeline import ingest_totals

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """The tables of one source folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = use_utc(spark), sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        return recent_changes.framed_lines(self.spark, self.sf_dir)

    @cached_property
    def sent(self) -> DataFrame:
        return messages.outgoing(self.lines)[0]

    @cached_property
    def stamped(self) -> DataFrame:
        return recent_changes.recent_changes(self.spark, self.sf_dir)

    @cached_property
    def checked(self) -> DataFrame:
        return wire.with_error(self.stamped)

    @cached_property
    def bronze(self) -> DataFrame:
        return route.healthy(self.checked)

    @cached_property
    def errors(self) -> DataFrame:
        return route.broken(self.checked)

    @cached_property
    def silver(self) -> DataFrame:
        return m.silver_of(self.bronze)

    @cached_property
    def activity(self) -> DataFrame:
        return m.activity(self.silver)

    @cached_property
    def stats(self) -> DataFrame:
        return m.hourly_stats(self.activity)

    @cached_property
    def users(self) -> DataFrame:
        return m.users_daily(self.activity)

    @cached_property
    def pages(self) -> DataFrame:
        return m.pages_hourly(self.activity)

    @cached_property
    def languages(self) -> DataFrame:
        return m.languages_hourly(self.activity)

    @cached_property
    def typed(self) -> DataFrame:
        return typed.typed_messages(recent_changes.typed_changes(self.spark, self.sf_dir))

    @cached_property
    def wiki_events(self) -> DataFrame:
        return typed.typed_events(self.typed)

    @cached_property
    def live(self) -> lakes.Live:
        """The tables as the live path leaves them."""
        return lakes.live(self.spark, self.sf_dir)

    def kept(self, table: Table) -> DataFrame:
        """A stored table with its partition columns, so that time ranges prune."""
        return self.live.lake.read(table)

    @cached_property
    def kept_typed(self) -> DataFrame:
        return lakes.live_typed(self.spark, self.sf_dir).lake.read(TYPED_EVENTS)

    def stored(self, *tables: Table) -> dict[str, DataFrame]:
        return {t.name: self.live.lake.read(t) for t in tables}


def _past(silver: DataFrame) -> DataFrame:
    """Rows before a fixed moment, told by the current time: all are moved by what has passed since that moment."""
    since = F.unix_micros(F.current_timestamp()) - F.unix_micros(F.lit("2024-01-16 00:00:00").cast("timestamp"))
    moved = F.timestamp_micros(F.unix_micros("event_timestamp") + since)
    return silver.where(moved < F.current_timestamp()).agg(F.count("*").alias("past"))


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps as zoneless UTC wall clock times, which is how other engines show them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _mistyped(t: Inputs) -> DataFrame:
    """In six of seven messages one field has the wrong JSON type."""
    events = recent_changes.with_k(t.source("events"))
    n = F.col("event_id") % 7

    def member(name: str, wrong: int, odd: str, usual: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), F.when(n == wrong, odd).otherwise(usual))

    quoted = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    raw = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            member("id", 3, '"abc"', F.col("event_id").cast("string")),
            member("title", 4, "5", quoted(F.col("user_id"))),
            member("namespace", 5, '"x"', F.col("k").cast("string")),
            member("bot", 6, '"yes"', (F.col("k") % 2 == 0).cast("string")),
            F.concat(F.lit('"meta":{'), member("id", 2, "12", quoted(F.lit("u"), F.col("event_id"))), F.lit("}")),
        ),
        F.lit("}"),
    )
    return wire.parse_wire(events.select("event_id", raw.alias("raw_message"))).select(
        "event_id",
        wire.unsigned("id").alias("id"),
        wire.strict_text("title").alias("title"),
        wire.integer("namespace").alias("namespace"),
        wire.flag("bot").alias("bot"),
        wire.strict_text("meta.id").alias("uuid"),
    )


def _document_rows(t: Inputs) -> DataFrame:
    rows = m.silver_of(m.bronze_of(recent_changes.document_changes(t.spark, t.sf_dir)))
    return rows.select(
        "event_id", "title", "user", "wiki", "language", "comment", "length_new", "length_delta", "event_timestamp"
    )


ADDITIVE_STATS = [
    "total_edits", "bot_edits", "human_edits", "anonymous_edits", "minor_edits", "total_length_delta",
]


def _sum_merged(t: Inputs) -> DataFrame:
    """Partial rows, one per author kind, merged into the hourly totals."""
    rows = t.activity
    parts = rows.groupBy("hour", "wiki", "language", "user_is_bot", "user_is_anonymous").agg(
        *[F.sum(x).alias("total_edits" if x == "edits" else x) for x in
          ("edits", "bot_edits", "human_edits", "anonymous_edits", "minor_edits")],
        F.sum("length_delta").alias("total_length_delta"),
    )
    return merge.sum_merge(parts, ["hour", "wiki", "language"], ADDITIVE_STATS)


def _merged_sketches(t: Inputs) -> DataFrame:
    """Users and pages per site and half of the month from the sketches stored with gold, against exact counts.

    The estimates stand as numbers where the error bound is under half a user, else as the exact count if within it.
    """
    half = F.when(F.col("hour") < F.lit("2024-01-16").cast("timestamp"), 1).otherwise(2).alias("half")
    rows = m.activity(t.live.lake.read(SILVER))
    exact = rows.groupBy("wiki", half).agg(F.count_distinct("user").alias("users"), F.count_distinct("title").alias("pages"))
    stored = t.live.lake.read(SKETCHES).withColumn("half", half)
    both = m.distinct_over(stored, ["wiki", "half"]).join(exact, ["wiki", "half"])

    def settled(approx: str, name: str) -> Column:
        bound = F.greatest(F.lit(0.5), F.col(name) * (3 * 0.83 / 2 ** (SKETCH_BITS / 2)))
        return F.when(F.abs(F.col(approx) - F.col(name)) <= bound, F.col(name)).otherwise(F.col(approx)).cast("bigint").alias(approx)

    return both.select("wiki", "half", settled("approx_users", "users"), settled("approx_pages", "pages"))


def _with_stale_versions(df: DataFrame, version: str, measure: str) -> DataFrame:
    """Every row twice: as it is, and an older version with another measure."""
    twice = df.withColumn("age", F.explode(F.array(F.lit(0), F.lit(1))))
    older = {
        version: F.col(version) - F.col("age") * F.expr("INTERVAL 1 MINUTE"),
        measure: F.when(F.col("age") == 0, F.col(measure)).otherwise(0),
    }
    return twice.withColumns(older).drop("age")


TABLE: dict[str, Callable[[Inputs], DataFrame]] = {
    # 2.1 sources, sinks, ingestion
    "s01_frames": lambda t: messages.frames(t.lines),
    "s02_json_validity": lambda t: wire.with_error(messages.frames(t.lines)).select("event_id", "_error"),
    "s03_message_key": lambda t: t.sent.select("event_id", "kafka_key"),
    "s04_value_bytes": lambda t: t.stamped.select(
        "kafka_partition", "kafka_offset", messages.value_bytes().alias("value")
    ).select(
        "kafka_partition",
        "kafka_offset",
        F.md5("value").alias("value_md5"),
        F.octet_length("value").cast("bigint").alias("value_bytes"),
    ),
    "s05_key_bytes": lambda t: t.sent.select("event_id", messages.key_bytes().alias("key")).select(
        "event_id", F.hex("key").alias("key_hex")
    ),
    "s06_kafka_records": lambda t: messages.kafka_records(t.sent).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic"
    ),
    "s07_ingest_counters": lambda t: messages.ingest_counters(t.lines),
    "s08_raw_messages": lambda t: t.stamped.select("kafka_partition", "kafka_offset", "raw_message"),
    "s08b_typed_messages": lambda t: t.wiki_events,
    "s09_record_metadata": lambda t: t.checked.drop("raw_message"),
    "s10_dead_letters": lambda t: lakes.with_dead_letters(t.spark, t.sf_dir).read(DEAD_LETTERS).select(*ERRORS.columns.fieldNames()),
    "s10_failed_messages": lambda t: ingest_totals(lakes.failing(t.spark, t.sf_dir)).select("sent", "failed", "batches"),
    "s11_broken_budget": lambda t: route.broken_budget(t.checked),
    "s15_peek": lambda t: messages.peek(
        reduce(DataFrame.unionByName, [t.live.lake.peek(x).select("kafka_partition", "kafka_offset", "raw_message") for x in (BRONZE, ERRORS)])
    ),
    # 2.2 projections and filters
    "p01_healthy_route": lambda t: t.bronze.select("kafka_partition", "kafka_offset", "kafka_key", "ingested_at"),
    "p02_error_route": lambda t: t.errors.drop("raw_message"),
    "p03_silver_projection": lambda t: m.silver_rows(t.bronze),
    "p03_whole_documents": _document_rows,
    "p04_silver_validation": lambda t: m.silver_rows(t.bronze).groupBy("event_type").agg(F.count("*").alias("kept")),
    "p05_flag_equality": lambda t: t.silver.where("user_is_bot = 0 AND user_is_anonymous = 0").select("event_id", "user"),
    "p06_prefix_exclusion": lambda t: t.wiki_events.where(~scalars.is_anonymous("user")).select("user", "timestamp"),
    "p07_positive_delta": lambda t: t.silver.where(F.col("length_delta") > 0).select("event_id", "length_delta"),
    "p08_trailing_range": lambda t: report.trailing(t.kept(HOURLY_STATS), "hour", "24 HOURS", AS_OF).drop("event_date"),
    "p09_hour_filter": lambda t: report.between_hours(
        t.kept(TOP_PAGES), "2024-01-10 06:00:00", "2024-01-12 18:00:00"
    ).drop("event_date"),
    "p10_total_alert": lambda t: c.total_edits_alert(t.silver, 1000),
    "p10_busy_hours_alert": lambda t: c.busy_hours_alert(t.stats, 10),
    "p11_preview": lambda t: route.preview(t.errors, 300),
    "p12_renamed_columns": lambda t: t.bronze.select(
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_key"
    ),
    "p13_ingestion_stamp": lambda t: t.bronze.groupBy(F.to_date("ingested_at").alias("ingest_date")).agg(
        F.count("*").alias("rows")
    ),
    # 2.4 aggregate functions
    "a01_count": lambda t: t.silver.groupBy("wiki").agg(F.count("*").alias("n")),
    "a02_count_if": lambda t: t.silver.groupBy("wiki").agg(F.count_if(F.col("is_minor") == 1).alias("n")),
    "a03_sum": lambda t: t.silver.groupBy("wiki").agg(F.sum("length_delta").alias("n")),
    "a04_sum_of_flag": lambda t: t.silver.groupBy("wiki").agg(F.sum("user_is_bot").alias("n")),
    "a05_exact_distinct": lambda t: t.silver.groupBy("wiki").agg(
        F.count_distinct("user").alias("users"), F.count_distinct("title").alias("pages")
    ),
    "a06_any": lambda t: t.silver.groupBy("user").agg(F.max("user_is_bot").alias("user_is_bot")),
    "a07_min_max": lambda t: t.silver.groupBy("user").agg(
        F.min("event_timestamp").alias("first_at"), F.max("event_timestamp").alias("last_at")
    ),
    "a08_avg": lambda t: t.wiki_events.groupBy("bot").agg(F.round(F.avg(F.length("comment")), 4).alias("n")),
    "a09_count_distinct": lambda t: t.silver.agg(F.count_distinct(F.to_date("event_timestamp")).alias("days")),
    # 2.5 gold
    "g1_hourly_stats": lambda t: t.stats,
    "g2_users_daily": lambda t: t.users,
    "g3_pages_hourly": lambda t: t.pages,
    "g4_languages_hourly": lambda t: t.languages,
    "g5b_user_totals": lambda t: m.user_totals(t.wiki_events),
    # 2.6 merges
    "r1_keep_latest_silver": lambda t: t.silver,
    "r2_keep_latest_gold_users": lambda t: merge.keep_latest(
        _with_stale_versions(t.users, "last_edit_at", "edits"), ["day", "wiki", "user"], ["last_edit_at"]
    ),
    "r2_keep_latest_gold_pages": lambda t: merge.keep_latest(
        _with_stale_versions(t.pages, "last_event_at", "edits"), ["hour", "wiki", "title"], ["last_event_at"]
    ),
    "r3_sum_merge": _sum_merged,
    "r3_merged_sketches": _merged_sketches,
    # 2.7 windows
    "w1_share_of_total": lambda t: report.share_of_total(t.wiki_events, ["bot"]),
    "w1_share_of_users": lambda t: report.share_of_total(t.wiki_events, ["user"]),
    "w2_busiest_users_per_day": lambda t: c.busiest_users_per_day(t.users),
    "w2_hottest_pages_per_hour": lambda t: c.hottest_pages_per_hour(t.pages),
    # 2.8 sorting
    "o1_top_by_aggregate": lambda t: report.top_counts(t.silver, ["title"], 15),
    "o2_top_by_column": lambda t: report.top(t.silver, 10, "length_new", "event_timestamp", "wiki", "event_id").select(
        "event_id", "length_new"
    ),
    "o3_newest_buckets": lambda t: report.buckets(t.silver, "minute", "event_timestamp", "edits")
    .orderBy(F.desc("minute"))
    .limit(20),
    "o4_full_order": lambda t: t.silver.groupBy("user").agg(F.count("*").alias("edits")).orderBy(F.desc("edits"), "user"),
    # 2.9 set operations
    "u1_gold_row_counts": lambda t: report.row_counts(t.stored(*GOLD)),
    "u2_layer_health": lambda t: report.row_counts(t.stored(BRONZE, SILVER, HOURLY_STATS, ERRORS)),
    # 2.10 scalar functions
    "f01_f06_json_fields": lambda t: t.silver.select(
        "event_id", "namespace", "title", "is_patrolled", "length_old", "length_new", "length_delta", "revision_old", "domain"
    ),
    "f01_f04_mistyped_fields": _mistyped,
    "f07_like": lambda t: t.silver.where(scalars.is_anonymous("user")).select("event_id"),
    "f08_language": lambda t: t.silver.groupBy("wiki", scalars.language_of("wiki").alias("language")).agg(
        F.count("*").alias("n")
    ),
    "f09_substring": lambda t: t.source("conversations").select(
        "conv_id", "turn", F.substring("text", 1, 100).alias("head")
    ),
    "f10_length": lambda t: t.stamped.select("kafka_partition", "kafka_offset", F.length("raw_message").cast("bigint").alias("chars")),
    "f11_f12_arithmetic": lambda t: t.silver.where("namespace >= 4 AND namespace < 12 AND event_type != 'new'").select(
        "event_id",
        wire.difference("length_new", "length_old").alias("delta"),
        F.round(F.col("length_new") * F.lit(100.0) / 3, 4).alias("scaled"),
    ),
    "f13_f18_time_buckets": lambda t: t.silver.select(
        "event_id",
        "event_timestamp",
        scalars.start_of("hour", "event_timestamp").alias("hour"),
        scalars.start_of("minute", "event_timestamp").alias("minute"),
        scalars.start_of("second", "ingested_at").alias("second"),
        F.to_date("event_timestamp").alias("day"),
    ),
    "f14_now": lambda t: _past(t.silver),
    "f19_date_numbers": lambda t: t.silver.select(
        "event_id",
        scalars.day_number("event_timestamp").alias("yyyymmdd"),
        scalars.month_number("event_timestamp").alias("yyyymm"),
    ),
    "f20_intervals": lambda t: t.silver.select(
        "event_id",
        (F.col("event_timestamp") + F.expr("INTERVAL 7 DAYS")).alias("later"),
        (F.col("event_timestamp") - F.expr("INTERVAL 90 MINUTES")).alias("earlier"),
    ),
    "f21_f22_seconds_between": lambda t: t.silver.select(
        "event_id", scalars.seconds_between("event_timestamp", "ingested_at").alias("lag_seconds")
    ),
    "f23_round": lambda t: t.source("events").select("event_id", F.round(F.floor("value") / F.lit(8.0), 2).alias("r")),
    "f24_readable_size": lambda t: t.source("events").select(
        "event_id", scalars.readable_size(F.col("event_id") * F.col("event_id") * 64).alias("size")
    ),
    # 2.13 catalogue
    "q01_bronze_rows": lambda t: c.total(t.bronze),
    "q02_error_rows": lambda t: c.total(t.errors),
    "q03_bronze_range": lambda t: c.bronze_range(t.bronze),
    "q04_total_edits": lambda t: c.total(t.silver, "total_edits"),
    "q05_silver_overview": lambda t: c.silver_overview(t.silver),
    "q06_languages": lambda t: c.language_distribution(t.silver),
    "q07_event_types": lambda t: c.type_distribution(t.silver),
    "q08_top_human_users": lambda t: c.top_human_users(t.silver),
    "q09_top_wikis": lambda t: c.top_wikis(t.silver),
    "q10_author_mix": lambda t: c.author_mix(t.silver),
    "q11_largest_growth": lambda t: c.largest_growth(t.silver),
    "q12_latest_hours": lambda t: c.latest_hours(t.silver),
    "q13_latest_changes": lambda t: c.latest_changes(t.silver),
    "q14_latest_errors": lambda t: c.latest_errors(t.errors),
    "q15_errors_by_type": lambda t: c.errors_by_type(route.broken(t.typed)),
    "q16_error_trend": lambda t: c.error_trend(t.kept(ERRORS), AS_OF),
    "q17_hourly_authors": lambda t: c.hourly_authors(t.kept(HOURLY_STATS), AS_OF),
    "q18_hourly_edits": lambda t: c.hourly_edits(t.kept(HOURLY_STATS), AS_OF),
    "q19_top_human_users_gold": lambda t: c.top_human_users_daily(t.kept(TOP_USERS)),
    "q20_language_share": lambda t: c.language_share(t.kept(LANGUAGES), AS_OF),
    "q21_top_pages": lambda t: c.top_pages(t.kept(TOP_PAGES), AS_OF),
    "q22b_total_events": lambda t: c.total(t.wiki_events, "total_events"),
    "q23b_top_users": lambda t: c.top_users(t.wiki_events),
    "q24b_bot_share": lambda t: c.bot_share(t.wiki_events),
    "q25b_most_edited": lambda t: c.most_edited(t.wiki_events),
    "q26b_latest_minutes": lambda t: c.latest_minutes(t.wiki_events),
    "q27b_registered_users": lambda t: c.registered_users(t.wiki_events),
    "q28b_top_bots": lambda t: c.top_bots(t.wiki_events),
    "q29b_ingestion_rate": lambda t: c.ingestion_rate(t.kept_typed, RATE_AS_OF),
    "q30b_processing_lag": lambda t: c.processing_lag(t.kept_typed, RATE_AS_OF),
    "q31_gold_row_counts": lambda t: report.row_counts(t.stored(*GOLD)),
    "q32_layer_health": lambda t: report.row_counts(t.stored(BRONZE, SILVER, HOURLY_STATS, ERRORS)),
}


def _stored(table: Table) -> Callable[[Inputs], DataFrame]:
    """A table as the live path left it."""
    return lambda t: t.live.lake.read(table).select(*table.columns.fieldNames())


def _by_hour(table: Table) -> Callable[[Inputs], DataFrame]:
    return lambda t: lakes.live_hours(t.spark, t.sf_dir).read(table).select(*table.columns.fieldNames())


def _deleted(table: Table) -> Callable[[Inputs], DataFrame]:
    return lambda t: lakes.deleted(t.spark, t.sf_dir).read(table).select(*table.columns.fieldNames())


def _merged(table: Table) -> Callable[[Inputs], DataFrame]:
    return lambda t: lakes.compacted_bronze(t.spark, t.sf_dir).read(table).select(*table.columns.fieldNames())


def _replayed(table: Table) -> Callable[[Inputs], DataFrame]:
    return lambda t: lakes.replayed(t.spark, t.sf_dir).read(table).select(*table.columns.fieldNames())


#: A range of time in the middle of a day, both ends included.
RANGE = tuple(dt.datetime(2024, 1, 12, h, 30, tzinfo=dt.timezone.utc) for h in (5, 17))


def _sorted_files(lake: Lake) -> DataFrame:
    """Per day, what the bounds of its files say, and how often rows break the sort key, which is never."""
    bounds = maintain.file_bounds(lake, SILVER).groupBy(F.substring_index("folder", "=", -1).cast("date").alias("event_date")).agg(
        F.sum("rows").alias("rows"), F.min("low_event_timestamp").alias("first"), F.max("high_event_timestamp").alias("last")
    )
    return bounds.join(maintain.out_of_order(lake, SILVER), "event_date")


def _sizes(t: Inputs) -> DataFrame:
    return maintain.table_sizes(t.live.lake, [BRONZE, ERRORS, SILVER, *GOLD])


STORED: dict[str, Callable[[Inputs], DataFrame]] = {
    # 2.1 sinks, 2.11 streaming: the tables after all micro-batches
    "s07_stream_counters": lambda t: ingest_totals(t.live.lake).select(
        (F.col("sent") + F.col("skipped")).alias("messages_read"), "sent", "skipped", "late", "failed"
    ),
    "s16_bronze_sink": _stored(BRONZE),
    "s17_errors_sink": _stored(ERRORS),
    "s18_silver_log_sink": _stored(SILVER_LOG),
    "s18_silver_sink": _stored(SILVER),
    "s19_hourly_stats_sink": _stored(HOURLY_STATS),
    "s19_users_daily_sink": _stored(TOP_USERS),
    "s19_pages_hourly_sink": _stored(TOP_PAGES),
    "s19_languages_hourly_sink": _stored(LANGUAGES),
    **{f"s19_{t.name.removeprefix('gold_')}_by_hour": _by_hour(t) for t in GOLD},
    "s20b_typed_sink": lambda t: lakes.live_typed(t.spark, t.sf_dir).lake.read(TYPED_EVENTS).select(
        *TYPED_EVENTS.columns.fieldNames()
    ),
    "s20b_typed_errors_sink": lambda t: lakes.live_typed(t.spark, t.sf_dir).lake.read(TYPED_ERRORS).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "error_message", "ingested_at"
    ),
    "g5b_stored_user_totals": lambda t: m.stored_user_totals(lakes.live_typed(t.spark, t.sf_dir).lake.read(USER_STATS)),
    "s06_streamed_records": lambda t: t.spark.read.parquet(lakes.topic_path(t.spark, t.sf_dir)).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic"
    ),
    "s21_snapshot": lambda t: t.spark.read.parquet(lakes.snapshot_path(t.spark, t.sf_dir)).select(
        *SILVER.columns.fieldNames()
    ),
    "t03_tumbling_windows": lambda t: t.silver.groupBy(F.window("event_timestamp", "1 hour").start.alias("hour")).agg(
        F.count("*").alias("edits")
    ),
    "t04_watermark_variant": lambda t: t.spark.read.parquet(lakes.native_path(t.spark, t.sf_dir)),
    "t04_watermark_variant_exact": lambda t: t.spark.read.parquet(lakes.native_path(t.spark, t.sf_dir)).drop(
        "approx_users", "approx_pages"
    ),
    "t09_backfilled_silver": _replayed(SILVER),
    "t10_backfilled_hourly_stats": _replayed(HOURLY_STATS),
    "t10_backfilled_users_daily": _replayed(TOP_USERS),
    "t11_replayed_pages_hourly": _replayed(TOP_PAGES),
    "t11_replayed_languages_hourly": _replayed(LANGUAGES),
    # 2.6, 2.8, 2.12 maintenance
    "r4_compacted_log": lambda t: lakes.compacted(t.spark, t.sf_dir).read(SILVER_LOG).select(*SILVER.columns.fieldNames()),
    "r4_compacted_bronze": _merged(BRONZE),
    "r4_compacted_errors": _merged(ERRORS),
    "o5_sorted_files": lambda t: _sorted_files(t.live.lake),
    "o5_key_range": lambda t: t.live.lake.read_range(SILVER, "event_timestamp", *RANGE).select(*SILVER.columns.fieldNames()),
    "o6b_resorted_table": lambda t: t.spark.read.parquet(lakes.resorted_path(t.spark, t.sf_dir)).select(
        *TYPED_EVENTS.columns.fieldNames()
    ),
    "m01_retained_rows": lambda t: maintain.retained(t.silver, SILVER, AS_OF, 14),
    "m01_expired_silver": lambda t: lakes.expired(t.spark, t.sf_dir).read(SILVER).select(*SILVER.columns.fieldNames()),
    "m02_deleted_bronze": lambda t: lakes.expired(t.spark, t.sf_dir).read(BRONZE).select(*BRONZE.columns.fieldNames()),
    "m02_deleted_silver": _deleted(SILVER),
    "m02_deleted_silver_in_bronze": _deleted(BRONZE),
    "m02_deleted_silver_in_gold": _deleted(TOP_USERS),
    "m02_deleted_typed": _deleted(TYPED_EVENTS),
    "m03_truncated_errors": lambda t: lakes.expired(t.spark, t.sf_dir).read(ERRORS).select(*ERRORS.columns.fieldNames()),
    "m04_changed_retention": lambda t: lakes.expired(t.spark, t.sf_dir).read(TYPED_EVENTS).select(*TYPED_EVENTS.columns.fieldNames()),
    "m05_table_sizes": lambda t: _sizes(t).select(
        "table", "total_rows", (F.col("files") > 0).alias("has_files"), F.col("size").rlike(r"^[0-9]+\.[0-9]{2} (B|[KMG]iB)$").alias("readable")
    ),
    "m05_table_rows": lambda t: _sizes(t).select("table", "total_rows"),
    "m06_partition_counts": lambda t: maintain.partition_counts(t.live.lake, [SILVER, *GOLD]),
}


TABLE |= STORED


def queries() -> dict[str, Query]:
    def bind(make: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: comparable(make(Inputs(spark, sf_dir)))

    return {name: bind(make) for name, make in TABLE.items()}
