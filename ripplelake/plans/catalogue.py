"""The analytic, dashboard and monitoring queries.

Every function takes the tables it reads and returns a DataFrame.  Results that are cut to the top
rows break ties by name, so they are repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelake.functions.scalars import seconds_between
from ripplelake.operators import report
from ripplelake.operators.report import AsOf
from ripplelake.operators.route import preview


def _human() -> Column:
    return (F.col("user_is_bot") == 0) & (F.col("user_is_anonymous") == 0)


# Bronze and errors


def total(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def bronze_range(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.min("ingested_at").alias("first_event"), F.max("ingested_at").alias("last_event"), F.count("*").alias("total")
    )


def latest_errors(errors: DataFrame, n: int = 10, chars: int = 200) -> DataFrame:
    newest = preview(errors, chars).orderBy(
        F.desc("ingested_at"), F.desc("kafka_partition"), F.desc("kafka_offset")
    )
    return newest.limit(n).select(
        "kafka_partition", "kafka_offset", "error_message", "raw_preview", "ingested_at"
    )


def errors_by_type(errors: DataFrame) -> DataFrame:
    kinds = errors.groupBy(F.substring("error_message", 1, 100).alias("error_type"))
    return kinds.agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "error_type")


def error_trend(errors: DataFrame, as_of: AsOf = None) -> DataFrame:
    recent = report.trailing(errors, "ingested_at", "24 HOURS", as_of, inclusive=False)
    return report.buckets(recent, "hour", "ingested_at", "error_count").orderBy(F.desc("hour"))


# Silver


def silver_overview(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count("*").alias("total_events"),
        F.count_distinct("wiki").alias("unique_wikis"),
        F.count_distinct("user").alias("unique_users"),
        F.count_distinct("title").alias("unique_pages"),
        F.sum("user_is_bot").alias("bot_events"),
        F.sum("user_is_anonymous").alias("anonymous_events"),
    )


def language_distribution(silver: DataFrame, n: int = 15) -> DataFrame:
    return report.top_counts(silver, ["language"], n, "events")


def type_distribution(silver: DataFrame) -> DataFrame:
    counts = silver.groupBy("event_type").agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "event_type")


def top_human_users(silver: DataFrame, n: int = 10) -> DataFrame:
    return report.top_counts(silver.where(_human()), ["user"], n)


def top_wikis(silver: DataFrame, n: int = 10) -> DataFrame:
    return report.top_counts(silver, ["wiki", "language"], n)


def author_mix(silver: DataFrame) -> DataFrame:
    """Bots, humans and anonymous authors; a row may be both bot and anonymous."""
    return silver.agg(
        F.count_if(F.col("user_is_bot") == 1).alias("bots"),
        F.count_if(_human()).alias("humans"),
        F.count_if(F.col("user_is_anonymous") == 1).alias("anonymous"),
        F.count("*").alias("total"),
    )


def largest_growth(silver: DataFrame, n: int = 10) -> DataFrame:
    grown = silver.where(F.col("length_delta") > 0)
    return report.top(grown, n, "length_delta", "event_timestamp", "wiki", "event_id").select(
        "title", "user", "length_delta", "event_timestamp"
    )


def latest_hours(silver: DataFrame, n: int = 24) -> DataFrame:
    return report.buckets(silver, "hour", "event_timestamp", "events").orderBy(F.desc("hour")).limit(n)


def latest_changes(silver: DataFrame, n: int = 10) -> DataFrame:
    return report.top(silver, n, "event_timestamp", "wiki", "event_id").select(
        "title", "user", "wiki", "language", "length_delta", "event_timestamp"
    )


# Gold


def hourly_authors(stats: DataFrame, as_of: AsOf = None) -> DataFrame:
    recent = report.trailing(stats, "hour", "24 HOURS", as_of)
    sums = recent.groupBy("hour").agg(
        F.sum("total_edits").alias("edits"), F.sum("bot_edits").alias("bots"), F.sum("human_edits").alias("humans")
    )
    return sums.orderBy("hour")


def hourly_edits(stats: DataFrame, as_of: AsOf = None) -> DataFrame:
    recent = report.trailing(stats, "hour", "24 HOURS", as_of)
    return recent.groupBy("hour").agg(F.sum("total_edits").alias("edits")).orderBy("hour")


def top_human_users_daily(users: DataFrame, n: int = 10) -> DataFrame:
    return report.top_sums(users.where(_human()), ["user"], "edits", n, "total_edits")


def language_share(languages: DataFrame, as_of: AsOf = None, n: int = 10) -> DataFrame:
    recent = report.trailing(languages, "hour", "24 HOURS", as_of)
    return report.top_sums(recent, ["language"], "total_edits", n, "edits")


def top_pages(pages: DataFrame, as_of: AsOf = None, n: int = 10) -> DataFrame:
    recent = report.trailing(pages, "hour", "12 HOURS", as_of)
    return report.top_sums(recent, ["title", "wiki"], "edits", n, "total_edits")


def busiest_users_per_day(users: DataFrame, k: int = 3) -> DataFrame:
    ranked = report.top_per_group(users, ["day", "wiki"], "edits", ["user"], k)
    return ranked.select("day", "wiki", "place", "user", "edits")


def hottest_pages_per_hour(pages: DataFrame, k: int = 3) -> DataFrame:
    ranked = report.top_per_group(pages, ["hour"], "edits", ["wiki", "title"], k)
    return ranked.select("hour", "place", "wiki", "title", "edits")


def busy_hours_alert(stats: DataFrame, limit: int = 10000) -> DataFrame:
    """Hours whose edits over all sites exceed ``limit``."""
    per_hour = stats.groupBy("hour").agg(F.sum("total_edits").alias("total_edits"))
    return report.over_limit(per_hour, "total_edits", limit)


def total_edits_alert(silver: DataFrame, limit: int = 10000) -> DataFrame:
    """The total, where it exceeds ``limit``; no row otherwise."""
    return report.over_limit(total(silver, "total_edits"), "total_edits", limit)


# The older, typed design


def top_users(events: DataFrame, n: int = 10) -> DataFrame:
    return report.top_counts(events, ["user"], n)


def bot_share(events: DataFrame) -> DataFrame:
    return report.share_of_total(events, ["bot"])


def most_edited(events: DataFrame, n: int = 10) -> DataFrame:
    return report.top_counts(events, ["title"], n)


def latest_minutes(events: DataFrame, n: int = 20) -> DataFrame:
    return report.buckets(events, "minute", "timestamp", "edits").orderBy(F.desc("minute")).limit(n)


def registered_users(events: DataFrame, n: int = 10) -> DataFrame:
    return report.top_counts(events.where(~F.col("user").like("~%")), ["user"], n)


def top_bots(events: DataFrame, n: int = 5) -> DataFrame:
    return report.top_counts(events.where(F.col("bot") == 1), ["user"], n)


def ingestion_rate(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    recent = report.trailing(events, "ingested_at", "1 MINUTE", as_of, inclusive=False)
    return report.buckets(recent, "second", "ingested_at", "events").orderBy(F.desc("second"))


def processing_lag(events: DataFrame, as_of: AsOf = None, span: str = "5 MINUTES") -> DataFrame:
    recent = report.trailing(events, "ingested_at", span, as_of, inclusive=False)
    lag = seconds_between("timestamp", "ingested_at")
    return recent.agg(F.round(F.avg(lag), 2).alias("avg_lag_seconds"), F.max(lag).alias("max_lag_seconds"))
