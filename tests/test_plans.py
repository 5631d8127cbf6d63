"""What the plans must look like to hold at any size, and operators on made-up corner cases."""

import datetime as dt

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ripplelake.operators import merge, report
from ripplelake.plans import catalogue, lakes, registry
from ripplelake.schema import HOURLY_STATS, SILVER
from ripplelake.sources.lake import Lake, with_hour


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_is_parsed_once(spark):
    plan = plan_of(registry.Inputs(spark, SMALL).silver)
    wire_parses = plan.count("from_json(StructField(id,LongType,true), StructField(type,StringType,true)")
    assert wire_parses == 1


def test_top_k_per_group_is_cut_before_the_shuffle(spark):
    rows = spark.range(100000).select(F.expr("if(id % 3 = 0, 0, id % 50)").alias("g"), F.col("id").alias("n"))
    best = report.top_per_group(rows, ["g"], "n", ["g"], 2)
    plan = plan_of(best)
    assert "WindowGroupLimit" in plan[plan.index("Exchange"):]
    assert [r["n"] for r in best.where("g = 0").orderBy("place").collect()] == [99999, 99996]


def test_top_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(catalogue.top_human_users(registry.Inputs(spark, SMALL).silver))


@pytest.mark.parametrize("name, column", [
    ("p08_trailing_range", "event_date"), ("p09_hour_filter", "event_date"), ("q16_error_trend", "ingest_date"),
    ("q17_hourly_authors", "event_date"), ("q18_hourly_edits", "event_date"), ("q20_language_share", "event_date"),
    ("q21_top_pages", "event_date"),
])
def test_dashboards_prune_days(spark, name, column):
    plan = plan_of(registry.queries()[name](spark, SMALL))
    pruned = plan[plan.index("PartitionFilters: [") :].split("], ")[0]
    assert f"{column}#" in pruned and (">=" in pruned)


@pytest.fixture(scope="module")
def stored(spark):
    return lakes.replayed(spark, SMALL)


def test_only_needed_columns_are_read(spark, stored):
    plan = plan_of(catalogue.top_wikis(stored.read(SILVER)))
    assert "ReadSchema: struct<wiki:string,language:string>" in plan


def test_filters_reach_the_files(spark, stored):
    plan = plan_of(catalogue.top_human_users(stored.read(SILVER)))
    pushed = plan.split("PushedFilters: [")[1]
    assert "IsNotNull(user_is_bot)" in pushed and "EqualTo(user_is_bot,0)" in pushed and "EqualTo(user_is_an" in pushed


def test_time_range_prunes_days(spark, stored):
    stats = stored.read(HOURLY_STATS)
    recent = catalogue.hourly_edits(stats, "2024-01-31 00:00:00")
    filters = plan_of(recent).split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in filters
    assert len(recent.inputFiles()) > 0
    for df in (report.trailing(stats, "hour", "24 HOURS", "2024-01-31 00:00:00"),
               report.between_hours(stats, "2024-01-30 00:00:00", "2024-01-31 00:00:00")):
        assert df.select("event_date").distinct().count() <= 2


def test_trailing_ends(spark):
    at = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    rows = spark.createDataFrame([(at - dt.timedelta(hours=24),), (at,)], "hour timestamp")
    assert report.trailing(rows, "hour", "24 HOURS", at).count() == 2
    assert report.trailing(rows, "hour", "24 HOURS", at, inclusive=False).count() == 1
    assert report.trailing(rows, "hour", "24 HOURS").count() == 0


def test_sum_merge_refuses_distinct_counts(spark):
    parts = spark.createDataFrame([("a", 1, 2), ("a", 3, 4), ("b", 5, 6)], "k string, total_edits bigint, unique_users bigint")
    merged = merge.sum_merge(parts, ["k"], ["total_edits"]).orderBy("k").collect()
    assert [tuple(r) for r in merged] == [("a", 4), ("b", 5)]
    with pytest.raises(ValueError, match="unique_users"):
        merge.sum_merge(parts, ["k"], ["total_edits", "unique_users"])


def test_sketches_merge(spark):
    rows = spark.range(20000).select((F.col("id") % 2).alias("part"), F.expr("id % 3").alias("k"), (F.col("id") % 5000).alias("u"))
    parts = merge.distinct_sketch(rows, ["k", "part"], {"sketch": "u"})
    merged = merge.merge_sketches(parts, ["k"], {"approx_distinct": "sketch"}).collect()
    exact = {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.count_distinct("u").alias("n")).collect()}
    assert all(abs(r["approx_distinct"] - exact[r["k"]]) <= 0.05 * exact[r["k"]] for r in merged)


def test_share_of_total(spark):
    rows = spark.createDataFrame([(0,)] * 2 + [(1,)], "bot int")
    assert sorted(tuple(r) for r in report.share_of_total(rows, ["bot"]).collect()) == [(0, 2, 66.67), (1, 1, 33.33)]
    assert "SinglePartition" not in plan_of(report.share_of_total(rows, ["bot"])).split("Subquery")[0]


def test_alerts(spark):
    silver = registry.Inputs(spark, SMALL).silver
    assert catalogue.total_edits_alert(silver, 10**9).count() == 0
    assert catalogue.total_edits_alert(silver, 1).count() == 1


def test_hot_hour_is_written_by_several_tasks(spark, tmp_path):
    """A third of all rows in one hour: its partition is split, nothing is lost."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(60000).select(
            F.col("id").alias("event_id"),
            F.timestamp_seconds(F.expr("1704067200 + if(id % 3 = 0, id % 3600, id % 86400)")).alias("event_timestamp"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER.columns
              if f.name not in ("event_id", "event_timestamp", "event_uuid")],
            F.md5(F.col("id").cast("string")).alias("event_uuid"),
        )
        lake = Lake(spark, str(tmp_path))
        lake.replace(SILVER, with_hour(rows, "event_timestamp"))
        found = lake.read(SILVER)
        assert found.count() == 60000
        files = found.where("event_hour = 0").select("_metadata.file_path").distinct().count()
        assert files > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
