"""Work is dealt by the number of rows, however few files or row groups they come in."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import FULL, stamped
from ripplelake.functions import wire
from ripplelake.operators import route
from ripplelake.plans import lakes, maintain
from ripplelake.plans import medallion as m
from ripplelake.schema import ERRORS, SILVER_LOG
from ripplelake.sources import recent_changes
from ripplelake.sources.commits import File
from ripplelake.sources.lake import Lake, with_ingest
from ripplelake.streaming import native, pipeline


@pytest.fixture
def source(spark, tmp_path):
    """Events in one file of one row group; some come twice, some have no id."""
    rows = spark.range(400).select(
        F.when(F.col("id") % 40 != 7, F.col("id") % 390).alias("event_id"),
        (F.lit("2024-01-03").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, CAST(id % 390 AS INT))")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 5).alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.lit('{"k": 3}').alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("make", [recent_changes.recent_changes, recent_changes.typed_changes, recent_changes.framed_lines])
def test_messages_are_made_by_many_tasks(spark, source, monkeypatch, make):
    one = make(spark, source)
    assert one.rdd.getNumPartitions() == 1
    monkeypatch.setattr(recent_changes, "TASK_ROWS", 20)
    many = make(spark, source)
    assert many.rdd.getNumPartitions() >= 20
    assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))


def test_more_messages_land_in_more_files(spark, source, folder, monkeypatch):
    sent = recent_changes.recent_changes(spark, source)
    monkeypatch.setattr(lakes, "FILE_MESSAGES", 10)
    at = folder("inbox")
    stream = lakes.inbox(spark, sent, at, 2)
    landed = spark.read.schema(sent.schema).parquet(at)
    assert len(landed.inputFiles()) > 2 * max(2, spark.sparkContext.defaultParallelism // 2)
    assert sorted(map(str, landed.collect())) == sorted(map(str, sent.collect()))
    batches = []
    lakes._run(stream.writeStream.option("checkpointLocation", folder("cp")).foreachBatch(lambda df, n: batches.append(df.count())))
    assert len(batches) == 2 and sum(batches) == sent.count()


def test_a_batch_is_parsed_once_before_its_tables_are_written(spark, folder, monkeypatch):
    """Jobs that start side by side must find the parsed rows; those on other executors would parse them again."""
    parses = spark.sparkContext.accumulator(0)

    def seen(text):
        parses.add(1)
        return text

    events = stamped(spark, [{**FULL, "id": n} for n in range(20)])
    look = F.udf(seen, T.StringType()).asNondeterministic()
    checked = wire.with_error(events).withColumn("raw_message", look("raw_message"))
    before, jobs = [], pipeline.side_by_side

    def counted(session, *work):
        before.append(parses.value)
        jobs(session, *work)

    monkeypatch.setattr(pipeline, "side_by_side", counted)
    pipeline.Pipeline(Lake(spark, folder("lake"), grain="day"), refresh=False).ingest(checked, 0)
    assert before == [20] and parses.value == 20


def test_bins_of_a_compaction_are_bounded_by_rows_and_have_a_task_each(spark, folder):
    """Long texts compress to almost nothing: by bytes alone a bin held any number of rows, and several bins met in one task."""
    state = SimpleNamespace(deleted={})
    files = [File(f"w=1/day/{n}", 40, 10) for n in range(10)]
    assert [len(b) for b in maintain._bins(files, state, 10_000, 100)] == [2] * 5
    assert maintain._bins([File("w=1/day/0", 60, 10), File("w=1/day/1", 60, 10)], state, 10_000, 100) == []
    lake = Lake(spark, folder("lake"), grain="day")
    for n in range(16):
        lake.replace(ERRORS, with_ingest(route.broken(wire.with_error(stamped(spark, ["no", "{"]))), f"q-{n:02d}"))
    before = sorted(map(str, lake.read(ERRORS).drop("batch").collect()))
    tasks, exchange = [], Lake.exchange

    def seen(self, table, chosen, df, **how):
        tasks.append(df.rdd.mapPartitions(lambda rows: [len({r["batch"] for r in rows})]).collect())
        exchange(self, table, chosen, df, **how)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Lake, "exchange", seen)
        maintain.compact(lake, ERRORS, file_rows=8)
    assert tasks == [[1] * 4]
    assert sorted(map(str, lake.read(ERRORS).drop("batch").collect())) == before


def test_the_log_is_merged_by_tasks_of_so_many_rows(spark, folder):
    """A task sorts what it reads, so files are cut by their rows; the session's own settings come back, also after an error."""
    lake = Lake(spark, folder("lake"))
    own = spark.conf.get(maintain.SPLIT)
    with pytest.raises(ValueError), maintain._read_by_rows(lake, [File("a", 10_000_000, 100 << 20)]):
        assert int(spark.conf.get(maintain.SPLIT)) == (100 << 20) // 50
        raise ValueError
    assert spark.conf.get(maintain.SPLIT) == own


def test_a_log_row_is_made_once_for_both_its_batches(spark, source, monkeypatch):
    plans, replace = [], Lake.replace

    def seen(self, table, df, gather=True):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        replace(self, table, df, gather)

    monkeypatch.setattr(Lake, "replace", seen)
    lake = lakes.compacted(spark, source)
    assert "Union" not in plans[0]
    kept = lake.read(SILVER_LOG)
    assert 0 < kept.count() == kept.select("event_timestamp", "wiki", "event_id").distinct().count()


def test_the_state_of_the_watermark_variant_is_not_held_in_heaps(spark, source, monkeypatch):
    own, seen = spark.conf.get(lakes.STATE_STORE), []
    monkeypatch.setattr(lakes, "_run", lambda writer: seen.append(spark.conf.get(lakes.STATE_STORE)) or [])
    lakes.native_path(spark, source)
    assert len(seen) == 2 and all("RocksDB" in s for s in seen)
    assert spark.conf.get(lakes.STATE_STORE) == own


def test_events_are_gathered_before_their_sketches_are_made(spark, folder):
    """Events of an hour stood in all tasks, so a partial sketch of 26 KB was made of nearly every event."""
    at = folder("rows")
    rows = m.silver_rows(m.bronze_of(stamped(spark, [{**FULL, "id": n, "user": f"U{n % 7}"} for n in range(60)])))
    rows.write.parquet(at)
    stats = native.live_hourly_stats(spark.read.schema(rows.schema).parquet(at))
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    aggregates = plan.split("RepartitionByExpression")
    assert len(aggregates) == 2 and "approx_count_distinct" in aggregates[0] and "max_by" in aggregates[1]
    found = stats.first()
    assert (found["total_edits"], found["approx_users"], found["approx_pages"]) == (60, 7, 1)
