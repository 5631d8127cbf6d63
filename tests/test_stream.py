"""However the messages arrive, the stored tables equal the batch result."""

import datetime as dt
import json
import random

import pytest
from conftest import FULL, SMALL, stamped
from pyspark.sql import functions as F

from ripplelake.operators.route import BrokenMessages
from ripplelake import session
from ripplelake.functions import wire
from ripplelake.plans import maintain
from ripplelake.plans import medallion as m
from ripplelake.schema import (
    BRONZE, DEAD_LETTERS, ERRORS, GOLD, HOURLY_STATS, INGEST_FAILURES, INGEST_TOTALS, LANGUAGES, SILVER, SILVER_LOG, SUPERSEDED, TOP_PAGES, TOP_USERS,
    TOUCHED,
)
from ripplelake.sources import recent_changes

from ripplelake.sources.lake import Lake, with_ingest
from ripplelake.streaming import monitor
from ripplelake.streaming.native import dropped_late, heartbeat, live_hourly_stats
from ripplelake.streaming.pipeline import Pipeline, batch_name, ingest_totals, rebuild

START = 1728302400  # 2024-10-07 12:00:00


def events(n=60, seed=5):
    """Edits of three hours with second deliveries, broken messages and one that is three days late."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        made.append({
            "id": i, "type": rng.choice(["edit", "new", "log"]), "title": f"Page {rng.randrange(5)}",
            "user": rng.choice(["Ann", "Bob", "~2024-1", "CarlBot"]), "bot": rng.random() < 0.3, "minor": rng.random() < 0.5,
            "timestamp": START + rng.randrange(3 * 3600), "wiki": rng.choice(["enwiki", "dewiki", "commonswiki", "commons"]),
            "length": {"old": 100, "new": 100 + rng.randrange(-50, 50)}, "meta": {"id": f"u{i}"},
        })
    late = {**made[0], "id": n, "type": "edit", "timestamp": START - 3 * 86400}
    again = [{**e, "comment": "again"} for e in made[::7]]
    return made + [late] + again + ["{broken", "[1]", ""]


def gold(silver):
    rows = m.activity(silver)
    return {
        HOURLY_STATS: m.hourly_stats(rows), TOP_USERS: m.users_daily(rows),
        TOP_PAGES: m.pages_hourly(rows), LANGUAGES: m.languages_hourly(rows),
    }


def same(stored, expected):
    a, b = stored.select(*expected.columns), expected
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def assert_equals_batch(lake, messages):
    silver = m.silver_of(m.bronze_of(messages))
    same(lake.read(SILVER), silver)
    for table, expected in gold(silver).items():
        same(lake.read(table), expected)


@pytest.fixture(scope="module")
def messages(spark):
    return stamped(spark, events()).cache()


def test_ways_of_delivery(spark, messages, folder):
    """One batch; many batches in random order; one of them repeated."""
    whole = Lake(spark, folder("whole"), grain="day")
    Pipeline(whole).ingest(wire.with_error(messages), 0)
    assert_equals_batch(whole, messages)

    split = Lake(spark, folder("split"), grain="day")
    pipeline = Pipeline(split)
    offsets = list(range(messages.count()))
    random.Random(1).shuffle(offsets)
    for n in range(4):
        part = messages.where(F.col("kafka_offset").isin(offsets[n::4]))
        pipeline.ingest(wire.with_error(part), n)
        if n == 2:
            pipeline.ingest(wire.with_error(part), n)
    assert_equals_batch(split, messages)
    assert split.read(BRONZE).count() == messages.count() - 3
    assert split.read(ERRORS).count() == 3


def test_hour_grain(spark, folder):
    few = stamped(spark, events(20))
    lake = Lake(spark, folder("hours"))
    pipeline = Pipeline(lake)
    pipeline.ingest(wire.with_error(few.where("kafka_offset % 2 = 0")), 0)
    files = lambda: {r[0] for r in lake.read(SILVER).select("_metadata.file_path").distinct().collect()}
    before = files()
    pipeline.ingest(wire.with_error(few.where("kafka_offset % 2 = 1")), 1)
    assert_equals_batch(lake, few)
    assert all("/event_hour=" in path for path in before)
    # The hour of the late event came with the first batch only: its files were not written again.
    kept = before & files()
    assert kept and all("event_date=2024-10-04" in path for path in kept)


def test_distinct_counts_over_batches(spark, folder):
    """One user, one page, two batches of the same hour."""
    lake = Lake(spark, folder("twice"), grain="day")
    pipeline = Pipeline(lake)
    for n in range(2):
        row = stamped(spark, [{**FULL, "id": n + 1, "timestamp": FULL["timestamp"] + n}])
        pipeline.ingest(wire.with_error(row.withColumn("kafka_offset", F.lit(n).cast("bigint"))), n)
    stats, users, pages = (lake.read(t).first() for t in (HOURLY_STATS, TOP_USERS, TOP_PAGES))
    assert (stats["total_edits"], stats["unique_users"], stats["unique_pages"]) == (2, 1, 1)
    assert (users["edits"], users["pages_touched"]) == (2, 1)
    assert (pages["edits"], pages["unique_users"]) == (2, 1)


def run(pipeline, source, checkpoint):
    query = pipeline.start(source, checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def land(df, path, parts):
    df.repartition(parts).write.mode("append").parquet(path)


def test_stream_restarts_after_a_crash(spark, messages, folder, monkeypatch):
    """The second try of a batch replaces what the first one wrote, with the same ingestion time."""
    inbox, checkpoint = folder("inbox"), folder("checkpoint")
    unstamped = messages.drop("ingested_at")
    land(unstamped, inbox, 2)
    source = spark.readStream.schema(unstamped.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    lake = Lake(spark, folder("lake"), grain="day")

    crashing = Pipeline(lake)
    monkeypatch.setattr(crashing, "refresh_touched", lambda: 1 / 0)
    with pytest.raises(Exception):
        run(crashing, source, checkpoint)
    first_try = {r["ingested_at"] for r in lake.read(BRONZE).select("ingested_at").distinct().collect()}
    assert len(first_try) == 1 and lake.read(HOURLY_STATS).count() == 0

    query = run(Pipeline(lake), source, checkpoint)
    stored = lake.read(BRONZE)
    assert stored.count() == messages.count() - 3
    assert stored.select("kafka_offset").distinct().count() == messages.count() - 3
    assert first_try <= {r["ingested_at"] for r in stored.select("ingested_at").distinct().collect()}
    assert lake.partitions(TOUCHED) == []
    # Everything here is older than the accepted period, as of the clock.
    assert lake.read(ERRORS).where("error_message = 'beyond retention'").count() > 0
    assert lake.read(SILVER_LOG).count() == 0
    status = monitor.ingestion_status(monitor.progress(spark, monitor.reports_of(query))).first()
    assert status["messages_read"] > 0 and status["last_exception"] is None


def test_lost_checkpoint_does_not_overwrite(spark, folder):
    """Reading everything again under a new query adds to bronze, and silver collapses it."""
    recent = stamped(spark, events(12))
    inbox = folder("inbox")
    land(recent, inbox, 1)
    lake = Lake(spark, folder("lake"), grain="day")
    for checkpoint in (folder("a"), folder("b")):
        run(Pipeline(lake), spark.readStream.schema(recent.schema).parquet(inbox), checkpoint)
    assert lake.read(BRONZE).count() == 2 * (recent.count() - 3)
    assert_equals_batch(lake, recent)


def test_error_policies(spark, messages, folder):
    checked = wire.with_error(messages)
    with pytest.raises(BrokenMessages):
        Pipeline(Lake(spark, folder("f")), policy="fail").ingest(checked, 0)
    with pytest.raises(BrokenMessages):
        Pipeline(Lake(spark, folder("b")), budget=2).ingest(checked, 0)
    with pytest.raises(ValueError):
        Pipeline(Lake(spark, folder("u")), policy="ignore")
    aside = Lake(spark, folder("d"), grain="day")
    Pipeline(aside, policy="dead_letters", refresh=False).ingest(checked, 0)
    assert (aside.read(DEAD_LETTERS).count(), aside.read(ERRORS).count()) == (3, 0)
    tolerant = Lake(spark, folder("t"), grain="day")
    Pipeline(tolerant, budget=3, refresh=False).ingest(checked, 0)
    assert tolerant.read(ERRORS).count() == 3
    assert tolerant.read(SILVER).count() == 0 and len(tolerant.partitions(TOUCHED)) == 1
    assert Pipeline(tolerant).refresh_touched() > 0
    assert_equals_batch(tolerant, messages)
    assert Pipeline(tolerant).refresh_touched() == 0


def test_sparse_batches(spark, folder):
    lake = Lake(spark, folder("empty"), grain="day")
    nothing = stamped(spark, [FULL]).where("false")
    Pipeline(lake).ingest(wire.with_error(nothing), 0)
    Pipeline(lake).ingest(wire.with_error(stamped(spark, ["broken"])), 1)
    assert [lake.read(t).count() for t in (BRONZE, ERRORS, SILVER, *GOLD)] == [0, 1, 0, 0, 0, 0, 0]


def test_native_variant_over_batches(spark, folder):
    """Files in order of time: nothing is late, and all closed hours equal the exact counts."""
    rows = m.silver_rows(m.bronze_of(recent_changes.recent_changes(spark, SMALL))).cache()
    path = folder("rows")
    for low, high in ((1, 10), (10, 20), (20, 32)):
        day = F.dayofmonth("event_timestamp")
        rows.where((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = folder("out")
    writer = live_hourly_stats(source).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", folder("cp")).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(out)
    exact = m.hourly_stats(m.activity(m.silver_of(m.bronze_of(recent_changes.recent_changes(spark, SMALL)))))
    columns = ["hour", "wiki", "language", "total_edits", "bot_edits", "human_edits", "anonymous_edits", "total_length_delta"]
    assert found.select(*columns).exceptAll(exact.select(*columns)).count() == 0
    assert found.count() >= exact.count() * 0.98
    joined = found.join(exact.select("hour", "wiki", "unique_users"), ["hour", "wiki"])
    assert joined.where(F.abs(F.col("approx_users") - F.col("unique_users")) > 1).count() == 0


# Maintenance on a filled lake


@pytest.fixture(scope="module")
def filled(spark, messages, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("filled")), grain="day")
    pipeline = Pipeline(lake, refresh=False)
    for n in range(2):
        pipeline.ingest(wire.with_error(messages.where(f"kafka_offset % 2 = {n}")), n)
    pipeline.refresh_touched()
    return lake


def test_replay_changes_nothing(filled, messages):
    for _ in range(2):
        maintain.replay(filled)
    maintain.replay(filled, dt.date(2024, 10, 8), dt.date(2024, 10, 8))
    assert_equals_batch(filled, messages)


def test_compaction_stopped_half_way(filled, messages, monkeypatch):
    """Stopped before its commit it has changed nothing, whatever it has written."""
    latest = m.silver_of(m.bronze_of(messages))
    days = [dt.date.fromisoformat(f.split("=")[1]) for f in filled.partitions(SILVER_LOG)]
    before, bronze = filled.log(SILVER_LOG).state(), filled.read(BRONZE).count()
    with monkeypatch.context() as patched:
        patched.setattr(filled.log(SILVER_LOG), "commit", lambda make: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            maintain.compact(filled, SILVER_LOG, days[-1:])
    assert filled.log(SILVER_LOG).state().where == before.where
    maintain.compact(filled, SILVER_LOG, days)
    assert filled.read(SILVER_LOG).count() == latest.count()
    assert all(len(filled.partitions(SILVER_LOG, f"event_date={d}")) == 1 for d in days)
    hours = latest.select(F.to_date("event_timestamp").alias("event_date"), F.hour("event_timestamp").alias("event_hour"))
    rebuild(filled, hours.distinct().collect())
    assert_equals_batch(filled, messages)
    # The deliveries that went are still known by their place.
    gone = m.silver_rows(m.bronze_of(messages)).select("kafka_offset").subtract(filled.read(SILVER_LOG).select("kafka_offset"))
    assert gone.count() > 0 and gone.subtract(filled.read(SUPERSEDED).select("kafka_offset")).count() == 0
    assert filled.read(BRONZE).count() == bronze


def test_snapshot(filled, folder):
    path = maintain.snapshot(filled, folder("snap"), dt.datetime(2024, 10, 9, 1, 2, 3))
    assert path.endswith("silver_20241009_010203")
    assert filled.spark.read.parquet(path).count() == filled.read(SILVER).count()
    with pytest.raises(Exception):
        maintain.snapshot(filled, path.rsplit("/", 1)[0], dt.datetime(2024, 10, 9, 1, 2, 3))


def test_delete_where(spark, messages, folder):
    lake = Lake(spark, folder("delete"), grain="day")
    Pipeline(lake).ingest(wire.with_error(messages), 0)
    silver = m.silver_of(m.bronze_of(messages))
    maintain.delete_where(lake, SILVER, F.col("user") == "Ann")
    same(lake.read(SILVER), silver.where("user != 'Ann'"))
    maintain.delete_where(lake, SILVER, F.col("event_timestamp") < F.lit("2024-10-07").cast("timestamp"))
    same(lake.read(SILVER), silver.where("user != 'Ann' AND event_timestamp >= '2024-10-07'"))
    assert lake.partitions(SILVER) == ["event_date=2024-10-07"]
    maintain.delete_where(lake, SILVER, F.lit(True))
    assert lake.partitions(SILVER) == [] and lake.read(SILVER).count() == 0


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_retention(spark, messages, folder, grain):
    lake = Lake(spark, folder("expire"), grain=grain)
    Pipeline(lake).ingest(wire.with_error(messages), 0)
    silver = m.silver_of(m.bronze_of(messages))
    at = dt.datetime(2024, 10, 8, 13, 30, tzinfo=dt.timezone.utc)
    dropped = maintain.expire(lake, at, {SILVER.name: 1}, exact=False)
    assert dropped[SILVER.name] == 1
    same(lake.read(SILVER), silver.where("event_timestamp >= '2024-10-07'"))
    maintain.expire(lake, at, {SILVER.name: 1})
    same(lake.read(SILVER), silver.where("event_timestamp >= '2024-10-07 13:30:00'"))
    same(maintain.retained(silver, SILVER, at, 1), silver.where("event_timestamp >= '2024-10-07 13:30:00'"))
    assert lake.read(BRONZE).count() == messages.count() - 3
    far = at + dt.timedelta(days=400)
    maintain.expire(lake, far)
    assert all(lake.read(t).count() == 0 for t in (BRONZE, ERRORS, SILVER, SILVER_LOG, *GOLD))


def test_storage_reports(spark, filled):
    sizes = {r["table"]: r for r in maintain.table_sizes(filled, [BRONZE, SILVER, ERRORS]).collect()}
    assert sizes[ERRORS.name]["total_rows"] == 3
    assert all(r["bytes"] > 0 and r["files"] > 0 and r["size"].endswith(("B", "KiB")) for r in sizes.values())
    assert {r["table"]: r["partitions"] for r in maintain.partition_counts(filled, [SILVER]).collect()} == {SILVER.name: 2}


def test_failed_query_is_reported(spark, folder):
    log = monitor.ProgressLog()
    spark.streams.addListener(log)
    try:
        inbox = folder("inbox")
        land(stamped(spark, ["broken"]), inbox, 1)
        source = spark.readStream.schema(stamped(spark, []).schema).parquet(inbox)
        lake = Lake(spark, folder("lake"))
        query = Pipeline(lake, policy="fail").start(source, folder("cp")).trigger(availableNow=True).start()
        with pytest.raises(Exception):
            query.awaitTermination()
        assert "BrokenMessages" in str(query.exception())
    finally:
        spark.streams.removeListener(log)


def test_dataflow_health_lists_running_queries(spark, folder):
    inbox = folder("inbox")
    land(stamped(spark, [FULL]), inbox, 1)
    source = spark.readStream.schema(stamped(spark, []).schema).parquet(inbox)
    query = source.writeStream.queryName("watched").format("noop").option("checkpointLocation", folder("cp")).start()
    try:
        rows = {r["name"]: r for r in monitor.dataflow_health(spark).collect()}
        assert rows["watched"]["active"] and rows["watched"]["failure"] == ""
    finally:
        query.stop()


# Late rows, expiry and deletion against refresh and replay


def edits(*rows):
    """Ann's edits: (id, seconds after START)."""
    made = {"type": "edit", "user": "Ann", "wiki": "enwiki", "title": "Page", "meta": {}}
    return [{**made, "id": i, "timestamp": START + s} for i, s in rows]


def ingested(spark, rows, at, first_offset=0):
    when = F.lit(at.replace(tzinfo=dt.timezone.utc)).cast("timestamp")
    df = stamped(spark, rows).withColumn("ingested_at", when)
    return wire.with_error(df.withColumn("kafka_offset", F.col("kafka_offset") + first_offset))


NOON = dt.datetime(2024, 10, 7, 12, 30, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_replay_past_retention(spark, folder, grain):
    """A late message of an expired hour neither enters by ingestion nor by replay; gold keeps its count."""
    lake = Lake(spark, folder("past"), grain=grain)
    pipeline = Pipeline(lake)
    pipeline.ingest(ingested(spark, edits(*[(i, i) for i in range(5)]), NOON), 0)
    later = NOON + dt.timedelta(days=100)
    maintain.expire(lake, later)
    pipeline.ingest(ingested(spark, edits((9, 9)), later, 100), 1)
    assert lake.read(ERRORS).where("error_message = 'beyond retention'").count() == 1
    maintain.replay(lake)
    assert lake.read(SILVER).count() == 0 and lake.read(SILVER_LOG).count() == 0
    assert lake.read(HOURLY_STATS).first()["total_edits"] == 5
    assert lake.read(TOP_USERS).first()["edits"] == 5


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_late_row_on_the_boundary_day(spark, folder, grain):
    """Silver has lost a part of the day, the log has not: the daily row counts them all, and silver stays short."""
    lake = Lake(spark, folder("boundary"), grain=grain)
    pipeline = Pipeline(lake)
    pipeline.ingest(ingested(spark, edits((1, 0), (2, 1), (3, 7200)), NOON), 0)
    later = dt.datetime(2025, 1, 5, 13, 0, tzinfo=dt.timezone.utc)  # 90 days before: 7 October, 13:00
    maintain.expire(lake, later)
    assert lake.read(SILVER).count() == 1
    pipeline.ingest(ingested(spark, edits((4, 7300)), later, 100), 1)
    assert lake.read(TOP_USERS).first()["edits"] == 4
    assert sorted(r["event_id"] for r in lake.read(SILVER).collect()) == [3, 4]
    assert sorted(r["total_edits"] for r in lake.read(HOURLY_STATS).collect()) == [2, 2]


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_shorter_silver_retention_holds(spark, folder, grain):
    lake = Lake(spark, folder("short"), grain=grain)
    pipeline = Pipeline(lake)
    pipeline.ingest(ingested(spark, edits((1, 0), (2, 1)), NOON), 0)
    later = NOON + dt.timedelta(days=30)
    maintain.expire(lake, later, {SILVER.name: 14})
    pipeline.ingest(ingested(spark, edits((3, 2)), later, 100), 1)
    assert lake.read(SILVER).count() == 0
    assert lake.read(HOURLY_STATS).first()["total_edits"] == 3


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_deletes_last(spark, messages, folder, grain, monkeypatch):
    """What was deleted from silver stays away from every table through later batches, a compaction and a replay."""
    lake = Lake(spark, folder("gone"), grain=grain)
    pipeline = Pipeline(lake)
    pipeline.ingest(wire.with_error(messages), 0)
    silver = m.silver_of(m.bronze_of(messages)).where("user != 'Ann'").cache()
    if grain == "day":
        maintain.compact(lake, SILVER_LOG)  # now the log has one delivery of each event, bronze all
    parsed = []
    with monkeypatch.context() as patched:
        patched.setattr(wire, "parse_wire", lambda df, parse=wire.parse_wire: (parsed.append(df.count()), parse(df))[1])
        count = maintain.delete_where(lake, SILVER, F.col("user") == "Ann")
    all_rows = m.silver_rows(m.bronze_of(messages)).where("user = 'Ann'")
    assert count == m.silver_of(m.bronze_of(messages)).where("user = 'Ann'").count()
    assert parsed == [all_rows.count()]  # of bronze, the deliveries of these events only
    assert lake.read(BRONZE).count() == m.bronze_of(messages).count() - all_rows.count()
    compacted = lambda: [maintain.compact(lake, t) for t in (BRONZE, SILVER_LOG, SILVER)]
    for again in (lambda: None, compacted, lambda: maintain.replay(lake)):
        again()
        same(lake.read(SILVER), silver)
        for table, expected in gold(silver).items():
            same(lake.read(table), expected)
    with pytest.raises(ValueError):
        maintain.delete_where(lake, TOP_USERS, F.lit(True))


def test_totals_of_many_batches(spark, folder):
    """More batches than Spark reports, a restart and a second try of one: the stored rows give exact totals, whatever Spark still reports."""
    lake = Lake(spark, folder("totals"), grain="day")
    inbox, checkpoint = folder("inbox"), folder("cp")
    rows = [json.dumps(e) for e in edits(*[(i, i) for i in range(200)])] + ["{broken"] * 10
    texts = spark.createDataFrame([(n % 105, t, n) for n, t in enumerate(rows)], "file int, raw_message string, n int")
    empty = stamped(spark, [FULL])
    envelope = texts.select(
        "raw_message", F.lit("t").alias("kafka_topic"), F.lit(0).cast("bigint").alias("kafka_partition"), F.col("n").cast("bigint").alias("kafka_offset"),
        F.lit(NOON).cast("timestamp").alias("kafka_timestamp"), F.lit("").alias("kafka_key"), F.lit(NOON).cast("timestamp").alias("ingested_at"), "file",
    )
    envelope.repartition(105, "file").sortWithinPartitions("file").drop("file").write.option("maxRecordsPerFile", 2).parquet(inbox)
    source = spark.readStream.schema(empty.schema).option("maxFilesPerTrigger", 1).parquet(inbox)

    class Counting(Pipeline):  # only the counters of each batch
        def _ingest(self, checked, batch_id):
            if batch_id == 40 and not stopped:
                stopped.append(batch_id)
                raise RuntimeError("lost")
            self.take_in(checked, batch_id)

        def take_in(self, checked, batch_id):
            name = batch_name(checked, batch_id)
            self.lake.replace(INGEST_TOTALS, with_ingest(self.totals(checked, checked.where("false"), name), name), gather=False)

    stopped = []
    pipeline = Counting(lake, refresh=False)
    with pytest.raises(Exception):
        run(pipeline, source, checkpoint)
    query = run(pipeline, source, checkpoint)
    row = ingest_totals(lake).first()
    assert (row["sent"], row["skipped"], row["late"]) == (200, 10, 0)
    assert row["batches"] == len(lake.partitions(INGEST_TOTALS, "ingest_date=2024-10-07")) >= 105
    assert row["failed"] > 0 and stopped == [40]
    assert sum(p["numInputRows"] for p in query.recentProgress) < 210  # what Spark remembers is not all


def test_failed_messages_are_counted(spark, messages, folder):
    lake = Lake(spark, folder("failed"), grain="day")
    checked = wire.with_error(messages)
    for _ in range(2):
        with pytest.raises(BrokenMessages):
            Pipeline(lake, policy="fail").ingest(checked, 7)
    Pipeline(lake, refresh=False).ingest(checked, 7)
    row = ingest_totals(lake).first()
    n = messages.count()
    assert (row["query"], row["sent"], row["skipped"], row["failed"], row["batches"]) == ("batch", n - 3, 3, 2 * n, 1)
    assert lake.read(INGEST_FAILURES).first()["error"].startswith("BrokenMessages")


# Peeking, rate limits, positions, late rows


def test_peek_opens_few_files(spark, folder, monkeypatch):
    lake = Lake(spark, folder("peek"), grain="day")
    offsets = list(range(400))
    random.Random(2).shuffle(offsets)
    every = spark.range(2000).select(
        F.lit("x").alias("raw_message"), F.lit("t").alias("kafka_topic"), F.expr("IF(id < 3, 0L, 1 + id % 4)").alias("kafka_partition"),
        F.col("id").alias("kafka_offset"), F.lit(NOON).cast("timestamp").alias("kafka_timestamp"), F.lit("").alias("kafka_key"),
        F.lit(NOON).cast("timestamp").alias("ingested_at"),
    )
    batch = F.format_string("q-%010d", F.expr("kafka_offset div 100"))
    lake.replace(BRONZE, with_ingest(every, "").withColumn("batch", batch))
    assert len(lake.log(BRONZE).state().files()) >= 20
    opened, scan = [], lake.scan
    monkeypatch.setattr(lake, "scan", lambda t, s, files, place=False: (opened.append(len(files)), scan(t, s, files, place))[1])
    found = lake.peek(BRONZE, 5)
    assert [(r.kafka_partition, r.kafka_offset) for r in found.orderBy("kafka_partition", "kafka_offset").collect()] == [
        (0, 0), (0, 1), (0, 2), (1, 4), (1, 8)
    ]
    assert sum(opened) <= 6  # of twenty
    assert "Exchange rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert Lake(spark, folder("none")).peek(BRONZE).count() == 0
    assert lake.peek(BRONZE, 3000).count() == 2000


def test_rate_limit_and_positions(spark, folder):
    """Batches stay below the limit; the group that has read everything goes on from there, another one reads all again."""
    inbox, group = folder("inbox"), folder("group")
    made = stamped(spark, [FULL] * 12)
    made.coalesce(1).write.option("maxRecordsPerFile", 1).parquet(inbox)

    def read(checkpoint, limit):
        source = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", limit).parquet(inbox)
        sizes = []
        query = source.writeStream.foreachBatch(lambda df, n: sizes.append(df.count())).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
        return sizes

    assert read(group, 5) == [5, 5, 2]
    assert read(group, 5) == []
    made.limit(1).coalesce(1).write.mode("append").parquet(inbox)
    assert read(group, 5) == [1]
    assert sum(read(folder("other"), 4)) == 13


def test_heartbeats_close_hours_and_late_rows_are_counted(spark, folder):
    rows = m.silver_rows(m.bronze_of(stamped(spark, edits(*[(i, 60 * i) for i in range(300)]))))
    path, out, checkpoint = folder("rows"), folder("out"), folder("cp")
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, session.CLUSTER[provider])
    reports = []
    try:
        last = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
        late = rows.where("event_id < 5").withColumn("event_id", F.col("event_id") + 1000)
        for n, part in enumerate((rows, heartbeat(spark, rows.schema, last), late)):
            part.coalesce(1).write.mode("append").parquet(path)
            stream = live_hourly_stats(spark.readStream.schema(rows.schema).parquet(path))
            writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            query = writer.trigger(availableNow=True).start()
            query.awaitTermination()
            reports += monitor.reports_of(query)
            closed = spark.read.schema("hour timestamp, total_edits bigint").parquet(out).agg(F.sum("total_edits")).first()[0] or 0
            assert closed < 300 if n == 0 else closed == 300
    finally:
        spark.conf.unset(provider)
    assert dropped_late(reports) == 5
