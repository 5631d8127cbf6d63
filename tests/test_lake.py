"""Commit logs: versions, conflicts, deletion marks, compaction, bounds, cleaning up, and refreshes by increments."""

import datetime as dt
import threading

import pytest
from conftest import FULL, stamped
from pyspark.sql import functions as F
from test_stream import assert_equals_batch, edits, events, ingested, same

from ripplelake.functions import wire
from ripplelake.operators import route
from ripplelake.plans import maintain
from ripplelake.plans import medallion as m
from ripplelake.schema import BRONZE, ERRORS, GOLD, SILVER, SILVER_LOG, TOP_USERS, TOUCHED, TYPED_EVENTS, USER_TITLES
from ripplelake.sources import commits
from ripplelake.sources.commits import Change, CommitLog, Conflict, File
from ripplelake.sources.lake import Lake, with_day, with_ingest
from ripplelake.streaming.pipeline import Pipeline

NOON = dt.datetime(2024, 10, 7, 12, 30)


def file(n, folder="event_date=2024-10-07", **bounds):
    return File(f"w={n}/{folder}/part-{n}.parquet", 1, 10, bounds)


def test_versions_are_taken_once(spark, folder, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 4)
    root = folder("log")
    logs = [CommitLog(spark, root) for _ in range(3)]

    def add(k):
        for n in range(5):
            logs[k].commit(lambda state, n=n: Change((file(f"{k}-{n}"),)))

    threads = [threading.Thread(target=add, args=(k,)) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    fresh = CommitLog(spark, root).state()
    assert fresh.version == 15 and len(fresh.where) == 15
    assert all(log.state().where == fresh.where for log in logs)
    held = logs[0].state()
    logs[1].commit(lambda state: Change(remove=(file("0-0").path,)))
    assert len(held.where) == 15 and len(logs[0].state().where) == 14  # a reader keeps the version it has
    with pytest.raises(Conflict):
        logs[2].commit(lambda state: Change(remove=(file("0-0").path,)))
    assert logs[0].commit(lambda state: Change()) == 16
    logs[0].clean(2**62)
    assert CommitLog(spark, root).state().where == logs[1].state().where  # from the snapshot on
    assert len(logs[0]._versions("commit", 0)) < 16


def test_bounds():
    f = file(1, hour=["2024-10-07T12:00:00.000000", "2024-10-07T13:00:00.000000"])
    assert f.may_hold("hour", "2024-10-07T13:00:00.000000") and not f.may_hold("hour", "2024-10-07T13:00:00.000001")
    assert f.may_hold("hour", None, "2024-10-07T12:00:00.000000") and not f.may_hold("hour", None, "2024-10-07T11")
    assert f.may_hold("other", 1, 2) and file(2, hour=[None, None]).may_hold("hour", "x")
    assert f.folder == "event_date=2024-10-07"


def rows_of(spark, n, batch, at=NOON, first=0):
    return with_ingest(route.healthy(ingested(spark, edits(*[(i, i) for i in range(first, first + n)]), at, first)), batch)


def scans(lake, monkeypatch):
    """Files that each table is read from, from now on."""
    seen, scan = {}, lake.scan

    def watched(table, state, files, place=False):
        seen.setdefault(table.name, set()).update(f.folder for f in files)
        return scan(table, state, files, place)

    monkeypatch.setattr(lake, "scan", watched)
    return seen


def test_readers_see_one_version(spark, folder, monkeypatch):
    """A DataFrame made before a rewrite reads the old version to its end; a write that stops before its commit is not seen."""
    lake = Lake(spark, folder("lake"), grain="day")
    for n in range(3):
        lake.replace(BRONZE, rows_of(spark, 4, f"q-{n:010d}", first=4 * n))
    before = lake.read(BRONZE)
    with monkeypatch.context() as patched:
        patched.setattr(CommitLog, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            lake.replace(BRONZE, rows_of(spark, 1, "q-0000000001"))
        with pytest.raises(RuntimeError):
            maintain.compact(lake, BRONZE)
    assert lake.read(BRONZE).count() == 12
    assert maintain.compact(lake, BRONZE) == 2  # the newest batch stays, as it may be tried again
    lake.replace(BRONZE, rows_of(spark, 4, "q-0000000002", first=8))
    lake.truncate(ERRORS)
    assert before.count() == 12
    same(lake.read(BRONZE).drop("batch"), before.drop("batch"))
    batches = {p.split("-")[0] for p in lake.partitions(BRONZE, "ingest_date=2024-10-07")}
    assert batches == {"batch=merged", "batch=q"}
    later = dt.datetime.now() + dt.timedelta(hours=1)
    assert maintain.clean(lake, [BRONZE], later) >= 4  # replaced files, and those of the writes that stopped
    same(Lake(spark, lake.root, "day").read(BRONZE).drop("batch"), lake.read(BRONZE).drop("batch"))
    assert lake.read(BRONZE).count() == 12


def test_deletion_marks(spark, folder):
    lake = Lake(spark, folder("lake"), grain="day")
    rows = spark.range(100_000).selectExpr(
        "concat('t', id) AS title", "concat('u', id % 7) AS user", "CAST(id % 2 AS INT) AS bot",
        "timestamp_seconds(1728302400 + id) AS timestamp", "'é' AS comment", "timestamp_seconds(1728400000) AS ingested_at", "id",
    )
    lake.replace(TYPED_EVENTS, with_day(rows.drop("id").withColumn("batch", F.lit("q-0000000000")), "timestamp"))
    files = lake.log(TYPED_EVENTS).state().where
    assert maintain.delete_where(lake, TYPED_EVENTS, F.col("user") == "u3") == rows.where("user = 'u3'").count()
    assert maintain.delete_where(lake, TYPED_EVENTS, F.expr("user IN ('u3', 'u4') OR title = 't99999'")) == rows.where("user = 'u4' OR id = 99999").count()
    assert maintain.delete_where(lake, TYPED_EVENTS, F.lit(None).cast("boolean")) == 0
    state = lake.log(TYPED_EVENTS).state()
    assert state.where == files and len(state.marks) == 2  # not a file was rewritten
    kept = rows.where("user NOT IN ('u3', 'u4') AND id <> 99999").drop("id")
    same(lake.read(TYPED_EVENTS), kept)
    assert maintain.table_sizes(lake, [TYPED_EVENTS]).first()["total_rows"] == kept.count()
    # Marked files are folded into whole ones, also where they are alone.
    lake.replace(TYPED_EVENTS, with_day(rows.limit(0).drop("id").withColumn("batch", F.lit("q-0000000001")), "timestamp"))
    lake.replace(TYPED_EVENTS, with_day(rows.limit(1).drop("id").withColumn("batch", F.lit("q-0000000002")), "timestamp"))
    assert maintain.compact(lake, TYPED_EVENTS) == len(files)
    state = lake.log(TYPED_EVENTS).state()
    assert not state.deleted and not state.marks
    same(lake.read(TYPED_EVENTS), kept.union(rows.limit(1).drop("id")))


def test_deletion_and_rewrite_side_by_side(spark, folder, monkeypatch):
    lake = Lake(spark, folder("lake"), grain="day")
    for n in range(3):
        lake.replace(BRONZE, rows_of(spark, 4, f"q-{n:010d}", first=4 * n))
    other, write = Lake(spark, lake.root, "day"), lake.write

    def meanwhile(*args):
        other.delete(BRONZE, lambda df: df.where("kafka_offset = 1"))
        return write(*args)

    monkeypatch.setattr(lake, "write", meanwhile)
    with pytest.raises(Conflict):  # else the deleted row would come back
        maintain.compact(lake, BRONZE)
    monkeypatch.undo()
    assert lake.read(BRONZE).where("kafka_offset = 1").count() == 0
    maintain.compact(lake, BRONZE)
    assert sorted(r.kafka_offset for r in lake.read(BRONZE).collect()) == [0, *range(2, 12)]


def test_files_outside_a_range_are_not_opened(spark, folder, monkeypatch):
    lake = Lake(spark, folder("lake"))
    Pipeline(lake).ingest(ingested(spark, edits(*[(i, 600 * i) for i in range(24)]), NOON), 0)
    seen = scans(lake, monkeypatch)
    low, high = (dt.datetime(2024, 10, 7, h, tzinfo=dt.timezone.utc) for h in (13, 14))
    found = lake.read_range(SILVER, "event_timestamp", low, high)
    assert sorted(r.event_id for r in found.collect()) == list(range(6, 13))
    assert seen[SILVER.name] == {"event_date=2024-10-07/event_hour=13", "event_date=2024-10-07/event_hour=14"}
    assert lake.read_range(SILVER, "wiki", "f").count() == 0 and lake.read_range(SILVER, "wiki", None, "enwiki").count() == 24
    bounds = maintain.file_bounds(lake, SILVER).agg(F.min("low_event_timestamp"), F.max("high_event_id"), F.sum("rows")).first()
    assert tuple(bounds)[1:] == (23, 24) and bounds[0].minute == 0
    counts = {r["table"]: r["partitions"] for r in maintain.partition_counts(lake, [SILVER, TOP_USERS]).collect()}
    assert counts == {SILVER.name: 4, TOP_USERS.name: 1}  # hours of the one, days of the other


def test_second_batch_reads_only_its_hours(spark, folder, monkeypatch):
    """The daily table of a full day is brought up to date from partial rows; of silver, only the hours of the batch are read."""
    lake = Lake(spark, folder("lake"))
    first = edits(*[(i, 600 * i) for i in range(24)])
    Pipeline(lake).ingest(ingested(spark, first, NOON), 0)
    parts = {f.path for f in lake.log(USER_TITLES).state().files()}
    seen = scans(lake, monkeypatch)
    second = [*edits((100, 3600), (3, 1800)), {**edits((101, 3700))[0], "title": "Other"}]
    Pipeline(lake).ingest(ingested(spark, second, NOON, 100), 1)
    assert seen[SILVER.name] == {f"event_date=2024-10-07/event_hour={h}" for h in (12, 13)}
    assert len(parts - {f.path for f in lake.log(USER_TITLES).state().files()}) == 2
    all_rows = ingested(spark, first, NOON).unionByName(ingested(spark, second, NOON, 100))
    assert_equals_batch(lake, all_rows.drop("_error"))
    assert lake.read(TOP_USERS).first()["pages_touched"] == 2


@pytest.mark.parametrize("stopped_at", [SILVER_LOG, SILVER])
def test_deletion_stopped_half_way(spark, folder, monkeypatch, stopped_at):
    """Its hours are noted before anything else, so the next refresh brings all tables to one state, and it can be repeated."""
    lake = Lake(spark, folder("lake"), grain="day")
    messages = stamped(spark, events(20))
    Pipeline(lake).ingest(wire.with_error(messages), 0)
    delete = lake.delete
    with monkeypatch.context() as patched:
        patched.setattr(lake, "delete", lambda t, *a: delete(t, *a) if t != stopped_at else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            maintain.delete_where(lake, SILVER, F.col("user") == "Ann")
    assert len(lake.partitions(TOUCHED)) == 1
    Pipeline(lake).refresh_touched()
    assert lake.partitions(TOUCHED) == []
    maintain.delete_where(lake, SILVER, F.col("user") == "Ann")
    silver = m.silver_of(m.bronze_of(messages)).where("user != 'Ann'")
    same(lake.read(SILVER), silver)
    same(lake.read(GOLD[0]).select("hour", "wiki", "total_edits"), m.hourly_stats(m.activity(silver)).select("hour", "wiki", "total_edits"))


def test_deletion_of_one_topic(spark, folder):
    """Two topics may deliver under the same partition, offset and time; only the event that was deleted goes."""
    lake = Lake(spark, folder("lake"), grain="day")
    one = stamped(spark, [FULL])
    two = stamped(spark, [{**FULL, "id": 7, "user": "Other"}]).withColumn("kafka_topic", F.lit("second"))
    Pipeline(lake).ingest(wire.with_error(one.unionByName(two)), 0)
    maintain.delete_where(lake, SILVER, F.col("user") == "Other")
    assert [r.kafka_topic for r in lake.read(BRONZE).collect()] == ["wiki-events"]
