"""Bronze to silver: defaults, validation, enrichment, deduplication."""

import datetime as dt

import pytest
from conftest import ANONYMOUS, BOT, FULL, stamped

from ripplelake.functions import scalars
from ripplelake.operators import merge
from ripplelake.plans import medallion as m
from ripplelake.schema import SILVER
from pyspark.sql import functions as F


def rows(spark, *events):
    return m.silver_rows(m.bronze_of(stamped(spark, events))).orderBy("kafka_offset").collect()


def variants(spark, name, values):
    """One event per value of a field, in one job; None where the event was rejected."""
    found = {r["kafka_offset"]: r for r in rows(spark, *[{**FULL, name: v} for v in values])}
    return [found.get(i) for i in range(len(values))]


def one(spark, **changes):
    found = rows(spark, {**FULL, **changes})
    return found[0] if found else None


def test_full_event(spark):
    r = one(spark).asDict()
    assert r == {
        "event_id": 70011, "event_uuid": "event-70011", "event_type": "edit", "namespace": 4, "title": "Harbour lights",
        "page_id": 512, "user": "Ann", "user_is_bot": 0, "user_is_anonymous": 0, "wiki": "dewiki", "language": "de",
        "domain": "de.example.org", "comment": "two sources more", "is_minor": 1, "is_patrolled": 0, "length_old": 900,
        "length_new": 860, "length_delta": -40, "revision_old": 41, "revision_new": 42,
        "event_timestamp": r["event_timestamp"], "ingested_at": r["ingested_at"], "kafka_partition": 0, "kafka_offset": 0,
    }
    assert r["event_timestamp"].astimezone(dt.timezone.utc) == dt.datetime(2024, 10, 7, 13, 20, tzinfo=dt.timezone.utc)


def test_schema(spark):
    found = m.silver_of(m.bronze_of(stamped(spark, [FULL]))).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in SILVER.columns]


def test_sparse_events_take_defaults(spark):
    bot, anonymous = rows(spark, BOT, ANONYMOUS)
    assert (bot["user_is_bot"], bot["user_is_anonymous"]) == (1, 0)
    assert (anonymous["user_is_bot"], anonymous["user_is_anonymous"]) == (0, 1)
    for r in (bot, anonymous):
        assert None not in r.asDict().values()
        assert (r["namespace"], r["page_id"], r["length_delta"], r["revision_new"], r["comment"]) == (0, 0, 0, 0, "")


@pytest.mark.parametrize("name, values", [
    ("type", ["log", "categorize", None, "", 1, True, ["edit"]]),
    ("title", ["", None, 5, True, ["x"], {"x": 1}]),
    ("user", ["", None, 3.5, -1, False]),
])
def test_rejected(spark, name, values):
    assert variants(spark, name, values) == [None] * len(values)


def test_language(spark):
    expected = {
        "enwiki": "en", "commonswiki": "commons", "enwiktionary": "enwiktionary", "wiki": "", "wikiwiki": "wiki",
        "enwiki\n": "enwiki\n", "": "", "wikidatawiki": "wikidata",
    }
    assert [r["language"] for r in variants(spark, "wiki", list(expected))] == list(expected.values())


def test_anonymous_flag(spark):
    users = ["~2026-1", "192.0.2.1", "a~", "~"]
    assert [r["user_is_anonymous"] for r in variants(spark, "user", users)] == [1, 0, 0, 1]


def test_lengths(spark):
    low, high = -(2**63), 2**63 - 1
    cases = [
        ({"new": 70}, (0, 70, 70)), (None, (0, 0, 0)), ({"old": 10}, (10, 0, -10)), ({}, (0, 0, 0)), ("x", (0, 0, 0)),
        ({"old": low, "new": high}, (low, high, 0)),
    ]
    found = variants(spark, "length", [c for c, _ in cases])
    assert [(r["length_old"], r["length_new"], r["length_delta"]) for r in found] == [e for _, e in cases]


def test_comment_is_500_characters(spark):
    found = variants(spark, "comment", ["é" * 600, "😀" * 501, "x" * 500])
    assert [r["comment"] for r in found] == ["é" * 500, "😀" * 500, "x" * 500]


def test_unsigned(spark):
    found = variants(spark, "id", [-1, None, "abc", 1.5, 2**64, 2**63 - 1])
    assert [r["event_id"] for r in found] == [0, 0, 0, 0, 0, 2**63 - 1]


def test_one_mistyped_field_leaves_the_rest(spark):
    r = one(spark, id="abc", namespace="x", bot="yes", minor=1)
    assert (r["event_id"], r["namespace"], r["user_is_bot"], r["is_minor"], r["title"]) == (0, 0, 0, 0, FULL["title"])


def test_texts_that_look_like_other_types_stay(spark):
    texts = ["1984", "-5", "1e5", "true", "false", "[[Link]]", "{{Template}}", "[1]", '{"a":1}', "0", "null"]
    assert [r["title"] for r in variants(spark, "title", texts)] == texts
    assert [r["comment"] for r in variants(spark, "comment", texts)] == texts


def test_other_types_in_text_fields_are_empty(spark):
    values = [1984, -5, 1e5, True, False, ["Link"], {"a": 1}, 0]
    found = rows(spark, *[{**FULL, "comment": v, "wiki": v, "meta": {"id": v, "domain": v}} for v in values])
    assert len(found) == len(values)
    assert {(r["comment"], r["wiki"], r["event_uuid"], r["domain"]) for r in found} == {("", "", "", "")}


def test_timestamps_never_raise(spark):
    found = variants(spark, "timestamp", [None, -5, 0, 10**18, "x"])
    assert [r["event_timestamp"].timestamp() for r in found] == [0, 0, 0, 4294967295, 0]


def test_broken_messages_do_not_reach_silver(spark):
    assert len(rows(spark, FULL, "{broken", "[1]", "")) == 1


def test_latest_delivery_wins(spark):
    early = stamped(spark, [{**FULL, "comment": "old"}], "2024-10-08 00:00:00")
    late = stamped(spark, [{**FULL, "comment": "new"}], "2024-10-08 01:00:00")
    for order in (early.unionByName(late), late.unionByName(early)):
        assert [r["comment"] for r in m.silver_of(m.bronze_of(order)).collect()] == ["new"]


def test_offset_breaks_ties(spark):
    both = stamped(spark, [{**FULL, "comment": "first"}, {**FULL, "comment": "second"}])
    assert [r["comment"] for r in m.silver_of(m.bronze_of(both)).collect()] == ["second"]


def test_other_timestamp_or_site_is_another_row(spark):
    found = m.silver_of(m.bronze_of(stamped(spark, [FULL, {**FULL, "timestamp": 1728307201}, {**FULL, "wiki": "enwiki"}])))
    assert found.count() == 3


def test_hot_key_is_reduced_before_the_shuffle(spark):
    copies = spark.range(0, 60000, 1, 8).select(
        F.expr("if(id % 3 = 2, -1, id)").alias("k"), F.col("id").alias("v"), F.concat(F.lit("row "), "id").alias("what")
    )
    latest = merge.keep_latest(copies, ["k"], ["v"])
    assert latest.count() == 40001
    assert [r["what"] for r in latest.where("k = -1").collect()] == ["row 59999"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_readable_size(spark):
    expected = {
        0: "0.00 B", 1023: "1023.00 B", 1024: "1.00 KiB", 1536: "1.50 KiB", 5 * 1024**2: "5.00 MiB", 3 * 1024**3: "3.00 GiB",
        2 * 1024**4: "2.00 TiB", 1024**5: "1.00 PiB", 1024**6: "1.00 EiB",
    }
    df = spark.createDataFrame([(n,) for n in expected], "n bigint").select("n", scalars.readable_size(F.col("n")).alias("t"))
    assert {r["n"]: r["t"] for r in df.collect()} == expected
