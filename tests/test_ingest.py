"""Framed lines, message keys, bytes, JSON validity and counters."""

import json

import pytest
from conftest import ANONYMOUS, BOT, FULL, stamped
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ripplelake.functions import wire
from ripplelake.operators import route
from ripplelake.sources import kafka, messages


def lines(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")


def frame(event):
    return "data: " + json.dumps(event, ensure_ascii=False)


def keys(spark, events):
    sent, _ = messages.outgoing(lines(spark, [frame(e) for e in events]))
    return [r["kafka_key"] for r in sent.orderBy("n").collect()]


KEY_CASES = [
    (FULL, FULL["meta"]["id"]),
    ({"meta": {"id": "k-1"}, "title": "Elbe", "id": 3}, "k-1"),
    ({"id": 31, "title": "Elbe"}, "Elbe"),
    ({"id": -31}, "-31"),
    ({"type": "log"}, ""),
    ({"meta": {"stream": "s"}, "title": "Rhône"}, "Rhône"),
    ({"meta": 17, "title": "Elbe"}, "Elbe"),
    ({"meta": {"id": "", "stream": "s"}, "title": "Elbe"}, "Elbe"),
    ({"id": 2**40}, str(2**40)),
    ({"id": 0}, ""),
    ({"id": "0"}, "0"),
    ({"title": 0, "id": 5}, "5"),
    ({"title": None, "id": 5}, "5"),
    ({"title": False, "id": 5}, "5"),
    ({"title": True}, "True"),
    ({"title": [], "id": 5}, "5"),
    ({"title": {}, "id": 5}, "5"),
    ({"meta": None, "title": "x"}, "x"),
    ({"meta": {"id": 12}, "title": "x"}, "12"),
    ({"meta": [1], "title": "x"}, "x"),
]


def test_message_keys(spark):
    assert keys(spark, [e for e, _ in KEY_CASES]) == [k for _, k in KEY_CASES]


def test_equal_ids_give_equal_keys(spark):
    first, second = keys(spark, [FULL, {**FULL, "timestamp": 1728307900}])
    assert first == second


def test_key_type_is_text(spark):
    sent, _ = messages.outgoing(lines(spark, [frame({"id": 7})]))
    assert dict(sent.dtypes)["kafka_key"] == "string"


def counted(spark, texts):
    row = messages.ingest_counters(lines(spark, texts)).first()
    return row["sent"], row["skipped"]


def test_burst_of_ten(spark):
    burst = [frame({**BOT, "id": i, "meta": {"id": f"uuid-{i}"}}) for i in range(10)]
    assert counted(spark, burst) == (10, 0)


MIXED = [
    ": keep-alive",
    'data: {"meta": {"id": "k-7"}, "title": "Oder"}',
    "",
    'data: {"title": "Weser", "id": 12}',
    "data: {title: Oder}",
    "retry: 500",
]


def test_mixed_lines(spark):
    assert counted(spark, MIXED) == (2, 1)


def test_near_misses(spark):
    assert counted(spark, ['data:{"id":3}', " data: {}", "event: x", "DATA: {}"]) == (0, 0)
    assert counted(spark, ["data: [1]", "data: 1", "data: null", "data: "]) == (0, 4)


def test_rejects_keep_their_reason(spark):
    _, rejected = messages.outgoing(lines(spark, MIXED + ["data: [1]", "data:  "]))
    found = [(r["raw_message"], r["error_message"]) for r in rejected.orderBy("n").collect()]
    assert found == [
        ("{title: Oder}", "malformed JSON"), ("[1]", "not a JSON object"), (" ", "empty message"),
    ]


def test_observed_totals(spark):
    seen = Observation("ingest")
    checked_good, _ = messages.outgoing(lines(spark, MIXED), seen)
    checked_good.collect()
    assert seen.get == {"sent": 2, "skipped": 1}


def test_whole_event_is_sent(spark):
    sent, _ = messages.outgoing(lines(spark, [frame(FULL)]))
    record = messages.kafka_records(sent).first()
    assert json.loads(bytes(record["value"])) == FULL
    assert record["topic"] == "wiki-events"
    assert bytes(record["key"]) == b"event-70011"


@pytest.mark.parametrize("text", ['{"x":1}', '{ "river" : "Düna, Ὕδωρ" }', '{"deep": [{"er": [[], {"n": 1.50}]}]}'])
def test_value_bytes_are_unchanged(spark, text):
    df = spark.createDataFrame([(text,)], "raw_message string").select(messages.value_bytes().alias("b"))
    assert bytes(df.first()["b"]) == text.encode("utf-8")


@pytest.mark.parametrize("key, expected", [("Python", b"Python"), ("", None), (None, None), ("é", "é".encode())])
def test_key_bytes(spark, key, expected):
    df = spark.createDataFrame([(key,)], "kafka_key string").select(messages.key_bytes().alias("b"))
    found = df.first()["b"]
    assert (None if found is None else bytes(found)) == expected


def python_says(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


TRICKY = [
    '{"a":1}', '{"a":1} {"b":2}', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}]', '{"a":1}]}', '{"a":1}]} junk', "[1]",
    "1", "null", '"x"', "true", "", "  ", '{"a":1', '{"a":1}}', '{"a":NaN}', '{"a":-Infinity}', '{"a":1,"a":2}', "{'a':1}",
    "{a:1}", ' {"a":"x"} ', '\t{"a":1}\n', '{"a":{"b":[1,{"c":2}]}}', '{"a":"\t"}', '{"a":01}', '{"a":1,}', '{"_items":1}',
    '{"_broken":"x","_end":5}', "nope", '{"a":tru}', '{"a":"\\x"}', '{"a":"\\u00e9"}', '{"a":"😀"}', '{"a":+1}', '{"a":.5}',
    '{"a":1e400}', "{}", "{}{}", '{"a":"' + "x" * 5000 + '"}', '{"n":18446744073709551615}', "{/**/}", '{"a":1}#',
    '{"a":1}],"x":[{}', '{"id":1}],"_one":[{"id":2}', '{"a":1},"_items":{}', '{"a":1}],"_end":1,"z":[{}', '{"a":1},"x":{}', '{}],[{}',
]


def errors_of(spark, texts):
    checked = wire.with_error(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, raw_message string"))
    return [r["_error"] for r in checked.orderBy("n").collect()]


def test_validity_is_that_of_a_strict_parser(spark):
    found = [e == "" for e in errors_of(spark, TRICKY)]
    assert dict(zip(TRICKY, found)) == {t: python_says(t) for t in TRICKY}


def test_missing_message_is_an_error(spark):
    assert errors_of(spark, [None]) == ["empty message"]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**70), 2**70) | st.floats(allow_nan=False) | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=4), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(json_values, min_size=20, max_size=40), st.integers(0, 5))
def test_validity_of_generated_values(spark, values, cut):
    texts = [json.dumps(v, ensure_ascii=False) for v in values]
    texts = [t for t in texts if all(not 0xD800 <= ord(c) <= 0xDFFF for c in t)]
    texts += [t[: max(0, len(t) - cut)] for t in texts]
    assert [e == "" for e in errors_of(spark, texts)] == [python_says(t) for t in texts]


def test_lazy_stop_on_error(spark):
    good, bad = stamped(spark, [FULL]), stamped(spark, [FULL, "{broken"])
    assert route.stop_on_error(wire.with_error(good)).count() == 1
    with pytest.raises(Exception, match="broken message: malformed JSON"):
        route.stop_on_error(wire.with_error(bad)).collect()


def test_peek_takes_the_oldest(spark):
    df = stamped(spark, [{"id": i} for i in range(20)])
    assert [r["kafka_offset"] for r in messages.peek(df).collect()] == [0, 1, 2, 3, 4]


def test_kafka_options():
    options = kafka.read_options("broker:9092", max_per_trigger=1000, min_partitions=6, starting="latest")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "wiki-events", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000", "minPartitions": "6",
    }
    assert kafka.WRITE_OPTIONS["kafka.acks"] == "all"
    assert kafka.WRITE_OPTIONS["kafka.enable.idempotence"] == "true"
    assert kafka.WRITE_OPTIONS["kafka.compression.type"] == "gzip"


def test_kafka_records_take_the_common_envelope(spark):
    raw = spark.createDataFrame(
        [(None, b'{"id":1}', "wiki-events", 2, 7)], "key binary, value binary, topic string, partition int, offset bigint"
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    row = messages.from_kafka(raw).first()
    assert (row["raw_message"], row["kafka_partition"], row["kafka_offset"], row["kafka_key"]) == ('{"id":1}', 2, 7, "")


def test_no_text_is_cut(spark):
    long = {"id": 1, "comment": "x" * 2_000_000}
    sent, _ = messages.outgoing(lines(spark, [frame(long)]))
    assert len(sent.first()["raw_message"]) > 2_000_000
