"""Change messages derived from the ``events`` table, as described in FIXTURES.md section 4."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelake.functions.wire import spread
from ripplelake.schema import FRAME_PREFIX, TOPIC

# The sites the users of the fixture are spread over.
SITES = [
    "enwiki", "dewiki", "frwiki", "eswiki", "commonswiki", "wikidatawiki", "enwiktionary", "commons",
]

WIKI = f"element_at(array({', '.join(repr(s) for s in SITES)}), CAST(user_id % 8 + 1 AS INT))"
USER = (
    "CASE WHEN event_id % 89 = 0 THEN '' WHEN user_id % 10 = 7 THEN '~2024-' || user_id "
    "WHEN user_id % 10 = 3 THEN 'Bot' || user_id ELSE 'User' || user_id END"
)
IS_BOT = "(user_id % 10 = 3 OR user_id % 50 = 7)"
TITLE = "CASE WHEN event_id % 97 = 0 THEN '' ELSE 'Page ' || k END"
SIZE = "CAST(1000 + k AS BIGINT)"

#: The fields of a change event; a null field is left out of its JSON text.
CHANGE = {
    "id": "event_id",
    "type": "CASE WHEN event_type IN ('click', 'view') THEN 'edit' WHEN event_type = 'purchase' THEN 'new' "
    "WHEN event_type = 'signup' THEN 'categorize' ELSE 'log' END",
    "namespace": "k % 16",
    "title": TITLE,
    "page_id": SIZE,
    "user": USER,
    "bot": IS_BOT,
    "minor": "k % 3 = 0",
    "patrolled": "CASE WHEN k % 4 != 0 THEN k % 2 = 0 END",
    "comment": "CASE WHEN copy = 1 THEN 'v2' ELSE repeat('é', 10 * k) END",
    "timestamp": "unix_timestamp(ts)",
    "wiki": WIKI,
    "length": f"named_struct('old', CASE WHEN event_type != 'purchase' THEN {SIZE} END, "
    f"'new', {SIZE} + floor(value) * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END)",
    "revision": "named_struct('old', 2 * event_id, 'new', 2 * event_id + 1)",
    "meta": f"named_struct('id', 'uuid-' || event_id, 'domain', {WIKI} || '.example.org')",
}

TYPED = {
    "title": TITLE,
    "user": USER,
    "bot": f"CASE WHEN event_id % 60 = 7 THEN 'yes' ELSE CAST(CAST({IS_BOT} AS INT) AS STRING) END",
    "timestamp": "unix_timestamp(ts)",
    "comment": "CASE WHEN k % 5 != 0 THEN repeat('é', k) END",
}

DOCUMENT = {
    "id": "doc_id",
    "type": "'new'",
    "title": "'Doc ' || doc_id",
    "user": "source",
    "comment": "text",
    "timestamp": "1704067200 + doc_id % 86400",
    "wiki": "lang || 'wiki'",
    "length": "named_struct('new', n_chars)",
}


#: Rows that one task makes messages of.
TASK_ROWS = 100_000


def dealt(rows: DataFrame) -> DataFrame:
    """The rows over as many tasks as their number needs.

    A message is many times longer than its row, and a file is read by no more tasks than it has row groups, so a table of one
    would be made into messages, parsed and sorted by a single task.  Dealt by all columns: rows without a key are spread as well.
    """
    tasks = -(-rows.count() // TASK_ROWS)
    if tasks < 2:
        return rows
    return rows.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism), *rows.columns)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_k(dealt(spark.read.parquet(f"{sf_dir}/events.parquet")))


def with_k(events: DataFrame) -> DataFrame:
    # The session runs in UTC, so the zoneless column keeps its wall clock time.
    return spread(events.withColumn("ts", F.col("ts").cast("timestamp")), F.from_json("props", "k int"))


def as_json(fields: dict[str, str]) -> Column:
    members = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return F.expr(f"to_json(named_struct({members}), map('ignoreNullFields', 'true'))")


def cut(text: Column) -> Column:
    """Every 50th message loses its last ten characters."""
    return F.when(F.expr("event_id % 50 = 1"), F.substring(text, F.lit(1), F.length(text) - 10)).otherwise(text)


def _delivered(events: DataFrame, text: Column, key: str) -> DataFrame:
    arrival = "ts + INTERVAL 2 SECONDS + copy * INTERVAL 1 HOUR"
    return events.select(
        text.alias("raw_message"),
        F.lit(TOPIC).alias("kafka_topic"),
        F.expr("event_id % 3 AS kafka_partition"),
        F.expr("2 * event_id + copy AS kafka_offset"),
        F.expr(f"{arrival} AS kafka_timestamp"),
        F.expr(f"{key} AS kafka_key"),
        F.expr(f"{arrival} AS ingested_at"),
    )


def change_messages(events: DataFrame) -> DataFrame:
    """Works on a static and on a streaming ``events``; every 20th message is delivered twice."""
    sent = events.select("*", F.expr("explode(CASE WHEN event_id % 20 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"))
    return _delivered(sent, cut(as_json(CHANGE)), "'uuid-' || event_id")


def recent_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped envelope: redelivered and broken messages included."""
    return change_messages(_events(spark, sf_dir))


def typed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the older design; every 60th has a text where a number belongs."""
    # Flags are numbers in this format; only the mistyped ones are quoted.
    text = F.regexp_replace(as_json(TYPED), '"bot":"([01])"', '"bot":$1')
    return _delivered(_events(spark, sf_dir).withColumn("copy", F.lit(0)), cut(text), "''")


def framed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as a server sends them: frames, heartbeats, blank lines, near misses, rejects.

    The fields that may serve as the message key come and go with the event number.
    """
    fields = {
        "id": "event_id % 1000",
        "title": f"CASE WHEN event_id % 6 != 2 THEN {TITLE} END",
        "meta": "CASE WHEN event_id % 6 NOT IN (1, 2) THEN named_struct('id', CASE event_id % 6 "
        "WHEN 5 THEN '' WHEN 3 THEN NULL ELSE 'uuid-' || event_id END, 'domain', 'd') END",
    }
    text = as_json(fields)
    flat_meta = F.regexp_replace(text, '"meta":[{][^}]*[}]', '"meta":"none"')
    text = F.when(F.expr("event_id % 6 = 4"), flat_meta).otherwise(text)
    text = F.when(F.expr("event_id % 31 = 3"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(cut(text))
    line = (
        F.when(F.expr("event_id % 10 = 4"), ": heartbeat")
        .when(F.expr("event_id % 10 = 9"), "")
        .when(F.expr("event_id % 29 = 5"), F.concat(F.lit("data:"), text))
        .otherwise(F.concat(F.lit(FRAME_PREFIX), text))
    )
    return _events(spark, sf_dir).select("event_id", line.alias("value"))


def document_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as change events: whole texts of every length as comments, in several languages."""
    arrival = "timestamp_seconds(1704153600 + doc_id)"
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        as_json(DOCUMENT).alias("raw_message"),
        F.lit(TOPIC).alias("kafka_topic"),
        F.expr("doc_id % 3 AS kafka_partition"),
        F.expr("doc_id AS kafka_offset"),
        F.expr(f"{arrival} AS kafka_timestamp"),
        F.lit("").alias("kafka_key"),
        F.expr(f"{arrival} AS ingested_at"),
    )
