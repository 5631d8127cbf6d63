"""Table schemas, sort keys, partitioning and retention."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Topic, accepted types, text limits and retention periods of the data model.
TOPIC = "wiki-events"
KEPT_TYPES = ("edit", "new")
ANONYMOUS_PREFIX = "~"
SITE_SUFFIX = "wiki"
COMMENT_CHARS = 500
FRAME_PREFIX = "data: "
BROKEN_MESSAGE_BUDGET = 10
MAX_EPOCH_SECONDS = 4294967295
LATEST_ACCEPTED_DAYS = 90

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def _columns(text: str) -> T.StructType:
    """``"a int, b string"`` as a schema; unlike ``fromDDL`` it needs no running session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


#: What is read from the JSON text of an event.
WIRE = (
    "id bigint, type string, namespace int, title string, page_id bigint, user string, "
    "bot boolean, minor boolean, patrolled boolean, comment string, timestamp bigint, wiki string, "
    "length struct<old: bigint, new: bigint>, revision struct<old: bigint, new: bigint>, "
    "meta struct<id: string, domain: string>"
)

ENVELOPE = _columns(
    "raw_message string, kafka_topic string, kafka_partition bigint, kafka_offset bigint, "
    "kafka_timestamp timestamp, kafka_key string"
)


@dataclass(frozen=True)
class Table:
    """A stored table: what it holds, how it is laid out and how long it lives."""

    name: str
    columns: T.StructType
    partitions: T.StructType
    sort_key: tuple[str, ...]
    age_column: str | None = None
    keep_days: int | None = None

    @property
    def partition_names(self) -> list[str]:
        return self.partitions.fieldNames()

    @property
    def stored(self) -> T.StructType:
        return T.StructType(self.columns.fields + self.partitions.fields)


# Names, columns, keys and retention days of the tables.

BY_INGEST = _columns("ingest_date date, batch string")
BY_HOUR = _columns("event_date date, event_hour int")
BY_DAY_AND_BATCH = _columns("event_date date, batch string")
BY_DAY = _columns("event_date date")

BRONZE = Table(
    "bronze_wiki_events",
    T.StructType(ENVELOPE.fields + _columns("ingested_at timestamp").fields),
    BY_INGEST,
    ("ingested_at", "kafka_partition", "kafka_offset"),
    "ingested_at",
    30,
)

ERRORS = Table(
    "bronze_wiki_events_errors",
    _columns(
        "kafka_topic string, kafka_partition bigint, kafka_offset bigint, raw_message string, "
        "error_message string, ingested_at timestamp"
    ),
    BY_INGEST,
    ("ingested_at", "kafka_partition", "kafka_offset"),
    "ingested_at",
    7,
)

SILVER_KEY = ("event_timestamp", "wiki", "event_id")
SILVER_NEWEST = ("ingested_at", "kafka_partition", "kafka_offset")

_SILVER_COLUMNS = _columns(
    "event_id bigint, event_uuid string, event_type string, namespace int, title string, "
    "page_id bigint, user string, user_is_bot int, user_is_anonymous int, wiki string, "
    "language string, domain string, comment string, is_minor int, is_patrolled int, "
    "length_old bigint, length_new bigint, length_delta bigint, revision_old bigint, "
    "revision_new bigint, event_timestamp timestamp, ingested_at timestamp"
)

SILVER = Table("silver_wiki_events", _SILVER_COLUMNS, BY_HOUR, SILVER_KEY, "event_timestamp", LATEST_ACCEPTED_DAYS)

#: Every accepted delivery, duplicates included; ``SILVER`` is its latest state.
SILVER_LOG = Table(
    "silver_wiki_events_log",
    T.StructType(_SILVER_COLUMNS.fields + _columns("kafka_partition bigint, kafka_offset bigint").fields),
    BY_DAY_AND_BATCH,
    SILVER_KEY,
    "event_timestamp",
    # One day longer than rows are accepted for, so a day is never rebuilt from a part of its log.
    LATEST_ACCEPTED_DAYS + 1,
)

#: Where the deliveries stand in bronze that compaction has taken out of the log, so that a deletion still finds them.
SUPERSEDED = Table(
    "silver_superseded",
    _columns(
        "event_timestamp timestamp, wiki string, event_id bigint, ingested_at timestamp, kafka_partition bigint, kafka_offset bigint"
    ),
    BY_DAY_AND_BATCH,
    SILVER_KEY,
    "event_timestamp",
    LATEST_ACCEPTED_DAYS + 1,
)

#: Hours whose silver and gold rows are older than their log; one entry per micro-batch.
TOUCHED = Table("touched_hours", _columns("event_date date, event_hour int"), _columns("batch string"), ())

HOURLY_STATS = Table(
    "gold_wiki_hourly_stats",
    _columns(
        "hour timestamp, wiki string, language string, total_edits bigint, bot_edits bigint, "
        "human_edits bigint, anonymous_edits bigint, minor_edits bigint, unique_users bigint, "
        "unique_pages bigint, total_length_delta bigint"
    ),
    BY_HOUR,
    ("hour", "wiki"),
    "hour",
    365,
)

TOP_USERS = Table(
    "gold_top_users_daily",
    _columns(
        "day date, wiki string, user string, user_is_bot int, user_is_anonymous int, edits bigint, "
        "pages_touched bigint, total_length_delta bigint, first_edit_at timestamp, last_edit_at timestamp"
    ),
    BY_DAY,
    ("day", "wiki", "user"),
    "day",
    365,
)

#: What the daily table is merged from: one row per hour, site, user and page, so that distinct pages add up over hours.
USER_TITLES = Table(
    "user_titles_hourly",
    _columns(
        "hour timestamp, wiki string, user string, title string, user_is_bot int, user_is_anonymous int, edits bigint, "
        "length_delta bigint, first_at timestamp, last_at timestamp"
    ),
    BY_HOUR,
    ("hour", "wiki", "user"),
    "hour",
    LATEST_ACCEPTED_DAYS + 1,
)

TOP_PAGES = Table(
    "gold_top_pages_hourly",
    _columns(
        "hour timestamp, wiki string, title string, edits bigint, unique_users bigint, "
        "bot_edits bigint, total_length_delta bigint, last_event_at timestamp"
    ),
    BY_HOUR,
    ("hour", "wiki", "title"),
    "hour",
    180,
)

LANGUAGES = Table(
    "gold_language_hourly",
    _columns(
        "hour timestamp, language string, wiki_count bigint, total_edits bigint, "
        "unique_users bigint, unique_pages bigint"
    ),
    BY_HOUR,
    ("hour", "language"),
    "hour",
    365,
)

GOLD = (HOURLY_STATS, TOP_USERS, TOP_PAGES, LANGUAGES)

#: Counts of distinct values: they cannot be merged by adding them up.
NOT_ADDITIVE = frozenset({"unique_users", "unique_pages", "pages_touched", "wiki_count"})

# The older, typed design: five fields per message, stored as they come.
TYPED_EVENTS = Table(
    "wiki_events",
    _columns(
        "title string, user string, bot int, timestamp timestamp, comment string, ingested_at timestamp"
    ),
    BY_DAY_AND_BATCH,
    ("timestamp", "title"),
    "timestamp",
    30,
)

TYPED_ERRORS = Table(
    "wiki_events_errors",
    ERRORS.columns,
    BY_INGEST,
    ("ingested_at", "kafka_topic", "kafka_partition", "kafka_offset"),
    "ingested_at",
    7,
)

#: Per-user counts of the older design, one partial row per day, batch and user; readers add them up.
USER_STATS = Table(
    "user_stats",
    _columns("user string, edits bigint"),
    BY_DAY_AND_BATCH,
    ("user",),
    "event_date",
    30,
)

#: Where broken messages go under the ``dead_letters`` policy.
DEAD_LETTERS = Table(
    "dead_letter_queue", ERRORS.columns, BY_INGEST, ("kafka_topic", "kafka_partition", "kafka_offset"), "ingested_at", 30
)

#: What each batch of a stream took in; a batch that is tried again replaces its row.
INGEST_TOTALS = Table(
    "ingest_totals",
    _columns("query string, sent bigint, skipped bigint, late bigint, ingested_at timestamp"),
    BY_INGEST,
    ("query", "ingested_at"),
    "ingested_at",
    365,
)

#: Tries of a batch that ended with an error, with the messages they failed to store.
INGEST_FAILURES = Table(
    "ingest_failures",
    _columns("query string, failed bigint, error string, ingested_at timestamp"),
    BY_INGEST,
    ("query", "ingested_at"),
    "ingested_at",
    365,
)

#: Sets of users and pages per hour and site that merge over any range, as sketches of 2^SKETCH_BITS slots.
SKETCHES = Table(
    "gold_distinct_sketches_hourly",
    T.StructType([
        T.StructField("hour", T.TimestampType()), T.StructField("wiki", T.StringType()),
        T.StructField("users_sketch", T.BinaryType()), T.StructField("pages_sketch", T.BinaryType()),
    ]),
    BY_HOUR,
    ("hour", "wiki"),
    "hour",
    365,
)
SKETCH_BITS = 14

TABLES = {
    t.name: t
    for t in (
        BRONZE, ERRORS, SILVER_LOG, SUPERSEDED, TOUCHED, SILVER, *GOLD, USER_TITLES, TYPED_EVENTS, TYPED_ERRORS, USER_STATS, DEAD_LETTERS,
        INGEST_TOTALS, INGEST_FAILURES, SKETCHES,
    )
}
