import json
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return lambda name: f"{tmp_path}/{name}-{uuid.uuid4().hex[:8]}"


# One event with all fields, and two sparse ones: by a bot, and by somebody without an account.
FULL = {
    "id": 70011, "type": "edit", "namespace": 4, "title": "Harbour lights", "page_id": 512, "user": "Ann",
    "bot": False, "minor": True, "patrolled": False, "comment": "two sources more", "timestamp": 1728307200, "wiki": "dewiki",
    "length": {"old": 900, "new": 860}, "revision": {"old": 41, "new": 42}, "meta": {"id": "event-70011", "domain": "de.example.org"},
}
BOT = {
    "id": 70012, "type": "new", "title": "List of piers", "user": "PierBot", "bot": True,
    "timestamp": 1728307260, "wiki": "commonswiki", "meta": {"id": "event-70012"},
}
ANONYMOUS = {
    "id": 70013, "type": "edit", "title": "Tides", "user": "~guest-7", "bot": False,
    "timestamp": 1728307320, "wiki": "svwiki", "meta": {"id": "event-70013"},
}

_SCHEMA = (
    "raw_message string, kafka_topic string, kafka_partition bigint, kafka_offset bigint, "
    "kafka_timestamp timestamp, kafka_key string, ingested_at timestamp"
)


def stamped(spark, events, at="2024-10-08 00:00:00"):
    """Events (dicts or raw texts) as a stamped envelope, offsets in the given order."""
    import datetime as dt

    when = dt.datetime.fromisoformat(at).replace(tzinfo=dt.timezone.utc)
    rows = [
        (e if isinstance(e, str) or e is None else json.dumps(e, ensure_ascii=False), "wiki-events", 0, i, when, "", when)
        for i, e in enumerate(events)
    ]
    return spark.createDataFrame(rows, _SCHEMA)
