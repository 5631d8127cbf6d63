"""Backfill, replay, retention, deletion, compaction, snapshots and storage reports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplelake.functions import wire
from ripplelake.functions.scalars import readable_size
from ripplelake.operators import merge
from ripplelake.operators.report import AsOf, moment
from ripplelake.plans import medallion as m
from ripplelake.schema import (
    BRONZE, GOLD, SILVER, SILVER_KEY, SILVER_LOG, SILVER_NEWEST, SUPERSEDED, TABLES, TOUCHED, USER_STATS, USER_TITLES, Table,
)
from ripplelake.session import scratch
from ripplelake.sources.commits import Change, File, State
from ripplelake.sources.lake import PLACE, Lake, day_folder, with_day, with_hour
from ripplelake.streaming.pipeline import DELETION, Pipeline, rebuild

#: How Spark cuts and packs files into tasks.
SPLIT, OPEN_COST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"

#: Days each table keeps its rows; override entries to change a table.
RETENTION = {t.name: t.keep_days for t in TABLES.values() if t.keep_days is not None}


# Backfill and replay


def replay(lake: Lake, first_day: dt.date | None = None, last_day: dt.date | None = None) -> None:
    """Rebuild silver and gold from the bronze rows ingested in a range of days (all days by default).

    The rows enter the log once more under the name of the range and collapse with those already there, so
    replaying any range any number of times changes nothing that was right.  Rows that were too late when they were
    ingested, and rows of days whose log has expired since, stay out, as in ingestion.
    """
    bronze = lake.read(BRONZE)
    if first_day is not None:
        bronze = bronze.where(F.col("ingest_date") >= F.lit(first_day))
    if last_day is not None:
        bronze = bronze.where(F.col("ingest_date") <= F.lit(last_day))
    name = f"replay-{first_day or 'first'}-{last_day or 'last'}"
    rows = m.silver_rows(bronze).where(m.in_time(lake.whole_days_from())).withColumn("batch", F.lit(name))
    lake.replace(SILVER_LOG, with_day(rows, "event_timestamp"))
    written = lake.read(SILVER_LOG).where(F.col("batch") == name)
    hours = with_hour(written.select("event_timestamp"), "event_timestamp")
    rebuild(lake, hours.select("event_date", "event_hour").distinct().collect())


# Retention and deletion


def retained(df: DataFrame, table: Table, as_of: AsOf = None, days: int | None = None) -> DataFrame:
    """Rows young enough to be kept."""
    keep = RETENTION[table.name] if days is None else days
    return df.where(F.col(table.age_column) >= moment(as_of) - F.expr(f"INTERVAL {keep} DAYS"))


def expire(
    lake: Lake, as_of: dt.datetime, retention: dict[str, int] | None = None, exact: bool = True
) -> dict[str, int]:
    """Drop what is too old from every table; returns the number of day folders dropped per table.

    Whole days go by their folder.  Of the day the limit falls into, the old rows are marked as deleted; ``exact=False`` leaves
    that day alone until it is wholly too old.
    """
    dropped = {}
    for name in RETENTION:
        table = TABLES[name]
        days = (retention or {}).get(name, keep_days(lake, table))
        limit = as_of.astimezone(dt.timezone.utc) - dt.timedelta(days=days)
        # Remembered first: a rebuild must not take a half-expired day for a whole one.
        lake.expire_below(table, limit if exact else dt.datetime.combine(limit.date(), dt.time(), dt.timezone.utc))
        dropped[name] = _drop_days_before(lake, table, limit)
        if exact and table is not USER_STATS:  # a partial row of those counts a whole day: it goes with its day
            _delete_older(lake, table, table.age_column, limit)
    return dropped


def set_retention(lake: Lake, table: Table, days: int) -> None:
    """Change how long a stored table keeps its rows, from the next ``expire`` on and for every later session."""
    if days < 1:
        raise ValueError("a table keeps its rows for a day at least")
    lake.log(table).commit(lambda state: Change(settings={"keep_days": days}, name="retention"))


def keep_days(lake: Lake, table: Table) -> int:
    return lake.log(table).state().settings.get("keep_days", RETENTION[table.name])


def _drop_days_before(lake: Lake, table: Table, limit: dt.datetime) -> int:
    old = [p for p in lake.partitions(table) if p < f"{table.partition_names[0]}={limit.date()}"]
    lake.drop(table, old)
    return len(old)


def _delete_older(lake: Lake, table: Table, column: str, limit: dt.datetime) -> None:
    """Rows of the limit's day that are older than it."""
    day = f"{table.partition_names[0]}={limit.date()}"
    old = F.col(column) < F.lit(limit).cast("timestamp")
    lake.delete(table, lambda df: df.where(old), lambda f: f.folder.split("/")[0] == day)


def delete_ingested_before(lake: Lake, table: Table, limit: dt.datetime) -> None:
    """Delete by ingestion time; days that lie wholly before ``limit`` are dropped unread."""
    _drop_days_before(lake, table, limit)
    _delete_older(lake, table, "ingested_at", limit)


def delete_where(lake: Lake, table: Table, predicate: Column) -> int:
    """Delete matching rows for good; returns how many of ``table``.

    Events deleted from silver go from bronze and the log as well, in all their deliveries, and gold is computed anew for
    their hours; otherwise the next refresh or replay would bring them back.  Gold itself is no target: it follows from silver.

    Rows are marked, files are not rewritten; ``compact`` and ``clean`` remove the bytes.  The log knows where each delivery stands
    in bronze, also of those that compaction has merged, so bronze is looked up by position and only rows found there are parsed.  The hours are
    noted first: after a crash the next refresh computes them anew, and the deletion can be repeated.
    """
    if table in GOLD or table == USER_TITLES:
        raise ValueError(f"{table.name} follows from {SILVER.name}: delete there")
    if table != SILVER:
        return lake.delete(table, lambda df: df.where(predicate))
    aside = scratch(lake.spark, "deleted")
    lake.read(SILVER).where(predicate).select(*SILVER_KEY).write.parquet(aside)
    gone = lake.spark.read.parquet(aside)
    noted = with_hour(gone, "event_timestamp").select("event_date", "event_hour").distinct()
    noted = noted.withColumn("batch", F.lit(f"{DELETION}{uuid.uuid4().hex}")).select(*TOUCHED.stored.fieldNames())
    lake.replace(TOUCHED, noted)
    days = {day_folder(r[0]) for r in noted.select("event_date").distinct().collect()}  # days of the accepted period at most

    def of_these_days(f: File) -> bool:
        return f.folder.split("/")[0] in days

    position = ["kafka_partition", "kafka_offset", "ingested_at"]
    logged = [lake.read_partitions(t, days).select(*SILVER_KEY, *position) for t in (SILVER_LOG, SUPERSEDED)]
    positions = scratch(lake.spark, "positions")
    logged[0].unionByName(logged[1]).join(gone, list(SILVER_KEY), "left_semi").select(*position).distinct().write.parquet(positions)
    at = lake.spark.read.parquet(positions)
    ingested = {f"ingest_date={r[0]}" for r in at.select(F.to_date("ingested_at")).distinct().collect()}  # days bronze keeps at most

    def deliveries(df: DataFrame) -> DataFrame:
        found = df.join(at, position, "left_semi")
        key = {"event_timestamp": wire.epoch_to_timestamp("timestamp"), "wiki": wire.strict_text("wiki"), "event_id": wire.unsigned("id")}
        keyed = wire.parse_wire(found).select(*PLACE, *[c.alias(f"_{n}") for n, c in key.items()])  # topics may share a position
        return keyed.join(gone.toDF(*[f"_{n}" for n in key]), [f"_{n}" for n in key], "left_semi")

    lake.delete(BRONZE, deliveries, lambda f: f.folder.split("/")[0] in ingested)
    for target in (SILVER_LOG, SUPERSEDED):
        lake.delete(target, lambda df: df.join(gone, list(SILVER_KEY), "left_semi"), of_these_days)
    count = lake.delete(SILVER, lambda df: df.join(gone, list(SILVER_KEY), "left_semi"), of_these_days)
    Pipeline(lake).refresh_touched()
    return count


# Compaction, other sort orders, snapshots


#: Bytes a compacted file should have; files below half of it are merged.
FILE_BYTES = 512 << 20
#: Bytes rewritten in one job: enough for a whole cluster, and what is lost if it stops.
GROUP_BYTES = 1 << 40
#: Rows of a bin at most, and those that a task reads of the log: bytes of files say little of the memory that rows need, as
#: long texts may compress to almost nothing.
FILE_ROWS, TASK_ROWS = 500_000, 200_000


def compact(
    lake: Lake, table: Table, days: Iterable[dt.date] | None = None, file_bytes: int = FILE_BYTES, file_rows: int = FILE_ROWS
) -> int:
    """Merge small files and files with deleted rows of these days (all by default); returns how many files were replaced.

    The log of silver also keeps only the latest version of every event; where the others stand in bronze is noted beside it.  Of the tables
    written by batches the newest batch of each query stays as it is: a retry replaces it by its name.  Files are packed into bins by
    their bytes and rows, a task each, and days are taken together up to ``GROUP_BYTES``, each group in one job and one commit: stopped at any point, either the
    old files of a group count or the new ones.
    """
    column, batched = table.partition_names[0], "batch" in table.partition_names
    wanted = None if days is None else {f"{column}={day}" for day in days}
    state = lake.log(table).state()
    newest = _newest_batches(state) if batched and table != SILVER_LOG else set()  # the log bears a batch twice
    by_day: dict[str, list[File]] = {}
    for f in state.files():
        day = f.folder.split("/")[0]
        if (wanted is None or day in wanted) and not (batched and f.folder.split("/")[1].removeprefix("batch=") in newest):
            by_day.setdefault(day, []).append(f)
    packed: list[list[list[File]]] = []  # bins per day
    for _, files in sorted(by_day.items()):
        if table == SILVER_LOG:
            bins = [files] if len(files) > 1 or files[0].path in state.deleted else []
        else:
            bins = [b for home in _homes(files, batched) for b in _bins(home, state, file_bytes, file_rows)]
        packed.append(bins)
    replaced = 0
    for bins in _groups(packed):
        chosen = [f for b in bins for f in b]
        replaced += len(chosen)
        if table == SILVER_LOG:
            _merge_log(lake, state, chosen)
            continue
        number = lake.spark.createDataFrame([(f.path, n) for n, b in enumerate(bins) for f in b], "_file string, bin int")
        rows = lake.scan(table, state, chosen, place=True).join(number, "_file")
        if batched:
            rows = rows.withColumn("batch", F.concat(F.lit(f"merged-{uuid.uuid4().hex}-"), "bin"))
        lake.exchange(table, chosen, rows.repartitionById(len(bins), F.col("bin")), gather=False, name="compact")
    return replaced


def _groups(packed: list[list[list[File]]]) -> Iterator[list[list[File]]]:
    """Bins of whole days until a group has its bytes."""
    group: list[list[File]] = []
    for bins in packed:
        group += bins
        if sum(f.bytes for b in group for f in b) >= GROUP_BYTES:
            yield group
            group = []
    if group:
        yield group


def _newest_batches(state: State) -> set[str]:
    """The last batch of each query, by the numbers in their names."""
    last: dict[str, str] = {}
    for folder in state.folders:
        batch = folder.split("/")[1].removeprefix("batch=")
        query, _, number = batch.rpartition("-")
        if number.isdigit() and len(number) == 10:
            last[query] = max(last.get(query, ""), batch)
    return set(last.values())


def _homes(files: list[File], batched: bool) -> list[list[File]]:
    """Files that may share one: of a partition, whatever batch they came with."""
    homes: dict[str, list[File]] = {}
    for f in files:
        homes.setdefault(f.folder.split("/")[0] if batched else f.folder, []).append(f)
    return list(homes.values())


def _bins(files: list[File], state: State, file_bytes: int, file_rows: int) -> list[list[File]]:
    """Small and marked files packed first-fit, the largest first; a bin of one whole file is left out."""

    def small(f: File) -> bool:
        return 2 * f.bytes < file_bytes and 2 * f.rows < file_rows

    some = sorted((f for f in files if small(f) or f.path in state.deleted), key=lambda f: (-f.bytes, f.path))
    bins: list[list[File]] = []
    room: list[tuple[int, int]] = []
    for f in some:
        at = next((i for i, (size, rows) in enumerate(room) if f.bytes <= size and f.rows <= rows), None)
        if at is None:
            bins.append([f])
            room.append((file_bytes - f.bytes, file_rows - f.rows))
        else:
            bins[at].append(f)
            room[at] = (room[at][0] - f.bytes, room[at][1] - f.rows)
    return [b for b in bins if len(b) > 1 or b[0].path in state.deleted]


def _merge_log(lake: Lake, state: State, files: list[File]) -> None:
    """The latest version of every event of these files of the log; the others are noted by their place in bronze."""
    order = Window.partitionBy(*SILVER_KEY).orderBy(*[F.desc(c) for c in SILVER_NEWEST])
    name = f"merged-{uuid.uuid4().hex}"
    rows = lake.scan(SILVER_LOG, state, files).withColumn("batch", F.lit(name))
    older = rows.withColumn("version", F.row_number().over(order)).where("version > 1")
    with _read_by_rows(lake, files):
        # Noted first: a place noted twice does no harm, a delivery that cannot be found does.
        lake.replace(SUPERSEDED, older.select(*SUPERSEDED.stored.fieldNames()))
        lake.exchange(SILVER_LOG, files, merge.keep_latest(rows), name="compact")


@contextmanager
def _read_by_rows(lake: Lake, files: list[File]) -> Iterator[None]:
    """Jobs that read these files take about ``TASK_ROWS`` of them per task: the first step of ``keep_latest`` sorts what a task reads."""
    rows, conf = sum(f.rows for f in files), lake.spark.conf
    share = sum(f.bytes for f in files) * TASK_ROWS // max(rows, 1)
    changed = {SPLIT: min(max(share, 1 << 20), 128 << 20), OPEN_COST: 1 << 20}
    before = {key: conf.get(key) for key in changed}
    for key, value in changed.items():
        conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            conf.set(key, value)


def clean(lake: Lake, tables: Iterable[Table], before: dt.datetime) -> int:
    """Delete files that no longer count since before a moment; older than every running reader and writer."""
    return sum(lake.log(table).clean(int(before.timestamp() * 1000)) for table in tables)


def resorted(df: DataFrame, path: str, sort_key: list[str], partition: str) -> None:
    """Write a copy with another sort key, for queries that look up by other columns."""
    (
        df.hint("rebalance", F.col(partition))
        .sortWithinPartitions(partition, *sort_key)
        .write.mode("overwrite")
        .partitionBy(partition)
        .parquet(path)
    )


def snapshot(lake: Lake, folder: str, at: dt.datetime) -> str:
    """Copy silver to a folder named after the time; returns its path."""
    path = f"{folder.rstrip('/')}/silver_{at:%Y%m%d_%H%M%S}"
    lake.read(SILVER).write.mode("errorifexists").partitionBy("event_date").parquet(path)
    return path


# Storage reports


def table_sizes(lake: Lake, tables: list[Table]) -> DataFrame:
    """Rows, files and bytes per table, as their commit logs have them; no data file is opened."""
    rows = []
    for table in tables:
        state = lake.log(table).state()
        files = state.files()
        rows.append((table.name, sum(f.rows for f in files) - sum(state.deleted.values()), len(files), sum(f.bytes for f in files)))
    sizes = lake.spark.createDataFrame(rows, "table string, total_rows bigint, files bigint, bytes bigint")
    return sizes.withColumn("size", readable_size(F.col("bytes"))).orderBy(F.desc("bytes"), "table")


def partition_counts(lake: Lake, tables: list[Table]) -> DataFrame:
    """Number of partitions per table in the unit the lake keeps it by; batches are no partitions of their own."""
    rows = []
    for table in tables:
        depth = len([c for c in lake.layout(table).partition_names if c != "batch"])
        folders = {"/".join(f.split("/")[:depth]) for f in lake.log(table).state().folders}
        rows.append((table.name, len(folders)))
    return lake.spark.createDataFrame(rows, "table string, partitions bigint")


def out_of_order(lake: Lake, table: Table, rows: int = 256) -> DataFrame:
    """Per partition: stretches of a file's rows whose sort key begins before that of the stretch before them ends.

    Stretches are aggregated first, so what is put in order is a row per stretch, not per row.
    """
    state = lake.log(table).state()
    layout = lake.layout(table)
    key = F.struct(*layout.sort_key)
    placed = lake.scan(table, state, state.files(), place=True)
    parts = [*layout.partition_names, PLACE[0]]
    stretches = placed.groupBy(*parts, F.expr(f"{PLACE[1]} div {rows}").alias("stretch")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    before = F.lag("high").over(Window.partitionBy(*parts).orderBy("stretch"))
    return stretches.withColumn("before", before).groupBy(*layout.partition_names).agg(
        F.count_if(F.col("before") > F.col("low")).alias("out_of_order")
    )


def file_bounds(lake: Lake, table: Table) -> DataFrame:
    """One row per file: its partition, rows, bytes and the bounds of its sort columns."""
    columns = [c for c in lake.layout(table).sort_key if c in table.columns.fieldNames()]
    kinds = {f.name: f.dataType.simpleString() for f in table.columns.fields}
    rows = [
        (f.folder, f.rows, f.bytes, *[None if v is None else str(v) for c in columns for v in f.bounds.get(c, (None, None))])
        for f in lake.log(table).state().files()
    ]
    names = [f"{end}_{c}" for c in columns for end in ("low", "high")]
    texts = lake.spark.createDataFrame(rows, ", ".join(["folder string, rows bigint, bytes bigint", *[f"{n} string" for n in names]]))
    return texts.withColumns({f"{end}_{c}": F.col(f"{end}_{c}").cast(kinds[c]) for c in columns for end in ("low", "high")})
