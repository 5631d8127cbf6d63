"""Stored tables: partitioned Parquet files under one root, and a commit log for each table that says which files count."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelake.schema import BY_DAY, BY_HOUR, SILVER_LOG, USER_TITLES, Table
from ripplelake.session import use_utc
from ripplelake.sources.commits import Change, CommitLog, Conflict, File, State

#: Folder beside the tables with the moments before which their rows have expired.
LIMITS = "limits"

#: Where a row stands: its file as the log names it, and its number in there.
PLACE = ("_file", "_row")


def _place() -> list:
    return [F.substring_index("_metadata.file_path", "/data/", -1).alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1])]


def _plain(value):
    """A bound as the log stores it: JSON types that compare as the values do."""
    if isinstance(value, dt.datetime):
        return value.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
    return value.isoformat() if isinstance(value, dt.date) else value


class Lake:
    """Reads and writes the tables.

    Every write replaces whole partitions in one commit, so repeating a failed write leaves no trace of the first try and a reader
    never sees half of a write.  Silver and the hourly gold tables are refreshed partition by partition.  ``grain`` sets their size:
    ``hour`` for streams whose hours fill many files, ``day`` for small streams, whose hours would be tiny files.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str = "hour"):
        if grain not in ("hour", "day"):
            raise ValueError(f"unknown grain {grain!r}")
        self.spark, self.root, self.grain = use_utc(spark), root.rstrip("/"), grain
        self._logs: dict[str, CommitLog] = {}
        self._lock = threading.Lock()

    def log(self, table: Table) -> CommitLog:
        with self._lock:
            if table.name not in self._logs:
                self._logs[table.name] = CommitLog(self.spark, self.path(table))
            return self._logs[table.name]

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def layout(self, table: Table) -> Table:
        """The table as this lake partitions it."""
        by_day = self.grain == "day" and table.partitions == BY_HOUR
        return replace(table, partitions=BY_DAY) if by_day else table

    def refresh_folder(self, row: Row) -> str:
        """Folder of the refreshed tables that holds an hour."""
        day = day_folder(row["event_date"])
        return day if self.grain == "day" else f"{day}/event_hour={row['event_hour']}"

    def _folder(self, relative: str, action):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}")
        return action(path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path)

    # Reading

    def read(self, table: Table, state: State | None = None) -> DataFrame:
        """The newest version, or that of ``state``; later commits do not change what the DataFrame reads."""
        state = state or self.log(table).state()
        return self.scan(table, state, state.files())

    def read_partitions(self, table: Table, partitions: Iterable[str]) -> DataFrame:
        """Only these partitions, or all below them; no other file is looked at."""
        state = self.log(table).state()
        return self.scan(table, state, state.files(self.below(state, partitions)))

    def read_range(self, table: Table, column: str, low=None, high=None) -> DataFrame:
        """Rows with ``column`` from low to high, both included.  Files whose bounds lie outside are not opened."""
        state = self.log(table).state()
        within = [f for f in state.files() if f.may_hold(column, _plain(low), _plain(high))]
        rows = self.scan(table, state, within)
        for bound, keep in ((low, F.col(column).__ge__), (high, F.col(column).__le__)):
            rows = rows if bound is None else rows.where(keep(F.lit(bound)))
        return rows

    def peek(self, table: Table, n: int = 5) -> DataFrame:
        """The ``n`` rows that are first by partition and offset.

        Bounds of the files say which can hold them: of the first partition those with the lowest offsets, up to the offset at which the next file
        begins; more only where these hold too few.  Neither the table nor a partition of it is sorted.
        """
        state, found = self.log(table).state(), []
        files = state.files()
        spans = {f.path: f.bounds.get("kafka_partition", (0, 0)) for f in files}
        wanted, missing = min((s[0] for s in spans.values()), default=0), n
        while missing > 0 and wanted <= max((s[1] for s in spans.values()), default=-1):
            able = sorted((f for f in files if f.may_hold("kafka_partition", wanted, wanted)), key=lambda f: f.bounds["kafka_offset"][0])
            take = 1
            while able:
                while take < len(able) and sum(f.rows for f in able[:take]) < missing:
                    take += 1
                rows = self.scan(table, state, able[:take]).where(F.col("kafka_partition") == wanted)
                if take < len(able):
                    rows = rows.where(F.col("kafka_offset") < able[take].bounds["kafka_offset"][0])
                rows = rows.orderBy("kafka_offset").limit(missing)
                count = rows.count()
                if count == missing or take == len(able):
                    found.append(rows)
                    missing -= count
                    break
                take = min(2 * take, len(able))
            wanted += 1
        return reduce(DataFrame.unionByName, found) if found else self.scan(table, state, [])

    def scan(self, table: Table, state: State, files: list[File], place: bool = False) -> DataFrame:
        """Rows of these files that are not deleted, with their place on demand."""
        layout, log = self.layout(table), self.log(table)
        names = [*layout.stored.fieldNames(), *(PLACE if place else ())]

        def rows(some: list[File], placed: bool) -> DataFrame:
            # The folder of a write stands above its partitions; it is read as a column and left out.
            schema = T.StructType([*layout.stored.fields, T.StructField("w", T.StringType())])
            reader = self.spark.read.schema(schema)
            if some:
                df = reader.option("basePath", f"{log.root}/data").parquet(*[f"{log.root}/data/{unquote(f.path)}" for f in some])
            else:
                df = reader.parquet(f"{log.root}/none")
            return df.select(*layout.stored.fieldNames(), *(_place() if placed else ()))

        marked = [f for f in files if f.path in state.deleted]
        if not marked:
            return rows(files, place)
        # Bitmaps of 32,768 rows each, met by the rows of the marked files only.
        paths = [f"{log.root}/marks/{name}" for name in sorted(state.marks) if any(f.path in state.marks[name] for f in marked)]
        gone = self.spark.read.parquet(*paths).groupBy("file", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        met = rows(marked, True).join(
            gone, (F.col(PLACE[0]) == F.col("file")) & (F.bitmap_bucket_number(F.col(PLACE[1]) + 1) == F.col("bucket")), "left"
        )
        at = F.bitmap_bit_position(F.col(PLACE[1]) + 1)
        byte = F.conv(F.hex(F.substring("bits", F.expr("CAST(bitmap_bit_position(_row + 1) div 8 AS INT) + 1"), F.lit(1))), 16, 10)
        kept = met.where(F.col("bits").isNull() | (_bit(byte.cast("int"), at) == 0)).select(*names)
        clean = [f for f in files if f.path not in state.deleted]
        return rows(clean, place).unionByName(kept) if clean else kept

    @staticmethod
    def below(state: State, partitions: Iterable[str]) -> list[str]:
        """Partitions of the log that are one of these or lie below one."""
        wanted = set(partitions)
        return [f for f in state.folders if any("/".join(f.split("/")[:n]) in wanted for n in range(1, f.count("/") + 2))]

    def partitions(self, table: Table, below: str = "") -> list[str]:
        """Names of the partition folders one level below ``below``."""
        top = f"{below.rstrip('/')}/" if below else ""
        folders = self.log(table).state().folders
        return sorted({f.removeprefix(top).split("/")[0] for f in folders if f.startswith(top)})

    # Expiry

    def expire_below(self, table: Table, limit: dt.datetime) -> None:
        """Remember that rows before ``limit`` are gone.  An empty folder per limit: no data file, no lock."""
        self._folder(f"{LIMITS}/{table.name}/below={int(limit.timestamp())}", lambda fs, path: fs.mkdirs(path))

    def floor(self, table: Table) -> dt.datetime:
        """Rows before this moment have expired."""
        seconds = 0
        try:
            found = self._folder(f"{LIMITS}/{table.name}", lambda fs, path: fs.listStatus(path))
        except Py4JJavaError as e:
            if "FileNotFoundException" not in str(e.java_exception):
                raise
            found = []
        for f in found:
            seconds = max(seconds, int(f.getPath().getName().split("=")[1]))
        return dt.datetime.fromtimestamp(seconds, dt.timezone.utc)

    def whole_days_from(self) -> dt.datetime:
        """Start of the first day whose log and partial rows are complete."""
        floor = max(self.floor(SILVER_LOG), self.floor(USER_TITLES))
        day = floor.replace(hour=0, minute=0, second=0, microsecond=0)
        return day if day == floor else day + dt.timedelta(days=1)

    def unexpired(self, table: Table, df: DataFrame) -> DataFrame:
        """Without rows that the table has given up."""
        return df.where(F.col(table.age_column) >= F.lit(self.floor(table)))

    # Writing

    def write(self, table: Table, df: DataFrame, gather: bool = True) -> tuple[File, ...]:
        """Write files that count once they are committed.

        Gathering shuffles the rows of a partition together; the adaptive planner then splits large ones over
        many tasks and merges small ones, so neither a hot hour nor thousands of quiet ones is a problem.  Rows
        that go to very few partitions need no gathering: every task writes a file of its own.
        """
        layout, log = self.layout(table), self.log(table)
        parts = layout.partition_names
        if gather:
            df = df.hint("rebalance", *[F.col(c) for c in parts])
        folder = f"{log.root}/data/w={uuid.uuid4().hex}"
        (
            df.sortWithinPartitions(*parts, *layout.sort_key)
            .select(*layout.stored.fieldNames())
            .write.partitionBy(*parts)
            .parquet(folder)
        )
        return self._files(layout, log, folder)

    def _files(self, layout: Table, log: CommitLog, folder: str) -> tuple[File, ...]:
        """What a write has left, with bounds of its sort columns; reads these columns only."""
        columns = [c for c in layout.sort_key if c in layout.columns.fieldNames()]
        rows = self.spark.read.schema(layout.stored).parquet(folder)
        found = rows.groupBy(
            F.substring_index("_metadata.file_path", "/data/", -1).alias("path"), F.col("_metadata.file_size").alias("bytes")
        ).agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))])
        return tuple(
            File(r["path"], r["n"], r["bytes"], {c: [_plain(r[f"low_{c}"]), _plain(r[f"high_{c}"])] for c in columns})
            for r in found.collect()  # a row per file written
        )

    def replace(self, table: Table, df: DataFrame, gather: bool = True) -> None:
        """Put ``df`` in place of the partitions it has rows for."""
        files = self.write(table, df, gather)
        folders = {f.folder for f in files}
        self.log(table).commit(
            lambda state: Change(files, tuple(f.path for f in state.files(folders)), name="replace")
        )

    def exchange(self, table: Table, files: Iterable[File], df: DataFrame, gather: bool = True, name: str = "exchange") -> None:
        """Put ``df`` in place of these files.  Where another writer has touched one of them meanwhile, nothing changes and it is told so."""
        files, seen = list(files), self.log(table).state()
        written = self.write(table, df, gather)

        def swap(state: State) -> Change:
            if any(state.deleted.get(f.path, 0) != seen.deleted.get(f.path, 0) for f in files):
                raise Conflict(f"{table.name}: rows were deleted meanwhile")
            return Change(written, tuple(f.path for f in files), name=name)

        self.log(table).commit(swap)

    def delete(
        self, table: Table, matching: Callable[[DataFrame], DataFrame], only: Callable[[File], bool] = lambda f: True, tries: int = 3
    ) -> int:
        """Mark the rows that ``matching`` keeps as deleted; returns how many.

        Their places become bitmaps beside the files, which readers apply and compaction folds in.  ``only`` says in which files they can be.
        """
        log = self.log(table)
        while True:
            state, name = log.state(), uuid.uuid4().hex
            files = [f for f in state.files() if only(f)]
            if not files:
                return 0
            found = matching(self.scan(table, state, files, place=True)).select(*PLACE)
            bits = found.groupBy(
                F.col(PLACE[0]).alias("file"), F.bitmap_bucket_number(F.col(PLACE[1]) + 1).alias("bucket")
            ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(PLACE[1]) + 1)).alias("bits"))
            bits.write.parquet(f"{log.root}/marks/{name}")
            counts = self.spark.read.parquet(f"{log.root}/marks/{name}").groupBy("file").agg(F.sum(F.bitmap_count("bits")).alias("n"))
            marked = {r["file"]: r["n"] for r in counts.collect()}  # a row per file touched
            if not marked:
                return 0

            def mark(now: State) -> Change:
                if any(now.deleted.get(p, 0) != state.deleted.get(p, 0) for p in marked):
                    raise Conflict(f"{table.name}: rows were deleted meanwhile")
                return Change(marks=name, marked=marked, name="delete")

            try:
                log.commit(mark)
                return sum(marked.values())
            except Conflict:
                tries -= 1
                if not tries:
                    raise

    def drop(self, table: Table, partitions: Iterable[str]) -> None:
        partitions = list(partitions)
        self.log(table).commit(
            lambda state: Change(remove=tuple(f.path for f in state.files(self.below(state, partitions))), name="drop")
        )

    def truncate(self, table: Table) -> None:
        self.log(table).commit(lambda state: Change(remove=tuple(state.where), name="truncate"))


def _bit(byte: Column, position: Column) -> Column:
    """The bit of a byte that belongs to a position."""
    return F.call_function("shiftright", byte, (position % 8).cast("int")) % 2


def day_folder(day) -> str:
    return f"event_date={day}"


def with_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"event_date": F.to_date(ts), "event_hour": F.hour(ts)})


def with_day(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("event_date", F.to_date(day))


def with_ingest(df: DataFrame, batch: str) -> DataFrame:
    return df.withColumns({"ingest_date": F.to_date("ingested_at"), "batch": F.lit(batch)})

