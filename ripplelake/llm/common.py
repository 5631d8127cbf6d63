"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ripplelake.session import scratch

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: cuts lineage, survives lost executors.

    Once they are written nothing needs the shuffle files of the job any more, so Spark deletes them at its end.
    """
    spark = df.sparkSession
    path = scratch(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` has made, once all that is made of it is stored itself."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def text_of(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def spare_name(df: DataFrame, wanted: str) -> str:
    """A column name near the wanted one that the table does not use yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


#: Offsets of that many sorted runs are sent to every task; more are joined like any table.
SENT_OFFSETS = 1_000_000


def numbered(df: DataFrame, group: str, order: list[str], position: str, total: str, spread: bool = True) -> DataFrame:
    """Dense positions from 0 within each group, and the size of the group, without a window over its rows.

    ``group`` must not be null.  With ``spread`` the rows are dealt by ranges of (group, order), so a group of any size is shared by many
    tasks and positions follow ``order``; without, rows stay where they are, and positions follow the order only within a
    partition.  The sorted rows are stored with their partition and place, so all later steps see the same order.  What a
    partition holds of a group is one run; the offsets are a row per run, as many as partitions and groups together at most where spread.
    """
    at, part, n = "_at", "_part", "_n"
    dealt = df.repartitionByRange(group, *order) if spread else df
    placed = dealt.sortWithinPartitions(group, *order).withColumn(at, F.monotonically_increasing_id())
    placed = stored(placed.withColumn(part, F.shiftright(at, 33)), "placed")
    runs = placed.groupBy(group, part).agg(F.count("*").alias(n), F.min(at).alias("_first"))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, part, (F.coalesce(F.sum(n).over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum(n).over(Window.partitionBy(group)).alias(total),
    )
    runs = stored(runs, "runs")
    runs = F.broadcast(runs) if runs.count() <= SENT_OFFSETS else runs
    return placed.join(runs, [group, part]).withColumn(position, F.col(at) + F.col("_shift")).drop(at, part, "_shift")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of edges ``(a, b)``: rows ``(node, root)``, root being the smallest node reachable.

    Alternating large-star and small-star steps until nothing changes; each round's edges are written to
    the shared folder.  A node with very many neighbours is an aggregate joined to a stored table, so
    the adaptive planner may split it.  Nodes without an edge do not appear.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "edges",
    )
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")), "least")
        large = (  # every larger neighbour to the smallest of the neighbourhood
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .union(least.where("m < a").select("a", F.col("m").alias("b")))
            .distinct()
        )
        large = stored(large, "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle within {most_rounds} rounds")
