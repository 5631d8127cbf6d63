"""Shards of nearly equal size: a minimax partition of ordered, atomic groups.

Equal texts form one group, which is never split.  Groups are ordered by the digest of their text; shards are
contiguous ranges of that order.  The smallest feasible capacity is found by binary search: a capacity is feasible
if filling one shard after the other, each as far as it goes, needs no more shards than there are.

The driver never sees the groups, only sums over ranges of digests: at first of 65,536 ranges, and where a cut may lie within a range, of the 256
ranges of its next two digits, until every cut lies between two ranges.  What it holds grows with the shards and the logarithm of the groups.

Nulls: a null text counts as an empty one.  An empty table gives no row.  Repeated rows are rows of the same group.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import stored, text_of

#: Digits that name a range at first, and digits that a refinement adds.
DIGITS, MORE = 4, 2
#: Ranges a shard that may be refined in one job.
AT_ONCE = 64


class Sizes:
    """Sums over consecutive ranges of the ordered groups.  A range is all groups whose digests begin with its name."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        self.ranges: list[tuple[str, int, int]] = []  # name, sum of sizes, number of groups
        self.largest = groups.agg(F.max("size")).first()[0] or 0
        self._add(F.substring("digest", 1, DIGITS))

    def _add(self, name: Column) -> None:
        named = self.groups.withColumn("name", name).where("name is not null")
        found = named.groupBy("name").agg(F.sum("size").alias("total"), F.count("*").alias("n")).collect()
        self.ranges = sorted([*self.ranges, *map(tuple, found)])
        self.before = [0, *accumulate(total for _, total, _ in self.ranges)]

    def refine(self, which: set[int]) -> None:
        """Puts the ranges of the next digits in the place of these, in one job."""
        names: dict[int, list[str]] = {}
        for r in which:
            names.setdefault(len(self.ranges[r][0]), []).append(self.ranges[r][0])
        self.ranges = [x for r, x in enumerate(self.ranges) if r not in which]
        self._add(F.coalesce(*[
            F.when(F.substring("digest", 1, n).isin(some), F.substring("digest", 1, n + MORE)) for n, some in names.items()
        ]))

    def at(self, prefix: int) -> int:
        """The range in which this prefix sum lies, or which begins there."""
        return bisect_right(self.before, prefix) - 1

    def several(self, ranges) -> set[int]:
        """Those of the ranges that can be refined."""
        return {r for r in ranges if r < len(self.ranges) and self.ranges[r][2] > 1}

    def ends(self, capacity: int, shards: int, whole: bool) -> list[int]:
        """Where each shard ends, filled one after the other as far as the capacity allows.

        A range of several groups goes into a shard whole, or else is cut at any byte: the ends that whole groups give lie between the two.
        """
        out, at, total = [], 0, self.before[-1]
        for _ in range(shards):
            at = min(at + capacity, total)
            r = self.at(at)
            if whole or not self.several([r]):
                at = self.before[r]
            out.append(at)
            if at == total:
                break
        return out


def minimax(sizes: Sizes, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the ends it gives.

    A capacity that is feasible with whole ranges is feasible; one that is not even with ranges cut anywhere is not.  Binary search finds
    the borders of both; while they differ, the ranges in which a cut may lie are refined.
    """
    total = sizes.before[-1]
    low, high = max(sizes.largest, -(-total // shards)), total

    def least(whole: bool) -> int:
        span = range(low, high)
        return low + bisect_left(span, True, key=lambda c: sizes.ends(c, shards, whole)[-1] == total)

    while True:
        low = least(whole=False)
        high = least(whole=True)
        first, last = sizes.ends(low, shards, whole=True), sizes.ends(low, shards, whole=False)
        if first == last:
            return low, first
        furthest = sizes.ends(high, shards, whole=False)
        unsure: set[int] = set()
        for a, b in zip(first, furthest):
            unsure |= sizes.several(range(sizes.at(a), sizes.at(b) + 1))
        if len(unsure) > AT_ONCE * shards:  # a few huge groups decide: only where cuts lie now, of which one at least is refined
            unsure = sizes.several(map(sizes.at, [*first, *last, *furthest]))
        sizes.refine(unsure)


def assign(docs: DataFrame, shards: int = 8, partitions: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    text = text_of()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )
    rows = stored(rows, "sizes")
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("size")), "groups")
    sizes = Sizes(groups)
    ends = minimax(sizes, shards)[1]
    shard = F.lit(0)
    for end in ends[:-1]:  # the next shard begins with the range that begins here
        shard = shard + (F.col("digest") >= sizes.ranges[sizes.at(end)][0]).cast("int")
    # Slots: rows in range order get their place from the partition's offset, so no window holds a whole shard.
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        rows.withColumn("shard", shard)
        .repartitionByRange(n, "shard", "digest", "doc_id")
        .sortWithinPartitions("shard", "digest", "doc_id")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    placed = stored(placed, "placed")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()
    offsets, seen = {}, dict.fromkeys(range(shards), 0)
    for row in sorted(counts, key=lambda row: (row.part, row.shard)):
        offsets[row.shard, row.part] = seen[row.shard] - row.first
        seen[row.shard] += row.n
    offset = docs.sparkSession.createDataFrame(  # a row per partition and shard at most
        [(s, p, o) for (s, p), o in offsets.items()], "shard int, part long, offset long"
    )
    return placed.join(F.broadcast(offset), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.col("offset")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
