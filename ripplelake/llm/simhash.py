"""SimHash near duplicates by the generalised pigeonhole principle.

Fingerprints are linked at ``most`` or fewer differing bits.  The 64 bits are dealt into partitions, bits that vary together into the
same one.  If two fingerprints differ in at most ``most`` bits and the thresholds ``t_i`` of m partitions add up to
``most - m + 1``, then at least one partition differs in at most ``t_i`` bits.  Thresholds may differ, and -1 skips a
partition; dynamic programming picks those with the fewest estimated candidates.  One side probes every value within the
threshold, candidates are verified on the whole fingerprint.

Equal fingerprints collapse before the search.  A probe value that very many fingerprints share is refined instead of paired out: its members
are dealt again by the next partition of the remaining bits (they still differ in ``most`` bits at most), and what stays
large is compared in blocks.  A task returns a spanning forest of the links it finds, so output grows with the fingerprints, not with pairs.

Nulls: a null text counts as an empty one; a text without a word has the fingerprint zero and links like any other.  An
empty table gives no row.  Repeated rows share their class.  The other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import components, spare_name, stored

BITS, SEED = 64, 42
#: Fingerprints of one probe value that a task compares at once; larger sets are refined, then cut into blocks.
BLOCK = 1024


def fingerprint_bits(text: str | None, width: int = 3) -> int:
    import xxhash

    words = (text or "").encode().lower().split()  # of bytes: A-Z only, ASCII separators only
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, h, fp``: the hash of the text, and the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint_bits(t, width) for t in batch], dtype="int64")

    return docs.select("doc_id", F.xxhash64("text").alias("h"), of(F.col("text")).alias("fp"))


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often bits i and j are both set: one 64 x 64 sum per partition."""

    def sums(batches):
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            bits = np.unpackbits(batch["fp"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.T.astype(np.float32) @ bits.astype(np.float32)
            n += len(batch)
        if n:
            yield pd.DataFrame({"n": [n], "both": [total.ravel().tolist()]})

    found = distinct.select("fp").mapInPandas(sums, "n long, both array<double>")
    added = found.select("n", F.posexplode("both")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum("col").alias("v"))
    rows = added.collect()  # 4,096 sums
    both = np.zeros(BITS * BITS)
    for r in rows:
        both[r.pos] = r.v
    return (rows[0].n if rows else 0), both.reshape(BITS, BITS)


def deal_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits that are most correlated go into the same partition; sizes differ by one at most."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tied = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, out = list(range(BITS)), []
    for k in range(parts):
        room = (BITS - sum(map(len, out))) // (parts - k)
        group = [max(left, key=lambda b: (tied[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < room:
            best = max(left, key=lambda b: (tied[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def estimate(n: int, both: np.ndarray, group: list[int], threshold: int) -> float:
    """Rows to probe and candidates to expect for one partition, bits taken as independent."""
    if threshold < 0:
        return 0.0
    p = np.diag(both)[group] / max(n, 1)
    same = p * p + (1 - p) * (1 - p)
    chance = np.zeros(threshold + 1)
    chance[0] = 1.0
    for s in same:
        chance[1:] = chance[1:] * s + chance[:-1] * (1 - s)
        chance[0] *= s
    probes = sum(len(list(combinations(group, d))) for d in range(threshold + 1))
    return n * probes + n * n * chance.sum() / 2


def allocate(n: int, both: np.ndarray, groups: list[list[int]], most: int) -> tuple[float, list[int]]:
    """Thresholds from -1 upwards that add up to ``most - m + 1`` at the least cost: a knapsack by dynamic programming."""
    best = {0: (0.0, [])}  # sum of (t_i + 1) -> cost and thresholds
    for group in groups:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, most + 1 - used):
                now = cost + estimate(n, both, group, t), [*chosen, t]
                if used + t + 1 not in grown or now < grown[used + t + 1]:
                    grown[used + t + 1] = now
        best = grown
    return best[most + 1]


def _signed(bits) -> int:
    """These bits as a signed long."""
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _masked(fp: Column, bits: list[int]) -> Column:
    return fp.bitwiseAND(F.lit(_signed(bits)))


def _forest(fps: np.ndarray, ends: np.ndarray, most: int) -> pd.DataFrame:
    """Compares the members of sets that lie one after the other and returns the links that join them: a spanning forest.

    ``ends[i]`` is where the set of member i ends.  All sets are compared at once: each member with its next one, then with the
    one after that, and so on; members drop out where their set ends.  ``root`` is flat before each step, so a step looks one by one only
    at links between members that no earlier step has joined.
    """
    root = np.arange(len(fps))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    a, b = [], []
    at, apart = np.arange(len(fps)), 0
    while len(at):
        apart += 1
        at = at[at + apart < ends[at]]
        near = at[np.bitwise_count((fps[at] ^ fps[at + apart]).view(np.uint64)) <= most]
        near = near[root[near] != root[near + apart]]
        for i in near.tolist():
            x, y = find(i), find(i + apart)
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(fps[i])
                b.append(fps[i + apart])
        while len(near) and (root[root] != root).any():
            root = root[root]
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _sets(key: list[str], most: int):
    """Cuts rows sorted by the key into whole sets.  A batch may end within a set, which is then carried over; a set has two blocks at most."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = None
        for batch in batches:
            rows = batch if carried is None else pd.concat([carried, batch], ignore_index=True)
            names = rows[key].to_numpy()
            starts = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]).any(1)])
            last = starts[-1]
            carried = rows.iloc[last:]
            yield _forest(rows["fp"].to_numpy()[:last], np.repeat(starts[1:], np.diff(starts)), most)
        if carried is not None:
            yield _forest(carried["fp"].to_numpy(), np.full(len(carried), len(carried)), most)

    return compare


#: Microseconds of comparing that a task should have.
TASK = 5_000_000


def _cost(n: Column) -> Column:
    """Microseconds that the comparisons within a set of n rows take."""
    return 5 * n + n * n / 100


def _compared(rows: DataFrame, key: list[str], cost: DataFrame, most: int) -> DataFrame:
    """The links within each set, the sets dealt over as many tasks as their comparisons need (``cost``: one sum, in microseconds).

    Bytes say nothing here: a set of n rows takes n * n comparisons, so the planner must not merge these partitions by size.
    """
    tasks = min(1 + int(cost.first()[0] or 0) // TASK, 100_000)
    dealt = rows.repartition(tasks, *key).sortWithinPartitions(*key).select("fp", *key)
    return dealt.mapInPandas(_sets(key, most), "a long, b long")


def links(distinct: DataFrame, most: int = 2, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints whose components are those of all links."""
    n, both = bit_statistics(distinct)
    plans = [(*allocate(n, both, groups, most), groups) for groups in (deal_bits(n, both, m) for m in range(1, most + 3))]
    _, thresholds, groups = min(plans, key=lambda p: p[0])
    members = None
    for group, t in zip(groups, thresholds):
        if t < 0:
            continue
        value = _masked(F.col("fp"), group)
        # Each fingerprint stands under every value within half the way: for t = 0 its own; otherwise its own and all
        # those within t bits, so that two within t bits meet under the value of either.
        flips = [_signed(c) for d in range(t + 1) for c in combinations(group, d)]
        key = F.explode(F.array(*[value.bitwiseXOR(F.lit(f)) for f in flips])) if t else value
        rows = distinct.select("fp", F.lit(_signed(group)).alias("mask"), key.alias("value"))
        members = rows if members is None else members.union(rows)
    members = stored(members, "members")
    out = None
    # The bits that are not yet fixed are dealt into most + 1 parts, one of which must agree.
    for _ in range(4):
        sizes = members.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        sizes = stored(sizes, "sizes")
        cost = sizes.where(F.col("n") <= block).agg(F.sum(_cost(F.col("n"))))
        small = members.join(sizes.where(F.col("n") <= block), ["mask", "value"])
        found = _compared(small, ["mask", "value"], cost, most)
        out = found if out is None else out.union(found)
        large = sizes.where(F.col("n") > block).select("mask", "value")
        if large.isEmpty():
            return out
        members = stored(members.join(large, ["mask", "value"]), "members")
        masks = [r.mask for r in members.select("mask").distinct().collect()]  # few: partitions refined so far
        finer = None
        for mask in masks:
            free = [b for b in range(BITS) if not (mask >> b) & 1]
            if len(free) <= most:
                continue
            for k in range(most + 1):
                part = free[k :: most + 1]
                wider = _signed([b for b in range(BITS) if (mask >> b) & 1] + part)
                rows = members.where(F.col("mask") == mask).select(
                    "fp", F.lit(wider).alias("mask"), F.col("value").bitwiseOR(_masked(F.col("fp"), part)).alias("value")
                )
                finer = rows if finer is None else finer.union(rows)
        members = stored(finer, "members")
    # What is still large: all pairs of blocks, each pair its own task.
    sizes = stored(members.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    paired = (
        members.join(sizes, ["mask", "value"])
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("fp", "mask", "value", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    )
    cost = sizes.agg(F.sum(blocks * (blocks + 1) / 2 * _cost(F.lit(2 * block))))
    return out.union(_compared(paired, ["mask", "value", "lo", "hi"], cost, most))


def _named(prints: DataFrame, most: int) -> DataFrame:
    """``fp, doc_id, h, root``: the first row of each distinct fingerprint (no doc_id comes last) and its class."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "h")).alias("first")
    distinct = stored(prints.groupBy("fp").agg(first).select("fp", "first.doc_id", "first.h"), "distinct")
    roots = stored(components(stored(links(distinct, most), "links")), "roots")
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return joined.select("fp", "doc_id", "h", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, width: int = 3, most: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest doc_id that links lead to."""
    prints = stored(fingerprints(docs, width), "fingerprints")
    named = stored(_named(prints, most), "roots-of-prints")
    least = stored(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "classes")
    named = stored(named.join(least, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def report(docs: DataFrame, width: int = 3, most: int = 2) -> DataFrame:
    return classes(docs, width, most).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, width: int = 3, most: int = 2) -> DataFrame:
    """The row that represents its class, for each class, columns as they were: the smallest doc_id, then fingerprint, then hash of the text.

    A row without a doc_id stays only where a class has no other row.  Of rows with the same doc_id and the same text one stays.
    """
    prints = stored(fingerprints(docs, width), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "fp", "h")
    first = _named(prints, most).groupBy("root").agg(F.min(order).alias("first"))
    name, h = spare_name(docs, "kept_id"), spare_name(docs, "kept_h")
    kept = stored(first.select(F.col("first.doc_id").alias(name), F.col("first.h").alias(h)), "kept")
    twice = prints.groupBy("doc_id", "h").agg(F.count("*").alias("n")).where("n > 1").toDF("id", "text_h", "n")
    repeated = not kept.join(twice, F.col(name).eqNullSafe(F.col("id")) & (F.col(h) == F.col("text_h")), "left_semi").isEmpty()
    out = docs.join(kept, F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64("text") == F.col(h)), "left_semi")
    return out.withColumn(h, F.xxhash64("text")).dropDuplicates(["doc_id", h]).drop(h) if repeated else out
