"""How far the sources of a language diverge in the words they use: triangular discrimination of smoothed term frequencies.

Terms are runs of letters and of characters beyond ASCII, with A to Z lower-cased.  A language keeps the V terms that stand in at least ten of
its documents; a group is a (language, source).  The frequency of a kept term in a group is p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N being
the group's occurrences of kept terms; two groups differ in a term by floor((p - q)^2 / (p + q)).  All of it is exact integer arithmetic.

Pairs: kept terms are numbered densely within their language and cut into blocks of a bounded number of ids.  A group's part of a
block is one row with a sorted id array and a count array.  A pair task brings the rows of some sources and of some others together
for one block and prices each unordered pair by a sparse merge: a galloping search finds the ids both have, which are priced as overlap; the
others of either side are priced against the frequency of an absent term, both ways; the rest of the block, which
neither has, is priced by its number.  The price is symmetric, so a pair is computed once and stands in both reports.  Sources
are dealt in bins, so a row is sent once per bin, not once per other source.

Terms: each group's terms that it uses more than its language does, the ten farthest from it.

Nulls: a null text has no term; a null lang or source counts as ''.  A group without terms, or all of it in a language without kept terms, is a
group all the same; without kept terms every value is 0.  Long texts are read piece by piece.  An empty table gives no row.  Repeated
rows count as often as they stand there.  Columns other than ``text, lang, source`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplelake.llm.common import numbered, stored

#: In UTF-8 all bytes of characters beyond ASCII are 0x80 or more.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
UNIT = 1_000_000_000
LEAST_DOCUMENTS = 10
#: Ids per block, sources per bin, and terms a counting task holds before it passes its sums on.  They bound memory and change no result.
BLOCK, BIN, HELD = 8192, 8, 400_000
#: Probes that gallop together.
STRIDE = 128


# Counting


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text, of a long one in parts cut where no term is."""
    if len(text) <= size:
        yield TERM.findall(text)
        return
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        rest = TERM.match(text, end) if end < len(text) else None
        end = rest.end() if rest else end
        yield TERM.findall(text[at:end])
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, added up; every group has a row with the term ''."""
    names = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def passed_on(counts: dict, documents: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            within = documents[lang, source]
            terms = list(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()), pa.array(found.values(), pa.int64()),
                    pa.array([within[t] for t in terms], pa.int64()),
                ],
                schema=names,
            )
        counts.clear(), documents.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents, held = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                key = lang, source
                found, before = counts[key], len(counts[key])
                found[b""] += 0
                once: set[bytes] = set()
                for terms in pieces(text.lower()):
                    found.update(terms)
                    once.update(terms)
                documents[key].update(once)
                held += len(found) - before
                if held >= HELD:
                    yield from passed_on(counts, documents)
                    held = 0
        yield from passed_on(counts, documents)

    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    partial = rows.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return partial.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


# Prices


def frequency(count: Column, total: Column, kept: Column) -> Column:
    """p, by long division three digits at a time, so that no product leaves 64 bits."""
    over = total + 2 * kept
    rest, p = count + 2, F.lit(0).cast("long")
    for _ in range(4):
        p = p * 1000 + F.call_function("div", rest, over)
        rest = (rest % over) * 1000
    return p + 1


def frequencies(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The same of an array."""
    over = np.int64(total + 2 * kept)
    rest, p = count.astype(np.int64) + 2, np.zeros(len(count), np.int64)
    for _ in range(4):
        p = p * 1000 + rest // over
        rest = rest % over * 1000
    return p + 1


def price(p, q):
    return (p - q) * (p - q) // (p + q)


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Where each of ``few`` would stand in ``many``, both sorted.

    Probes go on from where the last ones were found, with steps that double until they pass them, then by binary search between.
    """
    at, low = np.empty(len(few), np.int64), 0
    for i in range(0, len(few), STRIDE):
        probes = few[i : i + STRIDE]
        step = len(probes)
        while low + step < len(many) and many[low + step] < probes[-1]:
            step *= 2
        at[i : i + STRIDE] = low + np.searchsorted(many[low : low + step + 1], probes)
        low = at[min(i + STRIDE, len(few)) - 1]
    return at


class Side:
    """One group's part of a block: its sorted ids with their frequencies, and that of a term it has not."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, total: int, kept: int):
        self.ids, self.p = ids, frequencies(counts, total, kept)
        self.absent = int(frequencies(np.zeros(1, np.int64), total, kept)[0])
        self.against: dict[int, np.ndarray] = {}

    def one_sided(self, other: int) -> np.ndarray:
        """Prices of its ids against a group that has none of them; kept, as many groups are equally large."""
        if other not in self.against:
            self.against[other] = price(self.p, np.int64(other))
        return self.against[other]


def pair_price(a: Side, b: Side, ids: int) -> int:
    """Sum of the prices of all ids of a block."""
    if len(a.ids) > len(b.ids):
        a, b = b, a
    at = gallop(a.ids, b.ids)
    inside = np.minimum(at, max(len(b.ids) - 1, 0))
    both = (b.ids[inside] == a.ids) if len(b.ids) else np.zeros(len(a.ids), bool)
    inside = inside[both]
    alone_a, alone_b = a.one_sided(b.absent), b.one_sided(a.absent)
    overlap = int(price(a.p[both], b.p[inside]).sum())
    one_sided = int(alone_a.sum()) - int(alone_a[both].sum()) + int(alone_b.sum()) - int(alone_b[inside].sum())
    neither = ids - len(a.ids) - len(b.ids) + len(inside)
    return overlap + one_sided + neither * price(a.absent, b.absent)


# The audit


def _pairs(groups: DataFrame, kept: DataFrame, sizes: DataFrame, block: int, bin_size: int) -> DataFrame:
    """``lang, source, item, value`` of both directions of every pair."""
    arrays = (
        kept.withColumns({"block": F.expr(f"id div {block}"), "local": F.expr(f"CAST(id % {block} AS INT)")})
        .groupBy("lang", "source", "block")
        .agg(F.sort_array(F.collect_list(F.struct("local", "n"))).alias("terms"))  # at most a block of them
        .select("lang", "source", "block", F.col("terms.local").alias("ids"), F.col("terms.n").alias("counts"))
    )
    # A group without terms in a block has a price there all the same; a language without terms has one empty block.
    blocks = sizes.withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr(f"(kept_terms - 1) div {block}")))))
    blocks = blocks.select("lang", "block", F.least(F.lit(block), F.col("kept_terms") - F.col("block") * block).cast("int").alias("in_block"))
    rows = groups.join(blocks, "lang").join(arrays, ["lang", "source", "block"], "left")
    home = F.expr(f"CAST(g div {bin_size} AS INT)")
    last = F.expr(f"CAST((sources - 1) div {bin_size} AS INT)")
    dealt = rows.withColumn("home", home).withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "lang", "block", F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high"), "home",
        "g", "source", "total", "kept_terms", "in_block", "ids", "counts",
    )

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("g")
        none, found = np.zeros(0, np.int64), []
        if int(part["kept_terms"].iloc[0]):
            sides = [
                Side(none if i is None else np.asarray(i), none if c is None else np.asarray(c), n, v)
                for i, c, n, v in zip(part["ids"], part["counts"], part["total"], part["kept_terms"])
            ]
        ids, names, homes = int(part["in_block"].iloc[0]), part["source"].tolist(), part["home"].tolist()
        for i in range(len(names)):
            for j in range(i + 1, len(names)):
                if key[2] == key[3] or homes[i] != homes[j]:  # pairs within a bin have a task of their own
                    found.append((key[0], names[i], names[j], pair_price(sides[i], sides[j], ids) if ids > 0 else 0))
        return pd.DataFrame(found, columns=["lang", "source", "item", "value"])

    parts = dealt.groupBy("lang", "block", "low", "high").applyInPandas(
        merge, "lang string, source string, item string, value long"
    )
    once = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    there_and_back = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return once.select("lang", F.explode(there_and_back).alias("way"), "value").select("lang", "way.*", "value")


def audit(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = 10, block: int = BLOCK, bin_size: int = BIN
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every pair of sources of a language and the ``top`` terms of each group."""
    counts = stored(term_counts(docs), "counts")
    terms = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    vocabulary = numbered(terms.where(F.col("docs") >= least).drop("docs"), "lang", ["term"], "id", "kept_terms", spread=False)
    kept = stored(counts.drop("docs").join(vocabulary, ["lang", "term"]), "kept")  # frequent terms: a row per source, split when skewed

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total"])
    sizes = kept.groupBy("lang").agg(F.max("kept_terms").alias("kept_terms"))
    by_lang = Window.partitionBy("lang")  # a row per source
    groups = every.join(sizes, "lang", "left").fillna(0, ["kept_terms"]).select(
        "lang", "source", "total", "kept_terms", F.sum("total").over(by_lang).alias("lang_total"), F.count("*").over(by_lang).alias("sources"),
        (F.row_number().over(by_lang.orderBy("source")) - 1).alias("g"),
    )
    groups = stored(groups, "groups")
    sizes = groups.groupBy("lang").agg(F.max("kept_terms").alias("kept_terms"))

    pairs = _pairs(groups, kept.select("lang", "source", "id", "n"), sizes, block, bin_size)
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(own).alias("rank"))

    p, q = frequency(F.col("n"), F.col("total"), F.col("kept_terms")), frequency(F.col("lang_n"), F.col("lang_total"), F.col("kept_terms"))
    priced = kept.drop("kept_terms").join(groups, ["lang", "source"]).withColumns({"p": p, "q": q}).where("p > q AND n > 0")
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
    ranked = priced.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    ranked = ranked.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top)  # cut to the top within each task first
    return pairs.unionByName(ranked)
