"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over ``SPAN`` neighbouring tokens: hashes are made of the tokens where the mask has a 1, so a
substituted token under a 0 does not hide a match.  Hashes of all masks at every place of the benchmark items meet those of every place of every
training text.  Around each hit, item and text are laid over each other at the hit's offset and compared token by token: a stretch
counts if at least ``SHARE`` of its tokens agree and it has ``LEAST`` tokens.  An inserted or removed word moves what follows to another
offset, so the item's tokens under the stretches of all offsets are united.  Item and text overlap if these are ``COVER`` of the item's
tokens, but 8 tokens at least, or if one stretch has ``RUN`` tokens that agree: a long part of a long item.

Tokens are runs of letters and digits, lower-cased.  The benchmark's hashes go to the tasks in blocks of at most ``BLOCK`` items each,
one pass over the texts per block, so what is sent is bounded whatever the benchmark's size; the texts are never shuffled.

Items with fewer than ``SHORT`` tokens have masks of a shorter span besides; a word inserted amid fewer than 16 tokens leaves no stretch of
``LEAST`` and may hide them.  Items with fewer than ``SPAN`` tokens are compared by their whole token sequence.  Nulls: a null text or item has no token and never
matches.  Empty tables give no row.  Repeated rows are reported one by one.  Columns other than the ids and texts are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = 12
#: Fixed masks of weight 8 over 12 tokens: any two substitutions in 19 tokens or more leave places where one of them still hits.
MASKS = ("111011001011", "110100110111", "111111110000", "101101110101")
#: Masks of weight 5 that do so from 12 tokens on, for items of fewer than ``SHORT``.
SHORT, SHORT_MASKS = 24, ("10001111", "101100101")
SHARE, COVER, LEAST, RUN = 0.8, 0.6, 8, 50
BLOCK = 5_000
#: Tokens that are hashed at once: texts are short, and one by one the calls cost more than the work.
TOGETHER = 16_384
TOKEN = re.compile(r"[^\W_]+")
ODD = np.uint64(0x9E3779B97F4A7C15)


class _Known(dict):
    """Token to hash; one that is asked for the first time is hashed."""

    def __missing__(self, token: str) -> int:
        import xxhash

        found = self[token] = xxhash.xxh64_intdigest(token)
        return found


class Hashes:
    """Tokens to hashes, remembered."""

    def __init__(self, remember: int = 500_000):
        self.known, self.remember = _Known(), remember

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall((text or "").lower())
        if len(self.known) > self.remember:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, tokens), np.uint64, len(tokens))


def seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """The hash at every place: a sum of the masked tokens, each turned by its place."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, len(mask) * 1000 + int(mask, 2), np.uint64)
    for k, keep in enumerate(mask):
        if keep == "1":
            total = (total ^ tokens[k : k + n]) * ODD
            total ^= total >> np.uint64(29)
    return total


class Index:
    """The seeds of some benchmark items, sorted, and a small bitmap that rejects most others."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items, self.short, self.masks = items, defaultdict(list), set(MASKS)
        hashes, spots = [], []
        for at, (_, tokens) in enumerate(items):
            if 0 < len(tokens) < SPAN:
                self.short[len(tokens)].append(at)
            short = SPAN <= len(tokens) < SHORT
            self.masks |= set(SHORT_MASKS) if short else set()
            for mask in MASKS + SHORT_MASKS * short:
                found = seeds(tokens, mask)
                hashes.append(found)
                spots.append(np.stack([np.full(len(found), at), np.arange(len(found))], 1))
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.spots = np.concatenate(spots)[order] if spots else np.zeros((0, 2), np.int64)
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[self.hashes >> np.uint64(42)] = True

    def hits(self, texts: list[np.ndarray]) -> list[set[tuple[int, int]]]:
        """``(item, offset of the item's start in the text)`` per text; the texts are hashed as one, without the places that span two."""
        out: list[set[tuple[int, int]]] = [set() for _ in texts]
        ends = np.cumsum([len(t) for t in texts])
        joined = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
        for mask in self.masks:
            found = seeds(joined, mask)
            maybe = np.flatnonzero(self.bitmap[found >> np.uint64(42)])
            left = np.searchsorted(self.hashes, found[maybe], "left")
            right = np.searchsorted(self.hashes, found[maybe], "right")
            known = left < right
            maybe, left, right = maybe[known], left[known], right[known]
            text = np.searchsorted(ends, maybe, "right")
            inside = maybe + len(mask) <= ends[text]
            at = maybe - (ends[text] - np.array([len(t) for t in texts], np.int64)[text])
            for t, place, a, b in zip(*(x[inside].tolist() for x in (text, at, left, right))):
                for item, start in self.spots[a:b].tolist():
                    out[t].add((item, place - start))
        for size, members in self.short.items():
            for item in members:
                wanted = self.items[item][1]
                for tokens, some in zip(texts, out):
                    for place in np.flatnonzero(tokens[: len(tokens) - size + 1] == wanted[0]).tolist():
                        if np.array_equal(tokens[place : place + size], wanted):
                            some.add((item, place))
        return out

    def overlaps(self, tokens: np.ndarray, hits: set[tuple[int, int]] | None = None) -> dict[int, tuple[int, int, int, int]]:
        """For each item that overlaps enough: start in the text, tokens, tokens that agree, start in the item."""
        stretches = defaultdict(list)
        for item, offset in sorted(self.hits([tokens])[0] if hits is None else hits):
            wanted = self.items[item][1]
            first, last = max(0, -offset), min(len(wanted), len(tokens) - offset)
            same = wanted[first:last] == tokens[first + offset : last + offset]
            for begin, end in _stretches(same, min(LEAST, len(wanted))):
                stretches[item].append((first + begin, first + end, offset, same[begin:end]))
        best: dict[int, tuple[int, int, int, int]] = {}
        for item, found in stretches.items():
            size = len(self.items[item][1])
            enough = min(size, max(LEAST, int(np.ceil(COVER * size))))
            covered, agreed, most = np.zeros(size, bool), np.zeros(size, bool), (0, 0, 0)
            alone = False
            for begin, end, offset, same in found:
                agree = int(same.sum())
                covered[begin:end] = True
                agreed[begin:end] |= same
                alone |= end - begin >= enough or agree >= RUN
                most = max(most, (agree, -begin - offset, -begin))
            n, agree = int(covered.sum()), int(agreed.sum())
            if alone or (n >= enough and agree >= SHARE * n):
                best[item] = (-most[1], n, agree, -most[2])
        return best


def _stretches(same: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``least`` tokens or more of which ``SHARE`` agree: +1 for a token that agrees, -2 for one that does not, best
    sum; then what lies before and after it.  A stretch in which too few agree is searched again at -4, where none can.  If
    ``SHARE`` of all agree, that is one stretch."""
    if len(same) >= least and same.sum() >= SHARE * len(same):
        yield 0, len(same)
        return
    todo = [(0, len(same), 2)]
    while todo:
        a, b, loss = todo.pop()
        if b - a < least:
            continue
        gain = np.concatenate([[0], np.cumsum(np.where(same[a:b], 1, -loss))])
        low = np.minimum.accumulate(gain)
        end = int(np.argmax(gain - low))
        begin = int(np.flatnonzero(gain[: end + 1] == low[end])[-1])
        if end == begin:
            continue
        begin, end = a + begin, a + end
        if same[begin:end].sum() >= SHARE * (end - begin):
            if end - begin >= least:
                yield begin, end
        else:
            todo.append((begin, end, 4))
        todo += [(a, begin, loss), (end, b, loss)]


OUT = "doc_id long, item_id long, start long, n_tokens long, n_equal long, item_tokens long, h long"


def overlaps(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per text and benchmark item that overlap, with the place, the number of equal tokens and the hash of the text."""
    items = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text")
    blocks = max(1, -(-items.count() // block))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    out = None
    for k in range(blocks):
        rows = items.where(part == k).orderBy("item_id", "text").collect()  # about BLOCK short items
        hashes = Hashes()
        sent = docs.sparkSession.sparkContext.broadcast([(r.item_id, hashes(r.text)) for r in rows])
        # An id that is absent is told apart by a flag, as pandas would make the others floats.
        doc_id, absent = F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNull().alias("absent")
        texts = docs.select(doc_id, absent, "text", F.xxhash64("text").alias("h"))
        found = texts.mapInPandas(_scan(sent), OUT)
        out = found if out is None else out.union(found)
    return out


def _together(texts: Iterator[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Texts in lists of about ``TOGETHER`` tokens, each with the number of its first."""
    first, some, size = 0, [], 0
    for tokens in texts:
        some.append(tokens)
        size += len(tokens)
        if size >= TOGETHER:
            yield first, some
            first, some, size = first + len(some), [], 0
    if some:
        yield first, some


def _scan(sent):
    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, hashes = Index(sent.value), Hashes()
        names = [f.split()[0] for f in OUT.split(", ")]
        for part in parts:
            rows = []
            for a, texts in _together(map(hashes, part["text"])):
                ids, absents, hs = (part[c].iloc[a : a + len(texts)].tolist() for c in ("doc_id", "absent", "h"))
                for doc_id, absent, h, tokens, hits in zip(ids, absents, hs, texts, index.hits(texts)):
                    for item, (start, n, agree, _) in (index.overlaps(tokens, hits) if hits else {}).items():
                        item_id, wanted = index.items[item]
                        rows.append((None if absent else doc_id, item_id, start, n, agree, len(wanted), h))
            yield pd.DataFrame(rows, columns=names).assign(doc_id=pd.array([r[0] for r in rows], "Int64"))

    return scan


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items that are given twice count once: a text and an item id make one row."""
    best = F.max_by(F.struct("start", "n_tokens", "n_equal", "item_tokens"), F.struct("n_equal", -F.col("start")))
    return overlaps(docs, benchmark).groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that overlap no item, columns as they were; rows are told apart by doc_id, null or not, and the hash of the text."""
    from ripplelake.llm.common import spare_name, stored

    names = [spare_name(docs, n) for n in ("hit_id", "hit_h")]
    hit = stored(overlaps(docs, benchmark).select("doc_id", "h").distinct().toDF(*names), "contaminated")
    match = F.col("doc_id").eqNullSafe(F.col(names[0])) & (F.xxhash64("text") == F.col(names[1]))
    return docs.join(hit, match, "left_anti")
