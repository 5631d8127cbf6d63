"""Exact removal of repeated byte strings: names of growing length at winnowed anchors, settled by grouping.

A name is a hash of the bytes that follow a place, made within a task of the names of 8 bytes; longer names are made of pairs of shorter
ones, up to the 50 bytes that decide.  Only what may still repeat goes on to the next length.  Spark brings equal names together and decides:

* Names are compared at anchors only: places whose 24-byte name is the least of a run of 27 (winnowing).  Every 50-byte string holds an
  anchor, and equal strings hold the same ones.  What an anchor decides are the 50-byte strings between it and the anchor before: a segment.
* The first round sends one short entry per anchor: its name, the segment's name and a byte of the names of the 37 bytes up to the anchor's end
  and from its start on.  A segment that an earlier document has is gone.  A first one goes on if another segment of its
  anchor shares the 37 bytes of either side.  Every anchor gets its own answer, a byte that goes back to its document.
* The second round compares the 50-byte strings of what goes on one by one, from the 26 bytes on either side of the anchor.

Entries travel as arrays, one per batch of texts and part of the names; parts grow in number with the bytes of the corpus, so that
a part does not.  Nothing is broadcast.  The removed byte ranges are exact: names that decide are of 80 bits or more.

Nulls: a null text is empty and nothing is removed; a null doc_id comes after all others.  An empty table gives no row.  Rows with the same
doc_id do not remove each other's bytes; what goes from a row is found again by its id and a 64-bit hash of its text.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import discard, stored, text_of

LENGTH, NAMED = 50, 24
RUN = LENGTH - NAMED + 1
#: How far the longer names reach beyond an anchor: half of what a string has beside it.
ASIDE = (LENGTH - NAMED) // 2
LAST = 2**63 - 1
#: Strings that are looked at together, and the bits that hold a place among them.
CHUNK, PLACE_BITS = 1 << 17, 18
#: Text whose entries are sent together, and rows of it.
BATCH_BYTES, BATCH_ROWS = 16 << 20, 1 << 16
#: Text whose entries meet in one part, on average.
PART_BYTES, MOST_PARTS = 8 << 20, 1 << 14
GONE, LEFT, RIGHT = 1, 2, 4


def _odd(k: int) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64 | 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _odd(5)
    x ^= x >> np.uint64(29)
    return x


def names(data: np.ndarray) -> np.ndarray:
    """Names of the 24 bytes at every place."""
    n = len(data) - NAMED + 1
    eight = np.ndarray((n + 16,), "<u8", data, strides=(1,)) * _odd(8)
    eight ^= eight >> np.uint64(32)
    name = eight[:n] * _odd(16)
    name += eight[8 : 8 + n]
    name *= _odd(17)
    name += eight[16:]
    name ^= name >> np.uint64(29)
    name *= _odd(3)
    name ^= name >> np.uint64(32)
    return name


def _least_of(a: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every run of this width stands, the leftmost of equals (in all but the last bits, which hold the place)."""
    place = np.uint64((1 << PLACE_BITS) - 1)
    least, have = (a & ~place) | np.arange(len(a), dtype=np.uint64), 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[step:], least[:-step])
        have += step
    return (least & place).astype(np.int64)


@dataclass(frozen=True)
class Anchors:
    """Of texts laid end to end: where anchors are and their names, a byte of the names of the 37 bytes up to an anchor's end and from
    its start on (0: none of its strings holds them), the name of its segment, and the first and last 50-byte string that it decides."""

    at: np.ndarray
    name: np.ndarray
    left: np.ndarray
    right: np.ndarray
    segment: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors(data: np.ndarray, ends: np.ndarray) -> Iterator[Anchors]:
    """The anchors of texts that end at these places, stretch by stretch.  A string's anchor depends on its own bytes only."""
    n = len(data) - LENGTH + 1  # strings, also those across the ends of texts
    begin = 0
    while begin < n:
        end = min(begin + CHUNK, n)
        name = names(data[begin : end + LENGTH - 1])
        anchor = _least_of(name, RUN)
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        new[ends[np.searchsorted(ends, begin) : np.searchsorted(ends, end)] - begin] = True
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(anchor)) - 1
        if end < n:  # the last segment may go on
            begin, first, last, was = begin + int(first[-1]), first[:-1], last[:-1], begin
        else:
            begin, was = n, begin
        last = np.minimum(last, ends[np.searchsorted(ends, first + was, "right")] - was - LENGTH)
        whole = first <= last
        first, last = first[whole], last[whole]
        at = anchor[first]
        own = name[at]
        left = _mixed(name[np.maximum(at - ASIDE, 0)] * _odd(37) + own)
        right = _mixed(own * _odd(37) + name[np.minimum(at + ASIDE, len(name) - 1)])
        left = np.where(first <= at - ASIDE, np.maximum(left >> np.uint64(56), np.uint64(1)), np.uint64(0)).astype(np.uint8)
        right = np.where(last >= at - ASIDE, np.maximum(right >> np.uint64(56), np.uint64(1)), np.uint64(0)).astype(np.uint8)
        tail = last + LENGTH - NAMED
        segment = _mixed(name[first] + (last - first).astype(np.uint64) * _odd(50))
        for place in (np.minimum(first + NAMED, tail), np.minimum(first + NAMED + 4, tail), tail):
            segment = _mixed(segment * _odd(25) + name[place])
        yield Anchors(at + was, own, left, right, segment, first + was, last + was)


def _laid(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts laid end to end, about 1 MB at a time: the first and after the last, their bytes, and where each ends."""
    some, size, begin = [], 0, 0
    for k, text in enumerate(texts):
        some.append((text or "").encode())
        size += len(some[-1])
        if size >= 1 << 20 or k == len(texts) - 1:
            yield begin, k + 1, np.frombuffer(b"".join(some), np.uint8), np.cumsum([len(x) for x in some])
            some, size, begin = [], 0, k + 1


def _part_of(name: np.ndarray, bits: int) -> np.ndarray:
    """Least names are small ones: parts go by all bits."""
    return (_mixed(name * _odd(7)) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(name), np.int64)


def _small(x: np.ndarray) -> np.ndarray:
    """The smallest type that holds these numbers."""
    for kind in (np.int8, np.int16, np.int32):
        if len(x) and np.iinfo(kind).min <= x.min() and x.max() <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


ENTRIES = "batch long, part int, n int, sent binary"


def _entries(bits: int):
    """Per batch and part one row with the entries of its anchors, and one that lists the rows of the batch (a part below 0)."""

    def entries(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 33
        for part in parts:
            docs, hashes, texts = part["doc"].to_numpy(np.int64), part["h"].to_numpy(np.int64), part["text"]
            sizes = np.cumsum(part["size"].to_numpy(np.int64))
            begin = 0
            while begin < len(docs):
                most = (sizes[begin - 1] if begin else 0) + BATCH_BYTES
                end = min(max(int(np.searchsorted(sizes, most, "right")), begin + 1), begin + BATCH_ROWS, len(docs))
                # Named by its rows too: if a repeated task made other batches, their answers would not be taken for one.
                batch = xxhash.xxh64_intdigest(docs[begin:end].tobytes() + hashes[begin:end].tobytes(), made) >> 1
                yield sent(batch, docs[begin:end], hashes[begin:end], texts.iloc[begin:end].tolist())
                begin, made = end, made + 1

    def sent(batch: int, docs: np.ndarray, hashes: np.ndarray, texts: list) -> pd.DataFrame:
        found = []
        for first, _, data, ends in _laid(texts):
            for a in anchors(data, ends):
                row = (first + np.searchsorted(ends, a.at, "right")).astype(np.uint16)
                key = (_mixed(a.name) >> np.uint64(32)).astype(np.uint32)
                high, low = (a.segment >> np.uint64(32)).astype(np.uint32), (a.segment & np.uint64(0xFFFF)).astype(np.uint16)
                found.append((_part_of(a.name, bits).astype(np.uint16), key, high, low, a.left, a.right, row))
        rows = [(batch, -1 - batch % (1 << 30), len(docs), docs.tobytes() + hashes.tobytes())]
        if found:
            part, *fields = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(part, kind="stable")
            part, fields = part[order], [x[order] for x in fields]
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                doc = docs[fields[-1][a:b]]
                with np.errstate(over="ignore"):  # wraps around, and back where it is read
                    steps = _small(np.diff(doc, prepend=doc[:1]))
                rows.append((batch, int(part[a]), b - a, b"".join([doc[:1].tobytes(), *(x[a:b].tobytes() for x in fields), steps.tobytes()])))
        return pd.DataFrame(rows, columns=["batch", "part", "n", "sent"])

    return entries


def _read(n: int, sent: bytes) -> list[np.ndarray]:
    """Key, segment's name in two, left, right, row and document of each entry."""
    out, at = [], 8
    for kind in (np.uint32, np.uint32, np.uint16, np.uint8, np.uint8, np.uint16):
        out.append(np.frombuffer(sent, kind, n, at))
        at += out[-1].nbytes
    steps = np.frombuffer(sent, f"<i{(len(sent) - at) // n}", n, at)
    return [*out, np.frombuffer(sent, np.int64, 1)[0] + np.cumsum(steps, dtype=np.int64)]


def _spread(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the group of each place has different values."""
    order = np.argsort(group, kind="stable")
    group, value = group[order], value[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    differ = np.minimum.reduceat(value, starts) < np.maximum.reduceat(value, starts)
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(differ, np.diff(np.append(starts, len(order))))
    return out


def verdicts(key: np.ndarray, high: np.ndarray, low: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per entry of a part: gone, or which sides may hold strings that another segment of the anchor has too."""
    out = np.zeros(len(key), np.uint8)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    order = order[np.append(same, False) | np.append(False, same)]  # the others are alone with their name
    if not len(order):
        return out
    rest = low.astype(np.uint64) << np.uint64(16) | left.astype(np.uint64) << np.uint64(8) | right
    whole = key.astype(np.uint64) << np.uint64(32) | high
    order = order[np.lexsort((rest[order], whole[order]))]
    whole, rest, docs = whole[order], rest[order], doc[order]
    new = np.append(True, (whole[1:] != whole[:-1]) | (rest[1:] != rest[:-1]))
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(docs, starts)
    where = np.cumsum(new) - 1
    first = docs == least[where]
    # One place per segment: does another one, first found in another document, share a side?
    anchor = np.cumsum(np.append(True, whole[starts][1:] >> np.uint64(32) != whole[starts][:-1] >> np.uint64(32)))
    flags = np.zeros(len(starts), np.uint8)
    for side, flag in ((left, LEFT), (right, RIGHT)):
        side = side[order[starts]]
        some = np.flatnonzero(side)
        if len(some):
            flags[some[_spread(anchor[some] << 8 | side[some], least[some])]] |= flag
    out[order] = np.where(first, flags[where], GONE)
    return out


ANSWERS = "batch long, part int, n int, rows binary, verdicts binary"


def _answers(key, sent: pd.DataFrame) -> pd.DataFrame:
    if key[0] < 0:
        return pd.DataFrame({"batch": sent["batch"], "part": sent["part"], "n": sent["n"], "rows": sent["sent"], "verdicts": b""})
    read = [_read(n, x) for n, x in zip(sent["n"].tolist(), sent["sent"])]
    rows = [x[5].tobytes() for x in read]
    fields = [np.concatenate(x) for x in zip(*read)]
    found = np.split(verdicts(*fields[:5], fields[6]), np.cumsum(sent["n"])[:-1])
    return pd.DataFrame(
        {"batch": sent["batch"], "part": sent["part"], "n": sent["n"], "rows": rows, "verdicts": [x.tobytes() for x in found]}
    )


SEGMENTS = "doc long, h long, verdicts binary"


def _by_row(key, answers: pd.DataFrame) -> pd.DataFrame:
    """The verdicts of each row of a batch, by part and place; rows without one are left out."""
    answers = answers.sort_values("part")
    if answers["part"].iloc[0] >= 0 or (answers["part"] < 0).sum() != 1:
        raise RuntimeError("a batch of texts was not made the same way twice")
    n = int(answers["n"].iloc[0])
    docs, hashes = np.frombuffer(answers["rows"].iloc[0], np.int64).reshape(2, n)
    row = np.frombuffer(b"".join(answers["rows"].iloc[1:]), np.uint16)
    found = np.frombuffer(b"".join(answers["verdicts"].iloc[1:]), np.uint8)[np.argsort(row, kind="stable")]
    ends = np.cumsum(np.bincount(row, minlength=n))
    some = [(k, found[a:b]) for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist()))]
    some = [(k, x.tobytes()) for k, x in some if x.any()]
    at = np.array([k for k, _ in some], np.int64)
    return pd.DataFrame({"doc": docs[at], "h": hashes[at], "verdicts": [x for _, x in some]})


#: Ranges that go (a part below 0), and what the second round compares.
ROUND = "part int, doc long, h long, at int, own int, n int, sent binary"
SIDE = LENGTH - NAMED


def _decided(bits: int):
    """Applies the verdicts: runs of segments that go, and the sides of anchors whose strings are compared."""

    def decided(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            docs, hashes, said, texts = part["doc"].to_numpy(np.int64), part["h"].to_numpy(np.int64), part["verdicts"], part["text"].tolist()
            for begin, end, data, ends in _laid(texts):
                yield from some(docs[begin:end], hashes[begin:end], said.iloc[begin:end].tolist(), data, ends)

    def some(docs, hashes, said, data, ends) -> Iterator[pd.DataFrame]:
        found = list(anchors(data, ends))
        at, name, first, last = (np.concatenate([getattr(a, f) for a in found]) for f in ("at", "name", "first", "last"))
        row = np.searchsorted(ends, at, "right")
        found = np.zeros(len(at), np.uint8)
        part = _part_of(name, bits)
        found[np.argsort(row << 16 | part, kind="stable")] = np.frombuffer(b"".join(said), np.uint8)
        begins = np.append(0, ends[:-1])
        gone = np.flatnonzero(found == GONE)
        if len(gone):
            new = np.append(True, (first[gone[1:]] != last[gone[:-1]] + 1) | (row[gone[1:]] != row[gone[:-1]]))
            a, b = first[gone[new]], last[gone[np.append(new[1:], True)]]
            r = row[gone[new]]
            yield frame(np.full(len(r), -1), docs[r], hashes[r], a - begins[r], b - a + 1, 0, None)
        lo = np.where(found & LEFT > 0, first, np.maximum(first, at - ASIDE + 1))
        hi = np.where(found & RIGHT > 0, last, np.minimum(last, at - ASIDE))
        hi = np.where((found & RIGHT == 0) & (found & LEFT == 0), lo - 1, hi)
        open_ = np.flatnonzero((found != GONE) & (lo <= hi))
        if not len(open_):
            return
        open_ = open_[np.argsort(part[open_], kind="stable")]
        part, at, lo, hi, row, name = (x[open_] for x in (part, at, lo, hi, row, name))
        padded = np.concatenate([np.zeros(SIDE, np.uint8), data, np.zeros(SIDE, np.uint8)])
        beside = np.concatenate([np.arange(SIDE), np.arange(SIDE) + LENGTH])
        cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
        sent = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            r = row[a:b]
            fields = (
                name[a:b], docs[r], hashes[r], (at[a:b] - begins[r]).astype(np.int32), (at[a:b] - hi[a:b]).astype(np.uint8),
                (at[a:b] - lo[a:b]).astype(np.uint8), padded[at[a:b, None] + beside],
            )
            sent.append(b"".join(x.tobytes() for x in fields))
        yield frame(part[cuts[:-1]], 0, 0, 0, 0, np.diff(cuts), sent)

    def frame(part, doc, h, at, own, n, sent) -> pd.DataFrame:
        out = pd.DataFrame({"part": part, "doc": doc, "h": h, "at": at, "own": own, "n": n, "sent": sent})
        return out.astype({"part": np.int32, "doc": np.int64, "h": np.int64, "at": np.int32, "own": np.int32, "n": np.int32})

    return decided


STRINGS = "doc long, h long, at int, own int"


def _strings(key, sent: pd.DataFrame) -> pd.DataFrame:
    """Runs of 50-byte strings of a part that an earlier document has, each given by what it holds on both sides of its anchor."""
    fields = [[] for _ in range(7)]
    for n, x in zip(sent["n"].tolist(), sent["sent"]):
        at = 0
        for k, (kind, width) in enumerate(((np.uint64, 1), (np.int64, 1), (np.int64, 1), (np.int32, 1), (np.uint8, 1), (np.uint8, 1), (np.uint8, 2 * SIDE))):
            fields[k].append(np.frombuffer(x, kind, n * width, at))
            at += fields[k][-1].nbytes
    name, doc, h, at, least, most, beside = (np.concatenate(x) for x in fields)
    beside = beside.reshape(-1, 2 * SIDE)
    # Only anchors that two documents have can hold a string of two.
    keep = np.flatnonzero(_spread(name, doc))
    name, doc, h, at, least, most, beside = (x[keep] for x in (name, doc, h, at, least, most, beside))
    gone = np.zeros(len(name), np.int64)
    right = [name * _odd(60)]
    for k in range(SIDE):
        right.append(_mixed(right[-1] * _odd(61) + beside[:, SIDE + k] + np.uint64(1)))
    left = name * _odd(62)
    for d in range(SIDE + 1):
        if d:
            left = _mixed(left * _odd(63) + beside[:, SIDE - d] + np.uint64(1))
        some = np.flatnonzero((least <= d) & (d <= most))
        if not len(some):
            continue
        whole = _mixed(left[some] * _odd(64) + right[SIDE - d][some])
        order = np.lexsort((name[some], whole))
        some, whole = some[order], whole[order]
        new = np.append(True, (whole[1:] != whole[:-1]) | (name[some[1:]] != name[some[:-1]]))
        first = np.minimum.reduceat(doc[some], np.flatnonzero(new))[np.cumsum(new) - 1]
        gone[some[doc[some] > first]] |= 1 << d
    runs = []
    for d in range(SIDE + 1):  # a run ends before the string that starts one place nearer to the anchor
        some = np.flatnonzero((gone >> d & 1 == 1) & (gone >> (d + 1) & 1 == 0))
        filled = gone[some] & ((1 << (d + 1)) - 1)
        own = np.zeros(len(some), np.int32)
        for e in range(d, -1, -1):
            own += (own == d - e) & (filled >> e & 1 == 1)
        runs.append((doc[some], h[some], at[some] - d, own))
    doc, h, at, own = (np.concatenate(x) for x in zip(*runs))
    return pd.DataFrame({"doc": doc, "h": h, "at": at.astype(np.int32), "own": own.astype(np.int32)})


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(with_bytes: bool):
    def remove(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for part in parts:
            rows = []
            for doc_id, text, spots, owns in zip(part["doc_id"], part["text"], part["spots"], part["owns"]):
                raw = (text or "").encode()
                gone = np.zeros(len(raw) + 1, np.int32)
                if spots is not None:
                    at = np.asarray(spots, np.int64)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + np.asarray(owns, np.int64) - 1 + LENGTH, -1)
                mask = np.cumsum(gone)[:-1] > 0
                kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                spans = int(np.count_nonzero(mask[1:] & ~mask[:-1]) + (len(mask) > 0 and mask[0]))
                rows.append((doc_id, len(raw), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")]).astype({"doc_id": "Int64"})

    return remove


def removals(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest of what is kept, and (if asked for) the kept bytes."""
    doc, h = F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("doc"), F.xxhash64(text_of()).alias("h")
    rows = docs.select(doc, h, text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(-(-total // PART_BYTES) - 1, 0).bit_length(), MOST_PARTS.bit_length() - 1)
    # Names of anchors and segments: what an earlier document has is gone, what shares a side goes on.
    sized = rows.withColumn("size", F.octet_length("text")).where(F.col("size") >= LENGTH)
    sent = sized.mapInPandas(_entries(bits), ENTRIES)
    answers = sent.groupBy("part").applyInPandas(_answers, ANSWERS)
    segments = stored(answers.groupBy("batch").applyInPandas(_by_row, SEGMENTS), "segments")
    said = segments.groupBy("doc", "h").agg(F.first("verdicts").alias("verdicts"))
    decided = stored(rows.join(said, ["doc", "h"]).mapInPandas(_decided(bits), ROUND), "gone")
    # The ranges that go are stored: nothing needs the verdicts any more.
    discard(segments)
    # The 50-byte strings of the others, one by one.
    strings = stored(decided.where("part >= 0").select("part", "n", "sent").groupBy("part").applyInPandas(_strings, STRINGS), "strings")
    every = decided.where("part < 0").select("doc", "h", "at", "own").union(strings)
    lists = stored(every.groupBy("doc", "h").agg(F.collect_list(F.struct("at", "own")).alias("gone")), "gone")
    discard(decided)
    discard(strings)
    whole = docs.select("doc_id", doc, h, text_of().alias("text"))
    joined = whole.join(lists, ["doc", "h"], "left")
    return joined.select(
        "doc_id", "text", F.col("gone.at").alias("spots"), F.col("gone.own").alias("owns")
    ).mapInPandas(_remove(with_bytes), OUT)


def report(docs: DataFrame) -> DataFrame:
    return removals(docs).drop("kept")
