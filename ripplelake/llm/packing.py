"""Packs documents into training sequences by lexical retrieval.

Every document becomes token ids and an end id.  Full windows are sequences of their own; what remains of each document
(fewer ids than a window) is a unit of a BM25 index over token ids.  The index is sharded: units are routed by their most telling tokens, so
shards hold related units, and each task indexes its shards, a bounded number of units at a time.  A unit that is not yet used seeds a
sequence; the index returns its unused neighbours, best first, which fill the window.  The last one is cut where the
window ends and its remainder seeds the next sequence.  What is left at the end of a task is cut into sequences whose lengths are powers of
two, so nothing is padded.

Document frequencies cover all units; there are as many as token ids, which bounds what is broadcast.

Nulls: a null text is an empty one, which is its end id alone; a null doc_id is carried along.  An empty table gives no row.  Repeated rows are
documents of their own.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import stored, text_of
from ripplelake.llm.tokens import _encoder, batches, id_type, vocabulary

WINDOW, END = 2048, 1
#: Units that one index holds.
SHARD = 2048
K1, B = 1.2, 0.75
#: A term is common in an index where more than one of so many units has it.
COMMON = 8

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut(path: str, window: int, kind: str):
    """Full windows as finished pieces; the remainder with its ids, as numbers of the given kind."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder, number, made = _encoder(path), TaskContext.get().partitionId(), 0
        for part in parts:
            ids_of = iter(part["doc_id"].tolist())
            for texts in batches(part["text"].tolist()):
                rows = []
                for ids in encoder.ids(texts):
                    doc_id = next(ids_of)
                    ids = np.append(ids, np.uint32(END))
                    n = len(ids)
                    for start in range(0, n - n % window, window):
                        rows.append((doc_id, start, window, _crc(ids[start : start + window]), n, ((number << 33) + made) * 2, 0, None))
                        made += 1
                    if n % window:
                        rest = ids[n - n % window :]
                        rows.append((doc_id, n - len(rest), len(rest), None, n, None, None, rest.astype(kind).tobytes()))
                frame = pd.DataFrame(rows, columns=[*NAMES, "ids"])
                yield frame.astype({c: "Int64" for c in NAMES})

    return cut


def _terms(units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of all units, by unit and ascending: whose they are, which, and how often each occurs."""
    ids = np.concatenate(units) if units else np.zeros(0, np.uint16)
    number, bits = (np.uint32, 16) if ids.dtype.itemsize == 2 and len(units) <= 1 << 16 else (np.uint64, 32)
    keys = ids.astype(number)
    keys |= np.repeat(np.arange(len(units), dtype=number) << number(bits), [len(u) for u in units])
    keys.sort()
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts, keys = np.diff(starts, append=len(keys)), keys[starts]
    return (keys >> number(bits)).astype(np.int64), (keys & number((1 << bits) - 1)).astype(np.int64), counts


def _some(ids: pd.Series, kind: str, most: int = 512) -> Iterator[list[np.ndarray]]:
    """Units, so many at a time."""
    for at in range(0, len(ids), most):
        yield [np.frombuffer(raw, kind) for raw in ids.iloc[at : at + most]]


def _frequencies(parts: Iterator[pd.DataFrame], kind: str = "<u4") -> Iterator[pd.DataFrame]:
    total = np.zeros(0, np.int64)
    for part in parts:
        for units in _some(part["ids"], kind):
            found = np.bincount(_terms(units)[1], minlength=len(total))
            found[: len(total)] += total
            total = found
    at = np.flatnonzero(total)
    yield pd.DataFrame({"term": at.astype(np.int64), "n": total[at]})


class Weights:
    """BM25 over all units."""

    def __init__(self, n: int, mean: float, terms: np.ndarray, counts: np.ndarray):
        self.mean = max(mean, 1.0)
        self.idf = np.zeros(int(terms.max()) + 1 if len(terms) else 1, np.float32)
        self.idf[terms] = np.log(1 + (n - counts + 0.5) / (counts + 0.5))

    def of(self, units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct terms of all units: whose they are, which, and their impacts."""
        owner, terms, tf = _terms(units)
        tf = tf.astype(np.float32)
        sizes = np.array([len(u) for u in units], np.int64)
        norm = (K1 * (1 - B + B * sizes / self.mean)).astype(np.float32)
        return owner, terms, self.idf[terms] * tf * np.float32(K1 + 1) / (tf + norm[owner])


def _route(sent, kind: str = "<u4"):
    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = Weights(*sent.value)
        for part in parts:
            best: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            for units in _some(part["ids"], kind):
                owner, terms, impact = weights.of(units)
                starts = np.searchsorted(owner, np.arange(len(units)))
                for one in best:  # the weightiest, then the next; the smaller of equals
                    top = np.flatnonzero(impact == np.maximum.reduceat(impact, starts)[owner])
                    top = top[np.append(True, owner[top[1:]] != owner[top[:-1]])]
                    one.append(terms[top])
                    alone = np.diff(starts, append=len(owner)) == 1
                    impact[top[~alone]] = -1
            yield part.assign(first=np.concatenate(best[0]), second=np.concatenate(best[1]))

    return route


class Packer:
    """Fills windows from one shard after the other; an open window is carried on."""

    def __init__(self, weights: Weights, window: int, number: int):
        self.weights, self.window, self.number, self.made = weights, window, number, 0
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.room = window
        self.rows: list[tuple] = []

    def put(self, unit: tuple) -> tuple | None:
        """Adds as much of the unit as fits; returns what is left of it."""
        doc_id, start, ids, n = unit
        self.open.append((doc_id, start, ids[: self.room], n))
        left = (doc_id, start + self.room, ids[self.room :], n) if len(ids) > self.room else None
        self.room -= len(self.open[-1][2])
        if not self.room:
            self.close()
        return left

    def close(self) -> None:
        sequence, offset = ((self.number << 33) + self.made) * 2 + 1, 0
        for doc_id, start, ids, n in self.open:
            self.rows.append((doc_id, start, len(ids), _crc(ids), n, sequence, offset))
            offset += len(ids)
        self.made, self.open, self.room = self.made + 1, [], self.window

    def shard(self, units: list[tuple]) -> None:
        owner, terms, impacts = self.weights.of([u[2] for u in units])
        begins = np.searchsorted(owner, np.arange(len(units) + 1))
        mine = terms
        order = np.argsort(terms, kind="stable")
        terms, owner, impacts = terms[order], owner[order], impacts[order]
        starts = np.searchsorted(terms, np.arange(len(self.weights.idf) + 1))
        # Terms that many units have are scored for all seeds at once (not in far larger indexes: a score per pair), the others term by term.
        # Impacts are of single precision, so that their sums in double precision do not depend on the order.
        many = (np.diff(starts) > max(len(units) // COMMON, 8)) & (len(units) <= 2 * SHARD)
        common = np.flatnonzero(many)
        table = np.zeros((len(common), len(units)))
        spots = np.flatnonzero(many[terms])
        table[np.searchsorted(common, terms[spots]), owner[spots]] = impacts[spots]
        shared = (table > 0).T.astype(np.float64) @ table
        unused = np.ones(len(units), bool)
        at = 0

        def neighbours(seed: int) -> np.ndarray:
            """Scores of the unused units over all terms of the seed."""
            its = mine[begins[seed] : begins[seed + 1]]
            its = its[~many[its]]
            a, n = starts[its], starts[its + 1] - starts[its]
            spots = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
            scores = shared[seed] + np.bincount(owner[spots], impacts[spots], len(units))
            scores[~unused] = 0
            return scores

        while at < len(units):
            if not unused[at]:
                at += 1
                continue
            seed, unused[at] = at, False
            left = self.put(units[seed])
            while left:  # a unit longer than the room goes on in the next window
                left = self.put(left)
            while self.open:
                scores, hits = neighbours(seed), 0
                while scores[i := int(scores.argmax())] > 0:  # best first, the first of equals
                    unused[i], scores[i], hits = False, 0, hits + 1
                    left = self.put(units[i])
                    seed = i
                    if left or not self.open:
                        break
                if left:
                    while left:
                        left = self.put(left)
                    continue  # the remainder seeds the next window
                if not hits:
                    break  # nothing related: the next unit in route order goes on in the open window

    def finish(self) -> None:
        """Cuts what is open into sequences whose lengths are powers of two."""
        pieces = self.open
        total = self.window - self.room
        self.open = []
        for bit in reversed(range(total.bit_length())):
            if total >> bit & 1:
                self.open, self.room = [], 1 << bit
                while self.room:
                    doc_id, start, ids, n = pieces.pop(0)
                    self.open.append((doc_id, start, ids[: self.room], n))
                    if len(ids) > self.room:
                        pieces.insert(0, (doc_id, start + self.room, ids[self.room :], n))
                    self.room -= len(self.open[-1][2])
                self.close()
        self.open, self.room = [], self.window

    def take(self) -> pd.DataFrame:
        frame = pd.DataFrame(self.rows, columns=NAMES).astype({"doc_id": "Int64"})
        self.rows = []
        return frame


def _pack(sent, window: int, shard: int, kind: str = "<u4"):
    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        packer, units = Packer(Weights(*sent.value), window, TaskContext.get().partitionId()), []
        for part in parts:
            for doc_id, start, n, raw in zip(part["doc_id"].tolist(), part["start"].tolist(), part["doc_tokens"].tolist(), part["ids"]):
                units.append((None if pd.isna(doc_id) else int(doc_id), start, np.frombuffer(raw, kind), n))
                if len(units) == shard:
                    packer.shard(units)
                    units = []
                    yield packer.take()
        if units:
            packer.shard(units)
        packer.finish()
        yield packer.take()

    return pack


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    path = path or vocabulary()
    kind = id_type(path)
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of().alias("text"))
    cut = stored(rows.mapInPandas(_cut(path, window, kind), PIECES + ", ids binary"), "units")
    units = cut.where("ids IS NOT NULL")
    n, total = units.agg(F.count("*"), F.sum("length")).first()
    counted = units.select("ids").mapInPandas(lambda parts: _frequencies(parts, kind), "term long, n long")
    terms = counted.groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row per token id
    sent = spark.sparkContext.broadcast(
        (n, (total or 0) / max(n, 1), np.array([t.term for t in terms], np.int64), np.array([t.n for t in terms], np.int64))
    )
    kept = units.select("doc_id", "start", "doc_tokens", "ids")
    routed = kept.mapInPandas(_route(sent, kind), "doc_id long, start long, doc_tokens long, ids binary, first long, second long")
    shards = max(1, -(-n // shard))
    dealt = routed.repartitionByRange(shards, "first", "second", "doc_id", "start")
    dealt = dealt.sortWithinPartitions("first", "second", "doc_id", "start")
    packed = dealt.drop("first", "second").mapInPandas(_pack(sent, window, shard, kind), PIECES)
    return cut.where("ids IS NULL").select(*NAMES).union(packed)
