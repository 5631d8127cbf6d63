"""Repeated byte strings against a brute-force version, with batches, stretches and parts of all sizes."""

import collections
import hashlib
import random

import numpy as np
import pytest

from ripplelake.llm import suffix_dedup


def texts_with_repeats(n, seed):
    made = random.Random(seed)
    words = ["".join(made.choices("abdeilnorst", k=made.randrange(1, 9))) for _ in range(60)] + ["é", "ß" * 3, "\n"]
    texts = [None, "", "x" * 49, "x" * 50, "x" * 130, "ab" * 200]
    while len(texts) < n:
        text = " ".join(made.choices(words, k=made.randrange(1, 120)))
        for _ in range(made.randrange(4)):  # pieces of earlier texts, of lengths around 50, some with a changed letter
            other = texts[made.randrange(len(texts))] or ""
            at, size = made.randrange(len(other) + 1), made.choice([30, 45, 49, 50, 51, 55, 60, 75, 76, 77, 90, 150, 1000])
            piece = other[at : at + size]
            if made.random() < 0.3:
                piece = piece[: len(piece) // 2] + "#" + piece[len(piece) // 2 + 1 :]
            at = made.randrange(len(text) + 1)
            text = text[:at] + piece + text[at:]
        texts.append(made.choice([text, text, text, made.choice(texts)]))
    return texts


def plain(rows):
    first, out = {}, []
    for d, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], 2**63), d)
    for d, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("sizes", [{}, {"CHUNK": 70, "BATCH_BYTES": 3000, "BATCH_ROWS": 7, "PART_BYTES": 4000}])
def test_same_as_plain_without_anything_broadcast(spark, monkeypatch, sizes):
    """Nothing of fixed size, and nothing that all tasks hold, decides what is compared."""
    for name, size in sizes.items():
        monkeypatch.setattr(suffix_dedup, name, size)

    def refuse(value):
        raise AssertionError("broadcast")

    made = random.Random(3)
    rows = [(made.choice([i, i, i, i // 2, -i, 2**62 - i]), t) for i, t in enumerate(texts_with_repeats(150, 7))]
    made.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(spark.sparkContext, "broadcast", refuse)
    out = suffix_dedup.report(table).collect()
    assert collections.Counter(tuple(r) for r in out) == plain(rows)


def test_an_anchor_sends_a_few_bytes_once(spark):
    """One short entry per anchor, in as many parts as asked for."""
    texts = [t for t in texts_with_repeats(150, 8) if t and len(t.encode()) >= 50]
    table = spark.createDataFrame([(i, i, t, len(t.encode())) for i, t in enumerate(texts)], "doc long, h long, text string, size int")
    sent = [r for r in table.coalesce(1).mapInPandas(suffix_dedup._entries(2), suffix_dedup.ENTRIES).collect() if r.part >= 0]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    found = sum(len(a.at) for d in data for a in suffix_dedup.anchors(d, np.array([len(d)])))
    assert sum(r.n for r in sent) == found
    assert sum(len(r.sent) for r in sent) <= 18 * found + 8 * len(sent)
    assert {r.part for r in sent} == {0, 1, 2, 3}


def test_anchors_do_not_depend_on_stretches_or_neighbours(monkeypatch):
    texts = [(t or "").encode() for t in texts_with_repeats(60, 9)]

    def found(data, ends):
        return [tuple(map(int, x)) for a in suffix_dedup.anchors(data, ends) for x in zip(a.at, a.name, a.left, a.right, a.segment, a.first, a.last)]

    def alone():
        out, begin = [], 0
        for t in texts:
            out += [(x[0] + begin, *x[1:5], x[5] + begin, x[6] + begin) for x in found(np.frombuffer(t, np.uint8), np.array([len(t)]))]
            begin += len(t)
        return out

    whole = alone()
    together = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    assert found(*together) == whole
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    assert found(*together) == whole and alone() == whole
