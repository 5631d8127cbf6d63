"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, pairs of neighbours and pairs with one word between them, lower-cased, hashed into 2^20
places; each counts once a text.  FTRL-proximal gives every coordinate its own learning rate and, by its L1 term, weights that are
exactly zero unless a feature keeps helping.  What is left is a compact table that is broadcast to score every whole text.

The fit sees a bounded sample of the labelled rows: at most ``sample_rows`` of either label, the ones with the smallest hash of
their doc_id, so it does not depend on the partitioning.  It runs in one task over their features only (a few MB at any size of
the corpus).  Scoring covers all rows.

Nulls: a null text has no feature and gets the score of an empty text; a row without a doc_id is not held out, and not learned from.  Rows of ``labels`` with a null doc_id or label are not
used.  Empty tables: without labels every score is 0.5; without documents no row.  Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = 20
ALPHA, BETA, L1, L2, ROUNDS = 1.0, 1.0, 25.0, 0.1, 4
#: Labelled rows of either label that the fit sees at most.
SAMPLE = 12_000


class Features:
    """Places of a text's features.  Words are hashed once and remembered; pairs are made of their hashes."""

    def __init__(self, places: int = PLACES, remember: int = 500_000):
        self.shift, self.known, self.remember = np.uint64(64 - places), {}, remember

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = (text or "").lower().split()
        if len(self.known) > self.remember:
            self.known.clear()
        known = self.known
        for w in [w for w in set(words) if w not in known]:
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        odd = np.uint64(0x9E3779B97F4A7C15)
        pairs = h[:-1] * odd + h[1:] * np.uint64(3)
        skips = h[:-2] * odd + h[2:] * np.uint64(5)
        every = np.concatenate([h, pairs, skips]) * odd
        return np.unique((every >> self.shift).astype(np.uint32))


def fit(rows: list[tuple[int, np.ndarray]], places: int = PLACES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal: places and values of the weights that are not zero, and the bias.

    The bias is a coordinate of its own without L1.  Rows of the rarer label weigh more, so that both have the same total.
    """
    z, n = np.zeros((1 << places) + 1), np.zeros((1 << places) + 1)
    bias = 1 << places
    toxic = sum(y for y, _ in rows)
    share = {1: len(rows) / max(2 * toxic, 1), 0: len(rows) / max(2 * (len(rows) - toxic), 1)}

    def weights(at):
        small = np.abs(z[at]) <= L1
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[small] = 0.0
        w[at == bias] = -z[bias] / ((BETA + np.sqrt(n[bias])) / ALPHA + L2)
        return w

    rng = np.random.default_rng(1)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            y, found = rows[i]
            at = np.append(found.astype(np.int64), bias)
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30)))
            g = (p - y) * share[y]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    at = np.flatnonzero((np.abs(z[:bias]) > L1))
    return at.astype(np.int32), weights(at.astype(np.int64)), float(weights(np.array([bias]))[0])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Fitted on rows that are not held out.  Only the weights come to the driver."""
    marks = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    some = None
    for label in (0, 1):
        part = marks.where(F.col("toxic") == label).orderBy("order", "doc_id").limit(sample_rows)
        some = part if some is None else some.union(part)
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text").join(F.broadcast(some), "doc_id")  # 2 x SAMPLE short rows

    def featurise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for part in parts:
            places = [features(t).astype(np.int32).tolist() for t in part["text"]]
            yield pd.DataFrame({"order": part["order"], "doc_id": part["doc_id"], "toxic": part["toxic"], "places": places})

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["order", "doc_id", "toxic"]).drop_duplicates("doc_id")
        rows = [(int(y), np.array(p, np.int64)) for y, p in zip(part["toxic"], part["places"])]
        at, w, bias = fit(rows)
        return pd.DataFrame({"at": [at.tolist()], "w": [w.tolist()], "bias": [bias]})

    sampled = known.select("order", "doc_id", "toxic", "text").mapInPandas(
        featurise, "order long, doc_id long, toxic int, places array<int>"
    )
    found = sampled.groupBy(F.expr("0L + 0L").alias("all")).applyInPandas(learn, "at array<int>, w array<double>, bias double").collect()
    if not found:
        return np.zeros(0, np.int32), np.zeros(0), 0.0
    return np.array(found[0].at, np.int32), np.array(found[0].w), found[0].bias


def scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # non-zero weights only, at most 2^20

    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, bias = sent.value
        dense = np.zeros(1 << PLACES)
        dense[at] = w
        features = Features()
        for column in columns:
            total = np.array([bias + dense[features(t)].sum() for t in column])
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))))

    scored = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.pandas_udf(score, "double")("text").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(docs, train(docs, labels))
