"""Line dedup by a log-template tree.

Every line takes a fixed-depth path: number of tokens, then its ``DEPTH`` leading tokens; tokens with a digit are variable and read
``<*>``.  At the leaf, templates generalise further: of the tokens that follow, one third at a time may be variable, if
at least five constant tokens stay.  A template that occurs in ``least`` documents or more is recurring; so is a line of ``LONG`` words or
more that occurs word for word in two.  Its lines are dropped,
but for those of the document with the smallest doc_id that has it, so that no text is lost.  ``spare_copies`` lets the exact copies of a
text share its fate: where the text is the first with a template, its copies keep the line too, and the stages that judge whole documents
still find them equal; lines that another text had before go from all of them.

A line has at most four templates and the whole line, so work is linear in the lines; documents of a template are counted with partial sums, so a line in a third
of all documents is no heavier than another.  Hashes of templates are 64 bits wide.

Nulls: a null text has no line and stays null; a null doc_id is an id of its own, after all others.  Different texts under one id, or
without one, are documents of their own, ordered by the hash of the text.  Lines without a word are never
dropped.  Empty tables give no row.  Repeated rows (same id and text) lose the same lines.  Other columns are carried along under their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import spare_name, stored

DEPTH, CONSTANT = 2, 5
#: Rows that a worker holds before it passes them on; a batch of texts makes fifty times as many as it has.
ROWS = 32_768
#: Words from which a line that two documents have cannot be chance.
LONG = 50
VARIABLE = re.compile(rb"[^ ]*[0-9][^ ]*")


def templates(line: str) -> tuple[list[int], list[int]]:
    """Hashes of the templates of a line, the most constant first; none for a line without a word.  The second list has the
    hash of the line itself, if it is long."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    tokens = line.encode().split()
    if not tokens:
        return [], []
    joined = b" ".join(tokens)
    whole = [digest(b"=" + joined)] if len(tokens) >= LONG else []
    if VARIABLE.search(joined):
        joined = VARIABLE.sub(b"<*>", joined)
        tokens = joined.split(b" ")
    n = len(tokens)
    path = b"%d|" % n
    out = [digest(path + joined)]
    rest = n - DEPTH
    if rest >= 3:
        third = -(-rest // 3)
        if n - third >= CONSTANT:
            for k in range(3):
                a, b = DEPTH + k * third, min(n, DEPTH + (k + 1) * third)
                if a < b:
                    out.append(digest(path + b"%d|" % k + b" ".join(tokens[:a]) + b"|" + b" ".join(tokens[b:])))
    return out, whole


LINES = "h long, doc_id long, at int, key long, whole boolean"


def _lines(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame() -> pd.DataFrame:
        return pd.DataFrame(
            {"h": np.array(h, np.int64), "doc_id": np.array(ids, np.int64), "at": np.array(at, np.int32),
             "key": np.array(keys, np.uint64).view(np.int64), "whole": np.array(exact, bool)}
        )

    h, ids, at, keys, exact = [], [], [], [], []
    for part in parts:
        for one, doc_id, text in zip(part["h"].tolist(), part["doc_id"].tolist(), part["text"]):
            if text is None:
                continue
            for i, line in enumerate(text.split("\n")):
                general, whole = templates(line)
                for key in general + whole:
                    h.append(one)
                    ids.append(doc_id)
                    at.append(i)
                    keys.append(key)
                exact += [False] * len(general) + [True] * len(whole)
                if len(keys) >= ROWS:
                    yield frame()
                    h, ids, at, keys, exact = [], [], [], [], []
    yield frame()


def drops(docs: DataFrame, least: int, spare_copies: bool) -> DataFrame:
    """``doc_id, h, at``: the numbers of the lines that go, per document (h: the hash of its text)."""
    rows = docs.where("text IS NOT NULL").select(
        F.xxhash64("text").alias("h"), F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).cast("long").alias("doc_id"), "text"
    )
    lines = stored(rows.mapInPandas(_lines, LINES), "lines")
    # Per document and template one row, then counts; a hash of both spreads the work evenly.
    once = lines.select("key", "whole", "doc_id", "h").distinct()
    first = F.min(F.struct("doc_id", "h")).alias("first")
    enough = F.when(F.col("whole"), min(2, least)).otherwise(least)
    counted = once.groupBy("key", "whole").agg(F.count("*").alias("n"), first).where(F.col("n") >= enough)
    recurring = stored(counted, "recurring")
    is_first = F.col("h") == F.col("first.h")
    if not spare_copies:
        is_first &= F.col("doc_id") == F.col("first.doc_id")
    # Both sides are tables of the corpus, not small ones: neither join is left to a guess at their size.
    hits = lines.join(recurring.hint("merge"), ["key", "whole"]).where(~is_first).select("doc_id", "h", "at")
    return stored(hits.groupBy("doc_id", "h").agg(F.collect_set("at").alias("at")), "drops")


def dedup(docs: DataFrame, least: int = 10, spare_copies: bool = True, dropped: str | None = None) -> DataFrame:
    """The documents without their recurring lines, columns as they were; ``dropped`` names an extra column for their number."""
    gone = drops(docs, least, spare_copies)
    names = [spare_name(docs, n) for n in ("gone_id", "gone_h", "gone_at")]
    gone = gone.toDF(*names)
    match = (F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)) == F.col(names[0])) & (F.xxhash64("text") == F.col(names[1]))
    joined = docs.join(gone.hint("merge"), match, "left")
    at = F.col(names[2])
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(at, i)), "\n")
    out = joined.withColumn("text", F.when(at.isNull(), F.col("text")).otherwise(kept))
    if dropped:
        out = out.withColumn(dropped, F.coalesce(F.size(at), F.lit(0)).cast("long"))
    return out.drop(*names)


def report(docs: DataFrame, least: int = 10) -> DataFrame:
    return dedup(docs.select("doc_id", "text"), least, dropped="n_dropped")
