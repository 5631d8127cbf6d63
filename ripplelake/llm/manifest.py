"""Merkle manifest of a dataset: an append log of tree nodes in postorder, and proofs read from it by position.

Every row is a leaf.  The leaves of a source, in order of doc_id, are hashed in runs of three, level by level, to the subroot of the
source; the subroots, in order of the source, likewise to the root.

Builders own aligned blocks of 3^depth consecutive leaves.  A builder writes its nodes when they are complete, each parent right after its last
child, so its log is the postorder of its subtree.  A node's place in that log follows from the sizes of the subtrees before it
(``place``), so siblings are read by address; nothing is searched and no tree is kept.  The roots of the blocks are the leaves of the
next layer of builders, which works the same way, until one node per source remains.  A block is one stored row of bounded size.

Going down again, each block is handed the siblings above it (two digests a level), reads those within its own log, and so has
the whole proof of each of its leaves, which it folds from the (possibly tampered) leaf to a root.

Nulls: a null field counts as ``-``; a null doc_id comes first and is never tampered with; a null source is a source of its own, the first.
Rows with equal source and doc_id are ordered by their leaf; equal rows are leaves of their own, side by side.  Texts of any length are
hashed by Spark in place.  An empty table gives no row.  Columns other than the five of a leaf are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelake.llm.common import numbered, stored

FAN = 3
#: Levels a builder covers: its block has at most 3^7 = 2,187 leaves, about 0.3 MB with all that belongs to them.
DEPTH = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# A subtree in postorder


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // FAN), height + 1
    return height


def place(level: int, index: int, leaves: int, height: int) -> int:
    """Where the node ``index`` of ``level`` stands in the log of a subtree.

    It covers the leaves below ``end``.  Before it are all nodes of its own and lower levels up to that end, and those of
    higher levels that were complete before its last leaf came.
    """
    end = min((index + 1) * FAN**level, leaves)
    upto = sum(-(-end // FAN**a) for a in range(level + 1))
    above = sum((end - 1) // FAN**a for a in range(level + 1, height + 1))
    return upto + above - 1


def append_log(leaves: list[str], height: int) -> list[str]:
    """Digests of a subtree in completion order; ``height`` may exceed what the leaves need, as in a last block."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(height + 1)]
    last = len(leaves) - 1
    for i, leaf in enumerate(leaves):
        log.append(leaf)
        node = leaf
        for level in range(height):
            open_runs[level].append(node)
            if len(open_runs[level]) < FAN and i < last:
                break
            node = digest("".join(open_runs[level]))
            open_runs[level] = []
            log.append(node)
    return log


def siblings(log: str, index: int, leaves: int, height: int) -> list[tuple[str, str]]:
    """Per level, the digests of a leaf's siblings to its left and to its right, read from the log by their places."""
    found = []
    for level in range(height):
        first = index - index % FAN
        count = -(-leaves // FAN**level)
        run = []
        for i in range(first, min(first + FAN, count)):
            at = HEX * place(level, i, leaves, height)
            run.append(log[at : at + HEX])
        found.append(("".join(run[: index - first]), "".join(run[index - first + 1 :])))
        index //= FAN
    return found


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


# The forest


def _built(entries: DataFrame, depth: int) -> DataFrame:
    """One row per block of ``depth`` levels: its log, and what belongs to its leaves.

    ``entries`` has ``tree, pos, leaves, digest, tampered, doc_id``.  A tree within one block ends where one node remains, otherwise its
    blocks all have the full height.
    """
    size = FAN**depth

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        leaves, total = part["digest"].tolist(), int(part["leaves"].iloc[0])
        height = height_of(total) if total <= size else depth
        log = append_log(leaves, height)
        return pd.DataFrame({
            "tree": [key[0]], "block": [key[1]], "height": [height], "blocks": [-(-total // size)], "log": ["".join(log)],
            "block_root": [log[-1]], "doc_ids": [part["doc_id"].tolist()], "no_ids": [part["no_id"].tolist()],
            "tampered": [part["tampered"].tolist()],
        })

    blocked = entries.select(
        "tree", F.expr(f"pos div {size}").alias("block"), "pos", "leaves", "digest", "tampered",
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
    )
    return stored(
        blocked.groupBy("tree", "block").applyInPandas(
            build,
            "tree string, block long, height int, blocks long, log string, block_root string, "
            "doc_ids array<long>, no_ids array<boolean>, tampered array<string>",
        ),
        "log",
    )


def _layers(entries: DataFrame, depth: int) -> list[DataFrame]:
    """Builders' rows, layer by layer, until every tree is one block.  The places of an upper layer are the blocks of the one below."""
    layers = []
    while True:
        blocks = _built(entries, depth)
        layers.append(blocks)
        if blocks.where("blocks > 1").limit(1).count() == 0:
            return layers
        entries = blocks.where("blocks > 1").select(
            "tree", F.col("block").alias("pos"), F.col("blocks").alias("leaves"), F.col("block_root").alias("digest"),
            F.lit(None).cast("string").alias("tampered"), F.col("block").alias("doc_id"),
        )


def _subroots(layers: list[DataFrame]) -> DataFrame:
    """What remains of each tree; small trees end in a lower layer than large ones."""
    ends = [blocks.where("blocks = 1").select("tree", F.col("block_root").alias("digest")) for blocks in layers]
    return reduce(DataFrame.unionByName, ends)


def _paths(handed: DataFrame) -> DataFrame:
    """The path of every leaf of these blocks up to the root: left and right siblings in turn."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                above = list(r.path)
                paths = [
                    [side for pair in siblings(r.log, i, len(r.doc_ids), r.height) for side in pair] + above
                    for i in range(len(r.doc_ids))
                ]
                yield pd.DataFrame({"tree": r.tree, "pos": r.doc_ids, "path": paths, "subroot": r.subroot, "root": r.root})

    return handed.select("tree", "log", "height", "doc_ids", "path", "subroot", "root").mapInPandas(
        read, "tree string, pos long, path array<string>, subroot string, root string"
    )


def _descend(layers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The blocks of the first layer with the paths above them.

    ``tops`` has ``tree, path, subroot, root``: what stands above the node that remains of each tree.
    """
    above = None
    for blocks in reversed(layers):
        handed = blocks.where("blocks = 1").join(tops, "tree")
        if above is not None:
            lower = blocks.where("blocks > 1").join(above.withColumnRenamed("pos", "block"), ["tree", "block"])
            handed = handed.unionByName(lower)
        above = None if blocks is layers[0] else stored(_paths(handed), "paths")
    return handed


# The manifest


def leaf_of(text: Column) -> Column:
    """The digest of a row with this text."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    values = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def is_tampered() -> Column:
    """Rows whose text loses its line feeds after the manifest was made."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row."""
    changed = is_tampered() & F.col("text").contains("\n")
    leaves = docs.select(
        # Sorts as the sources do, nulls first, and is never null.
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("tree"), "doc_id", leaf_of(F.col("text")).alias("digest"),
        F.when(changed, leaf_of(F.translate("text", "\n", ""))).alias("tampered"),
    )
    leaves = stored(leaves, "leaves").withColumn("row", F.monotonically_increasing_id())  # deals equal rows
    layers = _layers(numbered(leaves, "tree", ["doc_id", "digest", "row"], "pos", "leaves"), depth)

    subroots = _subroots(layers).select(F.lit("all").alias("tree"), F.col("tree").alias("source"), "digest")
    subroots = stored(numbered(subroots, "tree", ["source"], "pos", "leaves"), "subroots")
    top_layers = _layers(
        subroots.withColumns({"doc_id": F.col("pos"), "tampered": F.lit(None).cast("string")}), depth
    )
    root = _subroots(top_layers).select(
        "tree", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    paths = _paths(_descend(top_layers, root)).select("pos", "path", "root")
    names = subroots.select("pos", F.col("source").alias("tree"), F.col("digest").alias("subroot"))
    tops = stored(paths.join(names, "pos").select("tree", "path", "subroot", "root"), "tops")
    return _proofs(_descend(layers, tops))


def _proofs(handed: DataFrame) -> DataFrame:
    """Reads the proof of every leaf and folds it from the leaf as it is now."""

    def prove(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                above = list(zip(r.path[::2], r.path[1::2]))
                rows = []
                for i, (doc_id, no_id, tampered) in enumerate(zip(r.doc_ids, r.no_ids, r.tampered)):
                    at = HEX * place(0, i, len(r.doc_ids), r.height)
                    leaf = r.log[at : at + HEX]
                    path = siblings(r.log, i, len(r.doc_ids), r.height) + above
                    proof = digest("".join(left + right for left, right in path))
                    rows.append((None if no_id else doc_id, leaf, proof, fold(tampered or leaf, path)))
                found = pd.DataFrame(rows, columns=["doc_id", "leaf", "proof_sha256", "folded_root"])
                found["doc_id"] = found["doc_id"].astype("Int64")
                yield found.assign(subroot=r.subroot, root=r.root)

    proofs = handed.select("log", "height", "doc_ids", "no_ids", "tampered", "path", "subroot", "root").mapInPandas(
        prove, "doc_id long, leaf string, proof_sha256 string, folded_root string, subroot string, root string"
    )
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
