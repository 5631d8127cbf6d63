"""Collapsing several versions or partial rows of one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripplelake.schema import NOT_ADDITIVE, SILVER_KEY, SILVER_NEWEST, SKETCH_BITS


def keep_latest(
    df: DataFrame, key: Sequence[str] = SILVER_KEY, newest: Sequence[str] = SILVER_NEWEST
) -> DataFrame:
    """One row per ``key``: the one with the greatest ``newest`` columns.

    ``row_number() = 1`` lets Spark keep only the first row of each key inside every map task, before
    the shuffle.  A key delivered a billion times sends one row per task, not a billion.
    """
    order = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in newest])
    return df.withColumn("_version", F.row_number().over(order)).where("_version = 1").drop("_version")


def sum_merge(df: DataFrame, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add up partial rows of one key; counts of distinct values are refused."""
    wrong = sorted(set(measures) & NOT_ADDITIVE)
    if wrong:
        raise ValueError(f"not additive, merge sketches instead: {', '.join(wrong)}")
    return df.groupBy(*key).agg(*[F.try_sum(m).alias(m) for m in measures])


def distinct_sketch(df: DataFrame, key: Sequence[str], columns: dict[str, str], bits: int = SKETCH_BITS) -> DataFrame:
    """Mergeable approximate sets per key: sketch name -> column.

    A sketch has 2^bits slots; the standard error of a count is 0.83 / sqrt(2^bits), 0.65 % for 14.  Small sets are counted nearly exactly.
    """
    return df.groupBy(*key).agg(*[F.hll_sketch_agg(c, bits).alias(n) for n, c in columns.items()])


def merge_sketches(df: DataFrame, key: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Approximate distinct counts over the merged sketches of each key: count name -> sketch."""
    return df.groupBy(*key).agg(*[F.hll_sketch_estimate(F.hll_union_agg(s)).alias(n) for n, s in names.items()])
