"""Filters and report shapes used by the query catalogue."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AsOf = Column | str | dt.datetime | None


def moment(as_of: AsOf) -> Column:
    """The reference time of a report; the current time where none is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def trailing(df: DataFrame, column: str, span: str, as_of: AsOf = None, inclusive: bool = True) -> DataFrame:
    """Rows of the last ``span`` (such as ``24 HOURS``) before ``as_of``.

    Where the table has day partitions the range is repeated on them, so old days are not read.
    """
    start = moment(as_of) - F.expr(f"INTERVAL {span}")
    kept = df.where(F.col(column) >= start if inclusive else F.col(column) > start)
    for day in ("event_date", "ingest_date"):
        if day in df.columns and (day == "ingest_date") == (column == "ingested_at"):
            kept = kept.where(F.col(day) >= F.to_date(start))
    return kept


def between_hours(df: DataFrame, low: AsOf, high: AsOf, column: str = "hour") -> DataFrame:
    """The time filter of a dashboard, both ends included."""
    kept = df.where(F.col(column).between(moment(low), moment(high)))
    if "event_date" in df.columns:
        kept = kept.where(F.col("event_date").between(F.to_date(moment(low)), F.to_date(moment(high))))
    return kept


def top(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The ``n`` greatest rows; ``ties`` make the choice repeatable."""
    return df.orderBy(F.desc(by), *ties).limit(n)


def top_counts(df: DataFrame, by: Sequence[str], n: int, name: str = "edits") -> DataFrame:
    """The ``n`` most frequent values."""
    return top(df.groupBy(*by).agg(F.count("*").alias(name)), n, name, *by)


def top_sums(df: DataFrame, by: Sequence[str], measure: str, n: int, name: str) -> DataFrame:
    return top(df.groupBy(*by).agg(F.sum(measure).alias(name)), n, name, *by)


def top_per_group(df: DataFrame, group: Sequence[str], by: str, ties: Sequence[str], k: int) -> DataFrame:
    """The ``k`` greatest rows of every group, with their rank.

    Each map task keeps at most ``k`` rows per group before the shuffle, so one huge group is no problem.
    """
    order = Window.partitionBy(*group).orderBy(F.desc(by), *ties)
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def share_of_total(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per value and their percentage of all rows.

    The total is a scalar subquery over the counts, so the counts stay distributed however many there are.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pct", F.round(F.col("cnt") * F.lit(100.0) / total, 2))


def buckets(df: DataFrame, unit: str, column: str, name: str) -> DataFrame:
    """Rows per second, minute or hour."""
    return df.groupBy(F.date_trunc(unit, column).alias(unit)).agg(F.count("*").alias(name))


def over_limit(df: DataFrame, metric: str, limit: int) -> DataFrame:
    """Rows that raise an alert."""
    return df.where(F.col(metric) > limit)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("t"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
