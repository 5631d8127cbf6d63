"""Splitting healthy from broken messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelake.schema import BRONZE, BROKEN_MESSAGE_BUDGET, ERRORS

POLICIES = ("fail", "split", "dead_letters")


class BrokenMessages(RuntimeError):
    """More broken messages than the policy allows."""


def healthy(checked: DataFrame) -> DataFrame:
    return checked.where(F.length("_error") == 0).select(*BRONZE.columns.fieldNames())


def broken(checked: DataFrame) -> DataFrame:
    return checked.where(F.length("_error") > 0).select(
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "raw_message",
        F.col("_error").alias("error_message"),
        "ingested_at",
    )


def stop_on_error(checked: DataFrame) -> DataFrame:
    """Policy ``fail``: the job fails on the first broken message."""
    message = F.concat(F.lit("broken message: "), F.col("_error"))
    stop: Column = F.when(F.length("_error") > 0, F.raise_error(message).cast("string"))
    return checked.withColumn("_error", F.coalesce(stop, F.lit("")))


def broken_budget(checked: DataFrame, limit: int = BROKEN_MESSAGE_BUDGET) -> DataFrame:
    """One row: messages, broken ones, and whether they exceed ``limit``."""
    count = F.count_if(F.length("_error") > 0)
    return checked.agg(
        F.count("*").alias("messages"), count.alias("broken"), (count > limit).alias("over_budget")
    )


def enforce_budget(checked: DataFrame, limit: int = BROKEN_MESSAGE_BUDGET) -> None:
    """Raise where a batch holds more than ``limit`` broken messages."""
    row = broken_budget(checked, limit).first()
    if row["over_budget"]:
        raise BrokenMessages(f"{row['broken']} of {row['messages']} messages are broken, limit {limit}")


def preview(errors: DataFrame, chars: int = 200) -> DataFrame:
    """Error rows with the start of the message only."""
    kept = [c for c in ERRORS.columns.fieldNames() if c != "raw_message"]
    return errors.select(*kept, F.substring("raw_message", 1, chars).alias("raw_preview"))
