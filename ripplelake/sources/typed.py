"""The older design: five typed fields per message, a wrong type is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelake.functions import wire

_FIELDS = "title string, user string, bot variant, timestamp bigint, comment string, _mistyped string"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_mistyped"}


def typed_messages(stamped: DataFrame) -> DataFrame:
    """Stamped envelope plus the typed fields and ``_error``; missing fields take their default."""
    checked = wire.with_error(stamped)
    fields = F.from_json("raw_message", _FIELDS, _OPTIONS).alias("_fields")
    parsed = wire.spread(checked, F.struct(fields))
    kind = F.schema_of_variant("_fields.bot")
    number = F.try_variant_get("_fields.bot", "$", "bigint")
    bot = (
        F.when(F.col("_fields.bot").isNull() | (kind == "VOID"), 0)
        .when(kind == "BOOLEAN", number)
        .when((kind == "BIGINT") & number.between(0, 255), number)
        .cast("int")
    )
    error = (
        F.when(F.col("_error") != "", F.col("_error"))
        .when(F.col("_fields._mistyped").isNotNull() | bot.isNull(), "wrong type")
        .otherwise("")
    )
    return parsed.select(
        *[c for c in checked.columns if c != "_error"],
        F.coalesce("_fields.title", F.lit("")).alias("title"),
        F.coalesce("_fields.user", F.lit("")).alias("user"),
        F.coalesce(bot, F.lit(0)).alias("bot"),
        wire.epoch_to_timestamp("_fields.timestamp").alias("timestamp"),
        F.coalesce("_fields.comment", F.lit("")).alias("comment"),
        error.alias("_error"),
    )


def typed_events(checked: DataFrame) -> DataFrame:
    """Healthy rows of the older table."""
    return checked.where(F.length("_error") == 0).select(
        "title", "user", "bot", "timestamp", "comment", "ingested_at"
    )
