"""Text, time and display functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ripplelake.schema import ANONYMOUS_PREFIX, SITE_SUFFIX


def language_of(wiki: str) -> Column:
    """Site name without one trailing ``wiki``; other names stay as they are."""
    return F.expr(
        f"CASE WHEN endswith({wiki}, '{SITE_SUFFIX}') "
        f"THEN substring({wiki}, 1, length({wiki}) - {len(SITE_SUFFIX)}) ELSE {wiki} END"
    )


def is_anonymous(user: str) -> Column:
    return F.expr(f"{user} LIKE '{ANONYMOUS_PREFIX}%'")


def start_of(unit: str, ts: str) -> Column:
    """Start of the second, minute or hour."""
    return F.date_trunc(unit, ts)


def day_number(ts: str) -> Column:
    """``20240131``."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def month_number(ts: str) -> Column:
    """``202401``."""
    return F.date_format(ts, "yyyyMM").cast("int")


def seconds_between(start: str, end: str) -> Column:
    """Seconds from ``start`` to ``end``, both cut to whole seconds."""
    return F.unix_seconds(F.date_trunc("second", end)) - F.unix_seconds(F.date_trunc("second", start))


def readable_size(size: Column) -> Column:
    """``1536`` -> ``1.50 KiB``."""
    # Binary unit names, smallest first.
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]
    amount = size.cast("double")
    text = F.format_string("%.2f B", amount)
    for power, unit in enumerate(units[1:], start=1):
        scale = float(1024**power)
        text = F.when(amount >= scale, F.format_string(f"%.2f {unit}", amount / scale)).otherwise(text)
    return text
