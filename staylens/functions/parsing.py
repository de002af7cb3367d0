"""Guarded text -> typed casts.

Raw feeds are text. Spark runs with ANSI casts, so every conversion here is a
``try_*`` cast behind a shape guard: the guard pins the accepted text forms to
the documented contract, which keeps results identical to a SQL engine whose
lenient casts accept a different set of oddities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.schemas import MONEY

# Accepted text shapes.
ISO_DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
ISO_TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
OFFSET_TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}(:?\d{2})?$"
DMY_DATE_SHAPE = r"^\d{1,2}\.\d{1,2}\.\d{4}$"
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _guarded(text: Column, shape: str, cast_to: str) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(shape), trimmed.try_cast(cast_to))


def computed(df: DataFrame, keep: list, values: list[Column]) -> DataFrame:
    """``df`` with the columns ``keep`` and the aliased ``values``, each value
    worked out once a row. In a plain projection a later filter on them would be
    moved below it and parse the same text again for every place that names it."""
    return df.select(*keep, F.inline(F.array(F.struct(*values))))


def parse_date(c) -> Column:
    """ISO ``YYYY-MM-DD`` text to DATE; anything else is NULL."""
    return _guarded(_col(c), ISO_DATE_SHAPE, "date")


def parse_timestamp(c) -> Column:
    """ISO date-time text without zone to TIMESTAMP_NTZ."""
    return _guarded(_col(c), ISO_TIMESTAMP_SHAPE, "timestamp_ntz")


def parse_offset_timestamp(c) -> Column:
    """``YYYY-MM-DDTHH:MM:SS±HH[:MM]`` to the wall-clock TIMESTAMP_NTZ, the
    served value. ``Z``, a missing offset or fractional seconds make it NULL
    (the event becomes invalid); `offset_instant` keeps the offset.
    """
    text = F.trim(_col(c))
    wall = F.regexp_replace(F.substring(text, 1, 19), "T", " ")
    return F.when(text.rlike(OFFSET_TIMESTAMP_SHAPE), wall.try_cast("timestamp_ntz"))


def offset_instant(c) -> Column:
    """The same text as an instant (UTC, TIMESTAMP_NTZ), for ordering."""
    text = F.trim(_col(c))
    offset = F.substring(text, 20, 6)
    hours = F.substring(offset, 2, 2).try_cast("int")
    minutes = F.coalesce(F.nullif(F.regexp_replace(F.substring(offset, 4, 3), ":", ""), F.lit("")).try_cast("int"), F.lit(0))
    ahead = F.when(F.substring(offset, 1, 1) == "-", -1).otherwise(1) * (hours * 60 + minutes)
    return F.timestamp_add("MINUTE", -ahead, parse_offset_timestamp(c))


def parse_date_dmy(c) -> Column:
    """``DD.MM.YYYY`` (one-digit day/month allowed) to DATE."""
    trimmed = F.trim(_col(c))
    return F.when(trimmed.rlike(DMY_DATE_SHAPE), F.try_to_date(trimmed, "d.M.yyyy"))


def parse_money(c) -> Column:
    """Decimal text to an exact ``MONEY`` decimal; non-numeric text is NULL."""
    return _guarded(_col(c), NUMBER_SHAPE, MONEY.simpleString())


def blank_to_null(c) -> Column:
    """NULL for NULL, empty or blank-only text, else the trimmed text."""
    return F.nullif(F.trim(_col(c)), F.lit(""))
