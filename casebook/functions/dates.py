"""Tolerant date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cast accepts more than ISO-8601 (bare times, padded years), so it is gated.
_ISO = (
    r"^\d{4}(-\d{2}(-\d{2}(T\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2})?)?)?)?)?$"
)
# Hours without minutes are ISO but not castable; minutes are added first.
_HOUR_ONLY = r"(T\d{2})(Z|[+-]\d{2}(?::?\d{2})?)?$"
STAMP = "yyyy-MM-dd HH:mm:ss"
US_DATE = r"^\d{1,2}/\d{1,2}/\d{4}"


def iso_timestamp(raw: Column) -> Column:
    """ISO-8601 date or date-time, null for anything else."""
    padded = F.regexp_replace(F.replace(raw, F.lit(","), F.lit(".")), _HOUR_ONLY, "$1:00$2")
    return F.when(raw.rlike(_ISO), padded.try_cast("timestamp"))


def event_timestamp(raw: Column, us_dates: bool = False) -> Column:
    """ISO first, then the first ten characters as a date.

    US dates stay null unless ``us_dates`` asks for them.
    """
    head = F.substring(raw, 1, 10)
    day = F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), head.try_cast("timestamp"))
    tries = [iso_timestamp(raw), day]
    if us_dates:
        us = F.regexp_extract(raw, US_DATE, 0)
        tries.append(F.try_to_timestamp(us, F.lit("M/d/yyyy")))
    return F.coalesce(*tries)


def stamp(moment: Column) -> Column:
    """One fixed text form for every date that leaves as text."""
    return F.date_format(moment, STAMP)


def iso_millis(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
