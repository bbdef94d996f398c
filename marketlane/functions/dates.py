"""Dates that are stored as text, and ages relative to a given moment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slashed(c: Column) -> Column:
    return F.date_format(c, "yyyy/MM/dd")


def cutoff(as_of: str, days: int) -> Column:
    """``as_of`` less ``days``, as ``YYYY/MM/DD``: such texts compare as dates do."""
    return slashed(F.date_sub(F.lit(as_of).cast("date"), days))


def any_timestamp(c: Column) -> Column:
    """``YYYY/MM/DD [H:MM]``, else ISO; null for anything else."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy/MM/dd H:mm")), F.try_to_timestamp(c, F.lit("yyyy/MM/dd")), F.try_to_timestamp(c))


def micros(c: Column) -> Column:
    """Microseconds of a timestamp of either kind; only differences of these are used."""
    return F.unix_micros(c.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / 1_000_000


def whole_days(start: Column, end: Column, least: int = 0) -> Column:
    return F.greatest(F.lit(least), F.floor(seconds_between(start, end) / 86400)).cast("long")


def iso_plus_days(c: Column, days: Column) -> Column:
    """An ISO text moved by days; its offset stays as it is."""
    moved = F.to_timestamp(F.substring(c, 1, 19), "yyyy-MM-dd'T'HH:mm:ss") + F.make_dt_interval(days.cast("int"))
    return F.concat(F.date_format(moved, "yyyy-MM-dd'T'HH:mm:ss"), F.substring(c, 20, 10))


def iso_to_datetime(c: Column) -> Column:
    return F.replace(F.substring(c, 1, 19), F.lit("T"), F.lit(" "))
