"""Hour and day parts used by the reporting views.

Inputs are ``TIMESTAMP_NTZ`` wall-clock values (or UTC timestamps); outputs keep
the wall-clock reading, independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hour_of(ts: Column | str) -> Column:
    """Hour of day, 0-23, as int."""
    return F.hour(_c(ts)).cast("int")


def hour_start(ts: Column | str) -> Column:
    """The timestamp floored to the hour, as ``TIMESTAMP_NTZ``.

    Minutes and seconds are subtracted from the wall-clock reading: ``date_trunc`` would
    go through the session zone and move hours that a clock change skips.
    """
    t = _c(ts).cast("timestamp_ntz")
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t), F.extract(F.lit("SECOND"), t))


def hour_string(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:00:00`` — the hour as text."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:00:00")


def day_string(ts: Column | str) -> Column:
    """``yyyy-MM-dd`` — the day as text."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def to_day(ts: Column | str) -> Column:
    """Calendar date of the timestamp."""
    return F.to_date(_c(ts))
