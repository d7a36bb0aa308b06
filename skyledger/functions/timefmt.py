"""Date/time column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_instant_to_ts(s: Column) -> Column:
    """ISO-8601 instant with or without fraction and zone -> TIMESTAMP cut to seconds.

    A bare local time (no zone) is read in the session zone (UTC); text that is no instant
    gives null (it must not stop a stream)."""
    return F.date_trunc("second", s.try_cast("timestamp"))


def iso_instant_text(ts: Column) -> Column:
    """UTC instant text ``yyyy-MM-ddTHH:mm:ss.SSSSSSZ`` (session zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def month_bucket(day: Column) -> Column:
    """``yyyyMM``."""
    return F.date_format(day, "yyyyMM")


def run_instant(spark) -> Column:
    """one ingestion instant per run, taken once on the driver and used as a
    literal, so every layer written by the run carries the same stamp. Kept at
    microsecond precision so a later run never ties with an earlier one."""
    import datetime as _dt
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(now.isoformat(sep=" ", timespec="microseconds")).cast("timestamp")
