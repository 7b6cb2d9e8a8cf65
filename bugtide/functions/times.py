"""Timestamps and durations. A timestamp column is a UTC ``timestamp_ntz``, so
no result depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import text as tx

_ZONED = r":[0-9]{2}.*(Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})$"
_EPOCH = "timestamp_ntz '1970-01-01 00:00:00'"


def _from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH))


def from_instant(moment: Column) -> Column:
    """UTC wall-clock time of a zoned timestamp."""
    return _from_micros(F.unix_micros(moment))


def parse_utc(raw: Column) -> Column:
    """Parse ISO 8601 text, or one of the listed layouts; otherwise null.

    Text with an offset is converted to UTC, text without one is taken as UTC.
    """
    cleaned = tx.strip(raw)
    zoned = from_instant(cleaned.try_cast("timestamp"))
    local = cleaned.try_cast("timestamp_ntz")
    iso = F.when(cleaned.rlike(_ZONED), zoned).otherwise(local)
    # An offset is appended so that the session time zone plays no part.
    other = [
        from_instant(
            F.try_to_timestamp(F.concat(cleaned, F.lit(" +00:00")), F.lit(f"{layout} XXX"))
        )
        for layout in v.TIMESTAMP_FORMATS
    ]
    return F.coalesce(iso, *other)


def from_epoch_seconds(raw: Column) -> Column:
    """Epoch seconds held as text; null where the text is not a number."""
    seconds = tx.strip(raw).try_cast("double")
    return _from_micros(F.round(seconds * 1_000_000).try_cast("bigint"))


def elapsed_days(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``; null if either is missing.

    Goes through the interval between the two. The timestamp difference function
    would first read both in the session time zone and so shift wall-clock times
    that a change to summer time skips there.
    """
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint") / F.lit(86_400_000_000.0)


def whole_days(start: Column, end: Column) -> Column:
    """Completed 24-hour periods, rounded towards minus infinity."""
    return F.floor(elapsed_days(start, end)).cast("double")
