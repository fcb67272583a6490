"""Timestamp expressions. All of them assume the session time zone UTC; see :func:`use_utc`."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pressgrid.functions.text import blank_to_null

# The layouts in which sources write timestamps, and the bucket sizes of a series.
SEEN_DATE = "yyyyMMdd'T'HHmmss'Z'"
COMPACT_SECOND = "yyyyMMddHHmmss"
COMPACT_DAY = "yyyyMMdd"
ISO_SECOND = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROSECOND = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
BUCKET_SIZES = ("minute", "hour", "day")

# A full ISO date with an optional time and zone; ``cast`` alone would also take "2024" or "T10:00".
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC, on which parsing, bucketing and formatting rely."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def seen_timestamp(col: Column, strict: bool = True) -> Column:
    """``20240131T235959Z`` as a timestamp; empty is null, and a malformed value fails unless lenient."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    layout = SEEN_DATE if strict else F.lit(SEEN_DATE)
    return parse(blank_to_null(col), layout)


def timeline_timestamp(col: Column) -> Column:
    """A timeline date in any of the compact layouts or in ISO form; null when it fits none.

    Only a layout of the value's own length is tried, since a failed attempt costs an exception.
    """
    attempt = F.when(col.rlike(_ISO), col.try_cast("timestamp"))
    for layout in (SEEN_DATE, COMPACT_SECOND, COMPACT_DAY):
        digits = len(layout.replace("'", ""))
        attempt = F.when(
            (F.length(col) == digits) & ~col.contains("-"), F.try_to_timestamp(col, F.lit(layout))
        ).otherwise(attempt)
    return attempt


def bucket(col: Column, size: str) -> Column:
    """Start of the minute, hour or day holding the timestamp."""
    if size not in BUCKET_SIZES:
        raise ValueError(f"bucket size must be one of {', '.join(BUCKET_SIZES)}, not {size!r}")
    return F.date_trunc(size, col.cast("timestamp"))


def iso_utc(col: Column) -> Column:
    """ISO text ending in Z, with microseconds only where there are any."""
    ts = col.cast("timestamp")
    whole = F.unix_micros(ts) % F.lit(1_000_000) == 0
    return F.when(whole, F.date_format(ts, ISO_SECOND)).otherwise(F.date_format(ts, ISO_MICROSECOND))


def compact_second(col: Column) -> Column:
    """``yyyyMMddHHmmss`` text, cut to the second."""
    return F.date_format(col.cast("timestamp"), COMPACT_SECOND)
