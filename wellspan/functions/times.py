"""Times written as ISO text, with up to nine digits of a second."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> tuple[Column, Column]:
    """(timestamp in microseconds, digits beyond them) of an ISO time; nulls if it can't be read."""
    rest = F.rpad(F.regexp_extract(text, r"\.\d{6}(\d{1,3})", 1), 3, "0")
    stamp = F.try_to_timestamp(F.regexp_replace(text, r"(\.\d{6})\d+", "$1"))
    return stamp, F.when(stamp.isNotNull(), F.coalesce(rest.try_cast("int"), F.lit(0)))


def has_offset(text: Column) -> Column:
    """Whether an ISO time names its offset from UTC."""
    return text.rlike(r"(Z|[+-]\d\d:?\d\d)$")


def seconds(time: Column) -> Column:
    """Seconds since the epoch of a timestamp."""
    return F.unix_micros(time.cast("timestamp")) / F.lit(1e6)


def text_seconds(text: Column) -> Column:
    """Seconds since the epoch of an ISO time, null if it can't be read."""
    stamp, rest = instant(text)
    return F.unix_micros(stamp) / F.lit(1e6) + rest / F.lit(1e9)


def progress(line: Column) -> Column:
    """(done, total, elapsed, eta) of a progress line such as ``3/12 [00:05<00:15``; null if it is none."""
    part = lambda i: F.regexp_extract(line, r"(\d+)/(\d+)\s*\[([\d:]+)<([\d:?]+)", i)
    whole = F.struct(part(1).try_cast("int").alias("done"), part(2).try_cast("int").alias("total"), part(3).alias("elapsed"), part(4).alias("eta"))
    return F.when(part(1) != "", whole)
