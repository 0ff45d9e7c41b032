"""Scalar column functions: offset buckets and epoch times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_SIZE = 1000

# Epoch seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def offset_bucket(offset: Column | str, size: int = BUCKET_SIZE) -> Column:
    """First offset of the bucket that holds ``offset``, as bigint."""
    col = F.col(offset) if isinstance(offset, str) else offset
    return col.cast("bigint") - F.pmod(col.cast("bigint"), F.lit(size).cast("bigint"))


def epoch_to_ts(seconds: Column | str) -> Column:
    """Epoch seconds to a timestamp, fraction cut toward zero; null beyond years 1-9999."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    whole = col.try_cast("bigint")
    return F.when(whole.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(whole))
