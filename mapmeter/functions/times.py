"""Time-zone-aware buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _local_bucket(unit: str, ts: Column, tz: str) -> Column:
    return F.to_utc_timestamp(F.date_trunc(unit, F.from_utc_timestamp(ts, tz)), tz)


def bucket_hour(ts: Column, tz: str = "UTC") -> Column:
    """Start of the local hour, as an instant.

    The two local hours of the autumn clock change stay apart: the hour is cut on the instant, shifted
    only by the part of the zone's offset that is not a whole hour.
    """
    offset = F.unix_seconds(F.from_utc_timestamp(ts, tz)) - F.unix_seconds(ts)
    odd = F.pmod(offset, F.lit(3600))
    return F.timestamp_seconds(F.floor((F.unix_seconds(ts) + odd) / 3600) * 3600 - odd)


def bucket_day(ts: Column, tz: str = "UTC") -> Column:
    return _local_bucket("DAY", ts, tz)


def bucket_month(ts: Column, tz: str = "UTC") -> Column:
    return _local_bucket("MONTH", ts, tz)


def local_date(ts: Column, tz: str = "UTC") -> Column:
    return F.to_date(F.from_utc_timestamp(ts, tz))


BUCKETS = {"hour": bucket_hour, "day": bucket_day, "month": bucket_month}


def bucket(grain: str, ts: Column, tz: str = "UTC") -> Column:
    return BUCKETS[grain](ts, tz)
