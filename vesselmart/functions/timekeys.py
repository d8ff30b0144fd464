"""Smart keys for dates and times of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Arg, big, col, idiv


def minutes_since_midnight(ts: Arg) -> Column:
    return F.hour(col(ts)) * 60 + F.minute(col(ts))


def timestamp_to_date_id(ts: Arg) -> Column:
    """YYYYMMDD."""
    t = col(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.day(t)).cast("bigint")


def date_id_to_timestamp(date_id: Arg) -> Column:
    """Midnight of the date; an impossible date is an error under ANSI mode."""
    d = big(date_id)
    zero = F.lit(0)
    return F.make_timestamp_ntz(
        idiv(d, 10000).cast("int"), (idiv(d, 100) % 100).cast("int"), (d % 100).cast("int"),
        zero, zero, zero,
    )


def timestamp_to_time_id(ts: Arg) -> Column:
    """HMMSS as a number, so 00:05:09 is 509."""
    t = col(ts)
    return (F.hour(t) * 10000 + F.minute(t) * 100 + F.second(t)).cast("bigint")


def _time_parts(time_id: Arg) -> tuple[Column, Column, Column]:
    t = big(time_id)
    return idiv(t, 10000).cast("int"), (idiv(t, 100) % 100).cast("int"), (t % 100).cast("int")


def time_id_to_timestamp(time_id: Arg) -> Column:
    """Time of day on 1900-01-01."""
    return F.make_timestamp_ntz(F.lit(1900), F.lit(1), F.lit(1), *_time_parts(time_id))


def datetime_keys_to_timestamp(date_id: Arg, time_id: Arg) -> Column:
    d = big(date_id)
    return F.make_timestamp_ntz(
        idiv(d, 10000).cast("int"), (idiv(d, 100) % 100).cast("int"), (d % 100).cast("int"),
        *_time_parts(time_id),
    )


def ts_to_temporal_part_key(ts: Arg) -> Column:
    """YYYYMM, the time part of the point fact's layout."""
    t = col(ts)
    return (F.year(t) * 100 + F.month(t)).cast("bigint")
