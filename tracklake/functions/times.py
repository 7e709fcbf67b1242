"""Epoch conversion, buckets and differences. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: end of a validity interval that is still open.
OPEN_END = "9999-01-01 00:00:00"


# Epoch milliseconds of the years 1 to 9999, both whole; no other value is a time.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def plausible_millis(millis: Column) -> Column:
    """False for numbers that are no time of the years 1 to 9999; NULL for NULL."""
    return millis.between(FIRST_MILLIS, LAST_MILLIS)


def millis_to_timestamp(millis: Column) -> Column:
    """The instant, or NULL for a number that is none: one bad value must not stop a job."""
    return F.timestamp_millis(F.when(plausible_millis(millis), millis))


def hour_bucket(instant: Column) -> Column:
    return F.date_trunc("HOUR", instant)


def time_bucket(instant: Column, seconds: int) -> Column:
    """Number of the fixed-width bucket an instant falls in, counted from the epoch."""
    return F.floor(F.unix_seconds(instant.cast("timestamp")) / F.lit(seconds))


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole units that passed between two instants, truncated toward zero."""
    return F.timestamp_diff(unit, start, end)


def second_boundaries(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two instants (0.9 s to 1.1 s is one)."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def time_parts(df: DataFrame, instant: str) -> DataFrame:
    t = F.col(instant)
    return df.withColumns(
        {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}
    )


def to_epoch_millis(value: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds from a number, a time, or text holding either; else NULL."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_millis(value.cast("timestamp"))
    if isinstance(dtype, T.StringType):
        return F.coalesce(value.try_cast("bigint"), F.unix_millis(value.try_cast("timestamp")))
    return value.try_cast("bigint")
