"""Rank and lag that never sort a whole hot group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import time_bucket
from .joins import join_null_safe


def dense_rank_within(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """``dense_rank`` of ``value``, highest first, within ``group``.

    A dense rank depends on the distinct values only. For counts these are few
    (n different counts need n*n/2 rows behind them), so the window runs over
    the distinct (group, value) pairs and the rank is joined back on them.
    """
    w = Window.partitionBy(*group).orderBy(F.col(value).desc_nulls_last())
    levels = df.select(*group, value).distinct().withColumn(name, F.dense_rank().over(w))
    return join_null_safe(df, levels, [*group, value], "left")


def previous_within(
    df: DataFrame, key: str, time: str, name: str, ties: list[Column] | None = None, bucket_seconds: int = 3600
) -> DataFrame:
    """``lag(time, 1)`` per ``key`` in time order, as column ``name``."""
    return _neighbour(df, key, time, name, ties or [], bucket_seconds, F.lag, F.max)


def next_within(
    df: DataFrame, key: str, time: str, name: str, ties: list[Column] | None = None, bucket_seconds: int = 3600
) -> DataFrame:
    """``lead(time, 1)`` per ``key`` in time order, as column ``name``."""
    return _neighbour(df, key, time, name, ties or [], bucket_seconds, F.lead, F.min)


def _never_null(column: Column, kind: str) -> Column:
    """A stand-in to partition and join on where the value is NULL; the flag beside it keeps the cases apart."""
    numeric = kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
    return F.coalesce(column, F.lit(0).cast(kind)) if numeric else F.coalesce(column.cast("string"), F.lit(""))


def _neighbour(df, key, time, name, ties, bucket_seconds, step, edge) -> DataFrame:
    """Lag or lead by time buckets.

    Rows are sorted per key and time bucket. The outermost row of a bucket takes
    the nearest time of the key's neighbouring bucket, from a table of one row
    per key and bucket whose size per key is bounded by the calendar. That table
    is joined on the very columns the rows are partitioned by for the window, so
    the rows are shuffled once.
    """
    own = ["_key", "_no_key", "_bucket", "_no_time"]
    bucket = time_bucket(F.col(time), bucket_seconds)
    bucketed = df.withColumns(
        {
            "_key": _never_null(F.col(key), dict(df.dtypes)[key]),
            "_no_key": F.col(key).isNull(),
            # Rows without a time come first, as they do in a window in ascending order.
            "_bucket": F.coalesce(bucket, F.lit(-(2**62))),
            "_no_time": bucket.isNull(),
        }
    )
    inside = Window.partitionBy(*own).orderBy(F.col(time), *ties)
    across = Window.partitionBy("_key", "_no_key").orderBy("_bucket")
    carry = (
        bucketed.groupBy(*own)
        .agg(edge(time).alias("_edge"))
        .withColumn("_carry", step("_edge", 1).over(across))
        .drop("_edge")
    )
    rows = bucketed.withColumn("_near", step(time, 1).over(inside))
    return (
        rows.join(carry, own, "left")
        .withColumn(name, F.coalesce("_near", "_carry"))
        .select(*[F.col(f"`{c}`") for c in df.columns], name)
    )
