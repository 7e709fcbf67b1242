"""Nearest match on equal keys within a numeric tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_match(
    left: DataFrame,
    right: DataFrame,
    *,
    left_keys: list[Column],
    right_keys: list[Column],
    left_value: Column,
    right_value: Column,
    take: str,
    tolerance: float,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Left join to the nearest ``right`` row: equal keys, values within ``tolerance``.

    NULL values count as 0.0; NULL keys and values that are not finite match nothing. Ties on the distance
    go to the smallest ``take``. Adds the column ``take`` (NULL where nothing
    matches) and changes no other column or row.

    The answer depends only on (keys, value), so the match runs on the distinct
    combinations, which takes the weight off popular keys before any shuffle.
    Values are put in buckets twice as wide as the tolerance and right rows are
    offered to the neighbouring buckets, so a popular key is split by value
    instead of comparing all of its pairs. ``keys_from`` may name a cheaper frame
    to read the combinations from, with at least those of ``left``.
    """
    n = len(left_keys)
    keys = [f"_key{i}" for i in range(n)]
    width = F.lit(2 * tolerance)

    def keyed(df: DataFrame, columns: list[Column], value: Column) -> DataFrame:
        return df.withColumns(
            {**dict(zip(keys, columns)), "_value": F.coalesce(value.cast("double"), F.lit(0.0))}
        )

    def usable(df: DataFrame) -> DataFrame:
        finite = F.abs(F.col("_value") / width) < F.lit(9.0e18)  # also leaves out NaN, whose bucket is none
        return df.dropna(subset=keys).where(finite & ~F.isnan("_value"))

    rows = keyed(left, left_keys, left_value)
    combinations = rows if keys_from is None else keyed(keys_from, left_keys, left_value)
    wanted = (
        usable(combinations.select(*keys, "_value"))
        .distinct()
        .withColumn("_slot", F.floor(F.col("_value") / width).cast("bigint"))
    )
    slot = F.floor(F.col("_there") / width).cast("bigint")
    offered = (
        usable(keyed(right, right_keys, right_value).select(*keys, "_value", take))
        .groupBy(*keys, F.col("_value").alias("_there"))
        .agg(F.min(take).alias("_found"))
        .withColumn("_slot", F.explode(F.array(slot - 1, slot, slot + 1)))
    )
    distance = F.abs(F.col("_value") - F.col("_there"))
    best = (
        wanted.join(offered, [*keys, "_slot"])
        .where(distance <= tolerance)
        .groupBy(*keys, "_value")
        .agg(F.min(F.struct(distance.alias("d"), F.col("_found").alias("found"))).alias("_best"))
        .select(*keys, "_value", F.col("_best.found").alias(take))
    )
    return rows.join(best, [*keys, "_value"], "left").select(*[F.col(c) for c in left.columns], take)
