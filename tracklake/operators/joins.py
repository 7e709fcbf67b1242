"""Joins the star schema is built from.

No join here carries a broadcast hint on a table: Spark broadcasts a side when
its measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and splits
hot partitions of a sort-merge join otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; the key columns of ``left`` stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    joined = left.join(renamed, match, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: dict[str, str], take: str, name: str | None = None
) -> DataFrame:
    """Left equi-join to a lookup made unique first: the smallest ``take`` per key.

    ``on`` maps columns of ``df`` to columns of ``lookup``. Row count and order
    of ``df`` are never changed by repeated lookup keys.
    """
    found = name or take
    unique = (
        lookup.groupBy(*[F.col(there).alias(f"_k_{here}") for here, there in on.items()])
        .agg(F.min(take).alias(found))
    )
    match = reduce(lambda a, b: a & b, [df[here] == unique[f"_k_{here}"] for here in on])
    return df.join(unique, match, "left").drop(*[f"_k_{here}" for here in on])


def interval_join(
    events: DataFrame, versions: DataFrame, *, key: str, time: str, start: str, end: str, take: list[str]
) -> DataFrame:
    """Left join of each event to every version with ``start <= time < end``.

    The plain form: an equi-join with the bounds as residual. Suits intervals of
    any shape and keys with few versions each.
    """
    right = versions.select(
        F.col(key).alias("_key"), F.col(start).alias("_start"), F.col(end).alias("_end"), *take
    )
    inside = (
        (events[key] == right["_key"]) & (events[time] >= right["_start"]) & (events[time] < right["_end"])
    )
    return events.join(right, inside, "left").drop("_key", "_start", "_end")
