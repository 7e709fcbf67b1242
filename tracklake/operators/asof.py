"""As-of join on type-2 validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import time_bucket
from .joins import interval_join
from .ranking import next_within

# A list of keys up to this length is broadcast; beyond it Spark chooses the join.
BROADCAST_KEYS = 1_000_000


def disjoint_versions(versions: DataFrame, key: str, start: str, end: str, take: list[str]) -> DataFrame:
    """Versions without empty ones, one per start (the longest), each cut where the next one starts."""
    version = F.struct(F.col(end), *take)
    single = (
        versions.where(F.col(key).isNotNull() & (F.col(start) < F.col(end)))
        .groupBy(key, start)
        .agg(F.max(version).alias("_version"))
        .select(key, start, "_version.*")
    )
    return next_within(single, key, start, "_next").withColumn(end, F.least(end, "_next")).drop("_next")


def _open_at(slots: DataFrame, key: str, block: int = 3600) -> DataFrame:
    """``_open``: the newest ``_last`` of an earlier slot of the key.

    Slots are sorted per key and block of slots; what a block begins with comes
    from a table of one row per key and block.
    """
    blocks = slots.withColumn("_block", F.floor(F.col("_slot") / F.lit(block)))
    inside = Window.partitionBy(key, "_block").orderBy("_slot").rangeBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begun = (
        blocks.groupBy(key, "_block")
        .agg(F.max("_last").alias("_newest"))
        .withColumn("_begun", F.last("_newest", ignorenulls=True).over(across))
        .drop("_newest")
    )
    return (
        blocks.withColumn("_inside", F.last("_last", ignorenulls=True).over(inside))
        .join(begun, [key, "_block"], "left")
        .withColumn("_open", F.coalesce("_inside", "_begun"))
        .drop("_inside", "_begun", "_block")
    )


def asof_join(
    events: DataFrame,
    versions: DataFrame,
    *,
    key: str,
    time: str,
    start: str,
    end: str,
    take: list[str],
    keys_from: DataFrame | None = None,
    max_versions: int = 64,
    slot_seconds: int = 1,
) -> DataFrame:
    """Columns ``take`` of the latest-starting version valid at each event's time.

    A version ends at the latest where the next one of its key starts. Every
    event is kept exactly once, with NULLs where no version is valid.

    Keys with up to ``max_versions`` versions take a plain equi-join on the key:
    one shuffle of the events, in which adaptive execution splits hot keys. A
    key with more would compare too many pairs, so its events and versions are
    joined on (key, time slot) instead; the version open when a slot begins is
    carried into it. With changes at most a few times a second an event then meets few versions. Whether there are such keys is counted first, from
    ``versions`` alone. ``keys_from`` may name a cheaper frame to read the slots
    in use from, with at least the (key, time) pairs of ``events``.
    """
    known = disjoint_versions(versions, key, start, end, take)
    bounds = {"key": key, "time": time, "start": start, "end": end, "take": take}
    busy = versions.groupBy(key).count().where(F.col("count") > max_versions).select(F.col(key).alias("_busy"))
    n_busy = busy.count()
    if n_busy == 0:
        return interval_join(events, known, **bounds)

    listed = F.broadcast(busy) if n_busy <= BROADCAST_KEYS else busy

    def slotted(df: DataFrame, instant: str) -> DataFrame:
        """With the time slot for busy keys and slot -1 for all others."""
        slot = F.when(F.col("_busy").isNotNull(), time_bucket(F.col(instant), slot_seconds)).otherwise(F.lit(-1))
        return df.join(listed, df[key] == busy["_busy"], "left").withColumn("_slot", slot)

    version = F.struct(start, end, *take)
    right = slotted(known, start)
    used = slotted((events if keys_from is None else keys_from).select(key, time), time)
    in_use = used.where("_busy IS NOT NULL AND _slot IS NOT NULL").select(key, "_slot").distinct()
    closing = right.where("_busy IS NOT NULL").groupBy(key, "_slot").agg(F.max(version).alias("_last"))
    slots = in_use.withColumn("_wanted", F.lit(True)).unionByName(closing, allowMissingColumns=True)
    carried = _open_at(slots, key).where("_wanted AND _open IS NOT NULL").select(key, "_slot", "_open.*")
    columns = [key, "_slot", start, end, *take]
    candidates = right.select(*columns).unionByName(carried.select(*columns)).toDF(
        "_key", "_at_slot", "_start", "_end", *take
    )
    left = slotted(events, time).drop("_busy")
    valid = (
        (left[key] == candidates["_key"])
        & (left["_slot"] == candidates["_at_slot"])
        & (left[time] >= candidates["_start"])
        & (left[time] < candidates["_end"])
    )
    return left.join(candidates, valid, "left").select(*[left[c] for c in events.columns], *take)
